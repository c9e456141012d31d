"""Contracts of request bodies, length limits, and key constraints, as good rows and rejects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.constants import DATA_TYPES, LENGTH_LIMITS, PAGE_TYPES

# Per kind of body: field -> (type, required). A "number" may be sent as text, but then counts as missing.
CONTRACTS = {
    "site": {"domain": ("string", True), "robots_content": ("string", False), "sitemap_content": ("string", False)},
    "delay": {"site_url": ("string", True), "ip": ("string", True), "robots_delay": ("number", False)},
    "page_frontier": {"site_url": ("string", True), "url": ("string", True)},
    "page": {
        "page_type_code": ("string", True), "html_content": ("string", False), "http_status_code": ("int", False),
        "accessed_ip": ("string", True),
    },
    "page_data": {"page_id": ("int", True), "data_type_code": ("string", True), "data": ("string", True)},
    "image": {
        "page_id": ("int", True), "filename": ("string", True), "content_type": ("string", True),
        "data": ("string", True), "accessed_time": ("string", False),
    },
    "link": {"from_page": ("int", True), "to_page": ("int", True)},
}
FOREIGN_KEYS = (
    ("page", "site_id", "site", "id"),
    ("page", "page_type_code", "page_type", "code"),
    ("page_data", "page_id", "page", "id"),
    ("page_data", "data_type_code", "data_type", "code"),
    ("image", "page_id", "page", "id"),
    ("link", "from_page", "page", "id"),
    ("link", "to_page", "page", "id"),
)
UNIQUE_KEYS = (("page", ("url",)), ("page", ("content_hash",)), ("link", ("from_page", "to_page")))


def validate_rows(bodies: DataFrame, kind: str, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """(good, rejects) of JSON bodies: required fields present, every field of its type.

    Text fields must be JSON strings; numbers may be JSON numbers or numeric strings. Good rows have
    the contract's columns, next to the other columns of ``bodies``.
    """
    contract = CONTRACTS[kind]
    keep = [name for name in bodies.columns if name != body]
    parsed = bodies.withColumn("_json", F.try_parse_json(body))
    good = F.col("_json").isNotNull() & F.coalesce(F.schema_of_variant("_json").startswith("OBJECT"), F.lit(False))
    fields = {}
    for name, (kind_name, required) in contract.items():
        shape = F.schema_of_variant(F.try_variant_get("_json", f"$.{name}", "variant"))
        if kind_name == "string":
            value = F.try_variant_get("_json", f"$.{name}", "string")
            fits = shape == "STRING"
        else:
            number = F.try_variant_get("_json", f"$.{name}", "double")
            fits = number.isNotNull()
            if kind_name == "int":
                fits = fits & (number == F.floor(number))
                value = number.cast("bigint")
            else:
                value = F.when(shape != "STRING", number)
        if not required:
            fits = fits | shape.isNull() | (shape == "VOID")
        good = good & F.coalesce(fits, F.lit(False))
        fields[name] = F.when(shape != "VOID", value).alias(name)
    parsed = parsed.withColumn("_good", good)
    return parsed.filter("_good").select(*keep, *fields.values()), parsed.filter(~F.col("_good")).select(*bodies.columns)


def length_checks(rows: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """(good, rejects) by the column length limits of ``table``."""
    long = F.lit(False)
    for name, limit in LENGTH_LIMITS.get(table, {}).items():
        if name in rows.columns:
            long = long | F.coalesce(F.length(name) > limit, F.lit(False))
    return rows.filter(~long), rows.filter(long)


def fk_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """(constraint, value, n_rows) of keys without parent. NULL keys pass.

    Children are counted per key before the shuffle, so a popular parent costs one row per task.
    """
    spark = next(iter(tables.values())).sparkSession
    codes = {"page_type": PAGE_TYPES, "data_type": DATA_TYPES}
    found = []
    for child, column, parent, key in FOREIGN_KEYS:
        if child not in tables or (parent not in tables and parent not in codes):
            continue
        counts = tables[child].filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_key")).agg(F.count("*").alias("n_rows"))
        if parent in tables:
            orphans = counts.join(tables[parent].select(F.col(key).alias("_key")), "_key", "left_anti")
        else:
            orphans = counts.filter(~F.col("_key").isin(*codes[parent]))
        found.append(orphans.select(
            F.lit(f"{child}.{column}").alias("constraint"), F.col("_key").cast("string").alias("value"), "n_rows"
        ))
    return _union(spark, found, "constraint string, value string, n_rows bigint")


def unique_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """(constraint, value, n_rows) of repeated unique keys. NULLs never clash."""
    spark = next(iter(tables.values())).sparkSession
    found = []
    for table, columns in UNIQUE_KEYS:
        if table not in tables:
            continue
        whole = tables[table].dropna(subset=list(columns))
        repeated = whole.groupBy(*columns).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")
        found.append(repeated.select(
            F.lit(f"{table}.{','.join(columns)}").alias("constraint"),
            F.concat_ws(",", *[F.col(c).cast("string") for c in columns]).alias("value"), "n_rows",
        ))
    return _union(spark, found, "constraint string, value string, n_rows bigint")


def _union(spark, frames: list[DataFrame], schema: str) -> DataFrame:
    if not frames:
        return spark.createDataFrame([], schema)
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole
