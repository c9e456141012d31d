"""Inserts into the other tables. New ids are dense and follow the largest existing one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.operators.ids import dense_ids, max_id


def _numbered(rows: DataFrame, table: DataFrame, order: str, start: Column | int | None = None) -> DataFrame:
    return dense_ids(rows, order, start=max_id(table) if start is None else start).select(*table.columns)


def site_append(site: DataFrame, new: DataFrame, order: str = "domain", start: Column | int | None = None) -> DataFrame:
    """New site rows for (domain, robots_content, sitemap_content); ``order`` must be unique in the batch.
    ``start`` is the largest id so far, where it is known.

    Domains already in ``site`` are not looked at.
    """
    return _numbered(new, site, order, start)


def page_data_append(page_data: DataFrame, new: DataFrame, order: str, start: Column | int | None = None) -> DataFrame:
    """New page_data rows for (page_id, data_type_code, data)."""
    return _numbered(new, page_data, order, start)


def image_append(image: DataFrame, new: DataFrame, order: str) -> tuple[DataFrame, DataFrame]:
    """(new rows, rejects) for images with base64 ``data`` and an ISO ``accessed_time``.

    Undecodable data, missing data, or a time that cannot be read is an error; no time is allowed.
    """
    # Characters outside the base64 alphabet are skipped, wrong padding is not. Only data that cannot be read as they are, line
    # breaks included, are searched for such characters.
    alphabet = F.regexp_replace("data", "[^A-Za-z0-9+/=]*+([A-Za-z0-9+/=]*+)", "$1")
    data = F.coalesce(*[F.try_to_binary(text, F.lit("base64")) for text in (F.col("data"), alphabet)])
    # Exploding a one-element array keeps filters on ``_data`` above it, so that data are decoded once.
    decoded = new.select("*", F.explode(F.array(data)).alias("_data")).withColumn(
        "_time", F.expr("try_cast(accessed_time AS timestamp_ntz)")
    )
    good = F.col("_data").isNotNull() & (F.col("accessed_time").isNull() | F.col("_time").isNotNull())
    rows = decoded.filter(good).withColumns({"data": F.col("_data"), "accessed_time": F.col("_time")})
    return _numbered(rows, image, order), decoded.filter(~good).drop("_data", "_time")


def link_append_strict(link: DataFrame, pairs: DataFrame, order: Column) -> tuple[DataFrame, DataFrame]:
    """(new rows, rejects): a pair that is known, or comes again in the batch, is an error.

    ``order`` must be unique. The first of repeated pairs comes from a combined aggregation, so
    many copies of one pair never meet in one task.
    """
    ordered = pairs.withColumn("_order", order)
    valid = F.col("from_page").isNotNull() & F.col("to_page").isNotNull()
    first = ordered.filter(valid).groupBy("from_page", "to_page").agg(F.min("_order").alias("_order"))
    taken = first.join(link, ["from_page", "to_page"], "left_anti")
    return taken.drop("_order"), ordered.join(taken.select("_order"), "_order", "left_anti").drop("_order")
