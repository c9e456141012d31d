"""Fixed virtual slots: records are hashed into thousands of slots, and a versioned map says which shard a slot is in.

The number of slots never changes, so a record's slot never does; bytes are added up per slot, and only the small map
is made or edited. The law is ``bytes``: shards get nearly equal bytes. Rebalancing keeps a slot where it is unless
its shard would be over its share, and writes a new version.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.session import materialize, new_folder

SLOTS = 4096
LAW = "bytes"


def virtual_slot(*record: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(*record), F.lit(slots)).cast("int")


def slot_totals(records: DataFrame) -> DataFrame:
    """(virtual_slot, bytes, rows): totals of the slots that have records; combined before the shuffle."""
    return records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))


def slot_map(totals: DataFrame, shards: int, previous: DataFrame | None = None, tolerance: float = 0.01) -> DataFrame:
    """(version, virtual_slot, shard, bytes, rows): the map, or an edited one if a ``previous`` is given.

    Largest slots first: a slot stays in its shard of ``previous`` while that is within ``tolerance`` of an equal share;
    else, and without a previous shard, it goes to the shard of fewest bytes. Slots are a fixed, small
    number, so they are gone through as one array.
    """
    if previous is None:
        rows = totals.withColumns({"_old": F.lit(None).cast("int"), "_version": F.lit(0)})
    else:
        rows = totals.join(F.broadcast(previous.select("virtual_slot", F.col("shard").alias("_old"), F.col("version").alias("_version"))), "virtual_slot", "left")
    entries = rows.agg(
        F.sort_array(F.collect_list(F.struct("bytes", "virtual_slot", "_old", "rows")), asc=False).alias("entries"),
        F.ceil(F.sum("bytes") / shards * (1 + tolerance)).alias("share"), (F.coalesce(F.max("_version"), F.lit(0)) + 1).alias("version"),
    )
    start = F.struct(
        F.array_repeat(F.lit(0).cast("long"), shards).alias("loads"), F.array().cast("array<int>").alias("shards"),
    )

    def put(state: Column, entry: Column) -> Column:
        loads = state["loads"]
        least = (F.array_position(loads, F.array_min(loads)) - 1).cast("int")
        stays = entry["_old"].isNotNull() & (entry["_old"] < shards) & (F.get(loads, entry["_old"]) + entry["bytes"] <= F.col("share"))
        shard = F.when(stays, entry["_old"]).otherwise(least)
        return F.struct(
            F.transform(loads, lambda load, i: F.when(i == shard, load + entry["bytes"]).otherwise(load)).alias("loads"),
            F.concat(state["shards"], F.array(shard)).alias("shards"),
        )

    placed = entries.select("version", "entries", F.aggregate("entries", start, put, lambda state: state["shards"]).alias("placed"))
    each = placed.select("version", F.explode(F.arrays_zip("entries", "placed")).alias("e"))
    return each.select(
        "version", "e.entries.virtual_slot", F.col("e.placed").alias("shard"), "e.entries.bytes", "e.entries.rows"
    )


def write_map(mapping: DataFrame, path: str) -> int:
    """Store a map below ``path`` as its version, which is returned. Earlier versions stay; a repeated attempt overwrites its own."""
    version = mapping.first().version
    mapping.drop("version").coalesce(1).write.mode("overwrite").parquet(f"{path}/version={version}")
    return version


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """A stored map, the newest unless a version is asked for; None where there is none."""
    try:
        stored = spark.read.schema("virtual_slot int, shard int, bytes long, rows long, version int").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    newest = stored.agg(F.max("version")).first()[0] if version is None else version
    found = stored.filter(F.col("version") == newest)
    return None if newest is None or found.isEmpty() else found


def assign(records: DataFrame, mapping: DataFrame, order: list[str]) -> DataFrame:
    """``records`` (virtual_slot, …) with ``shard`` and ``slot``, the place within the shard, without gaps from 0.

    A place is the rows of the earlier slots of the shard and the rank within the slot, so no task sorts a whole shard.
    """
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = mapping.select("version", "virtual_slot", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("_start"))
    rank = F.row_number().over(Window.partitionBy("virtual_slot").orderBy(*order))
    ranked = records.withColumn("_rank", rank)
    return ranked.join(F.broadcast(starts), "virtual_slot").withColumn("slot", F.col("_start") + F.col("_rank") - 1).drop("_start", "_rank")


def shard_documents(docs: DataFrame, shards: int = 24, slots: int = SLOTS, doc_id: str = "doc_id", text: str = "text", maps: str | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot, version, shard, slot) for all rows of ``docs``.

    Size is the UTF-8 bytes of the text (null: none) plus 8. A slot follows from id and text, so copies of a text
    and rows without an id are spread; rows alike in both share a slot. Texts are read once and never shuffled. An
    empty table gives no rows; other columns play no part.

    ``maps`` is where versions of the map are stored: the newest is edited, and its next version is stored and used. Unless
    given, that is a new folder, and the map is the first. An empty table stores none.
    """
    spark = docs.sparkSession
    maps = new_folder(spark, "slot-maps") if maps is None else maps
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    records = materialize(docs.select(
        F.col(doc_id), (F.octet_length(body) + 8).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
        virtual_slot(F.col(doc_id), F.col(text), slots=slots).alias("virtual_slot"),
    ), "slot-records")
    mapping = materialize(slot_map(slot_totals(records), shards, read_map(spark, maps)), "slot-map")
    if not mapping.isEmpty():
        mapping = read_map(spark, maps, write_map(mapping, maps))
    return assign(records, mapping, [doc_id, "text_crc32", "size"])
