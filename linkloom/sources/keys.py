"""A stored index from a key (URL, content hash) to ids, which is read by the buckets that a batch touches.

A base table has one folder for each bucket of the key's hash, its rows sorted by key. Rows that came later are in one
small table per version. A lookup of a batch collects the numbers of its buckets (there are at most ``MOST_BUCKETS``),
reads those of the base and the later tables, and never the page table. When the later rows have grown beyond a share
of the base, both are folded into a new base.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.operators.sizes import known_rows, small

MOST_BUCKETS = 4096


@dataclass(frozen=True)
class Sizes:
    """``bucket_rows``: about so many rows in a bucket. Folded once more than ``fold_rows`` rows, and ``fold_share`` of the
    base, came later."""

    bucket_rows: int = 1 << 18
    fold_rows: int = 1 << 20
    fold_share: float = 0.25


@dataclass(frozen=True)
class Point:
    """Where an index stands at a version: its base, the buckets and rows of that, and the rows added since."""

    base: int
    buckets: int
    rows: int
    added: int


class KeyIndex:
    """Ids by ``key``, in ``root``. Versions are the store's, whose commits hold the points to read at."""

    def __init__(self, spark: SparkSession, root: str, key: str, sizes: Sizes = Sizes()):
        self.spark, self.root, self.key, self.sizes = spark, f"{root.rstrip('/')}/keys_{key}", key, sizes
        self.schema = f"{key} string, id bigint"

    def bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("int")

    def write_base(self, rows: DataFrame, version: int, n_rows: int | None = None) -> Point:
        """A new base of ``rows`` (key, id), which should be stored. Rows without key are left out, repeated ones come once."""
        rows = rows.select(self.key, "id").filter(F.col(self.key).isNotNull()).distinct()
        n_rows = rows.count() if n_rows is None else n_rows
        buckets = min(MOST_BUCKETS, 1 << max(0, (max(1, n_rows) - 1) // self.sizes.bucket_rows).bit_length())
        dealt = rows.withColumn("bucket", self.bucket(buckets)).repartition(buckets, "bucket").sortWithinPartitions("bucket", self.key)
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/base={version}")
        return Point(version, buckets, n_rows, 0)

    def add(self, rows: DataFrame, version: int, point: Point) -> Point:
        """``rows`` as the later table of ``version``, or folded into a new base."""
        path = f"{self.root}/later/v={version}"
        rows.select(self.key, "id").filter(F.col(self.key).isNotNull()).write.mode("overwrite").parquet(path)
        added = point.added + self.spark.read.schema(self.schema).parquet(path).count()
        after = Point(point.base, point.buckets, point.rows, added)
        if added > max(self.sizes.fold_rows, self.sizes.fold_share * point.rows):
            return self.write_base(self.all(after, version), version)
        return after

    def all(self, point: Point, version: int) -> DataFrame:
        """(key, id) of everything."""
        return self._base(point).select(self.key, "id").unionByName(self._later(point, version))

    def lookup(self, batch: DataFrame, point: Point, version: int) -> DataFrame:
        """(key, id) of the keys of ``batch`` that are known. ``batch`` should be stored, as it is read three times."""
        keys = batch.select(self.key).filter(F.col(self.key).isNotNull()).distinct()
        touched = sorted(row.bucket for row in keys.select(self.bucket(point.buckets).alias("bucket")).distinct().collect())
        base = self._base(point)
        if len(touched) < point.buckets:
            base = base.filter(F.col("bucket").isin(touched))
        rows = base.select(self.key, "id").unionByName(self._later(point, version))
        # A page that was settled without having been open is in the tables of two versions at most.
        return known_rows(rows, small(keys), [self.key]).distinct()

    def _base(self, point: Point) -> DataFrame:
        return self.spark.read.schema(f"{self.schema}, bucket int").parquet(f"{self.root}/base={point.base}")

    def _later(self, point: Point, version: int) -> DataFrame:
        if not point.added and version <= point.base:
            return self.spark.createDataFrame([], self.schema)
        later = self.spark.read.schema(f"{self.schema}, v int").parquet(f"{self.root}/later")
        return later.filter(F.col("v").between(point.base + 1, version)).select(self.key, "id")
