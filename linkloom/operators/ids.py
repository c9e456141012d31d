"""Dense ids for new rows, without a global sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dense_ids(df: DataFrame, key: str, start: Column | int = 0, out: str = "id", hex_digits: int = 3) -> DataFrame:
    """Number rows of unique ``key`` as start+1, start+2, ... in (md5 prefix, key) order.

    The md5 prefix spreads keys evenly over 16**hex_digits buckets, each numbered by its own task.
    Bucket offsets come from one count per bucket, so that the frame which is summed in one place
    and broadcast has at most 16**hex_digits rows.
    """
    bucketed = df.withColumn("_bucket", F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, hex_digits))
    before = Window.partitionBy(F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("_bucket").agg(F.count("*").alias("_n"))
        .select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    first = F.lit(start) if isinstance(start, int) else F.coalesce(start, F.lit(0))
    return (
        bucketed.join(F.broadcast(offsets), "_bucket")
        .withColumn(out, (first + F.col("_offset") + within).cast("bigint"))
        .drop("_bucket", "_offset")
    )


def max_id(df: DataFrame, column: str = "id") -> Column:
    """Largest id so far as a scalar subquery, 0 for an empty table."""
    return df.agg(F.coalesce(F.max(column), F.lit(0)).alias("max_id")).scalar()
