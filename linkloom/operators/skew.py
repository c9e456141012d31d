"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds more than 1/SLICES of all rows, so fewer than SLICES keys can be hot:
# the frame of hot keys is bounded whatever the data, which is what makes broadcasting it safe.
SLICES = 1000
MIN_HOT_ROWS = 1_000_000


def hot_keys(counts: DataFrame, key: str, slices: int = SLICES, min_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """(key, n_salts) for hot keys only, from ``counts`` (key, n); n_salts splits a key evenly."""
    total = counts.agg(F.sum("n")).scalar()
    hot = (F.col("n") >= min_rows) & (F.col("n") * slices > total)
    return (
        counts.filter(hot)
        .select(key, F.least(F.lit(slices), F.ceil(F.col("n") * slices / total)).cast("int").alias("n_salts"))
    )


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows per key; map-side combined, NULL keys never match and are left out."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))


def skew_join(
    left: DataFrame, right: DataFrame, key: str, spread: Column, how: str = "left",
    counts: DataFrame | None = None, slices: int = SLICES, min_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Join a large ``left`` with a ``right`` of few rows per key.

    Rows of a hot key are spread over several tasks by a hash of ``spread``, and only the matching
    ``right`` rows of hot keys are copied once per task. Every pair is kept.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"cannot salt a {how} join")
    hot = F.broadcast(hot_keys(key_counts(left, key) if counts is None else counts, key, slices, min_rows))
    salts = F.coalesce("n_salts", F.lit(1))
    # NULL keys match nothing, so any salt will do: spread them too.
    left_salts = F.when(F.col(key).isNull(), F.lit(slices)).otherwise(salts)
    salted_left = (
        left.join(hot, key, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(spread), left_salts).cast("int"))
        .drop("n_salts")
    )
    salted_right = (
        right.join(hot, key, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        .drop("n_salts")
    )
    return salted_left.join(salted_right, [key, "_salt"], how).drop("_salt")


def lookup_join(
    left: DataFrame, right: DataFrame, key: str, slices: int = SLICES, min_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Left join with a ``right`` of one narrow row per key, also balanced when the rows of a hot key are all alike.

    Rows of hot keys stay where they are and meet a broadcast of fewer than ``slices`` rows; NULL keys stay as well. All
    others are shuffled. ``left`` is read four times, so it should be a stored table.
    """
    hot = hot_keys(key_counts(left, key), key, slices, min_rows).select(key)
    answers = F.broadcast(hot.join(right.join(F.broadcast(hot), key, "left_semi"), key, "left"))
    rest = left.filter(F.col(key).isNotNull()).join(F.broadcast(hot), key, "left_anti").join(right, key, "left")
    unknown = left.filter(F.col(key).isNull())
    return rest.unionByName(left.join(answers, key)).unionByName(unknown, allowMissingColumns=True)
