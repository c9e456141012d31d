"""Broadcasts behind a check of the real size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the text and numbers of ``df`` stay within ``limit`` bytes. One small aggregation."""
    width = sum((
        F.coalesce(F.octet_length(name), F.lit(0)) + 8 if kind == "string" else F.lit(16) for name, kind in df.dtypes
    ), F.lit(0))
    return (df.agg(F.sum(width.cast("bigint")).alias("n")).first().n or 0) <= limit


def small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if it fits; otherwise as it is, for a shuffle join.

    Meant for frames that are materialised already, as the check reads them.
    """
    return F.broadcast(df) if fits_broadcast(df, limit) else df


def known_rows(table: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a large ``table`` whose keys occur in ``batch``: the table is only filtered by a small
    broadcast batch, and shuffled just for a batch that is too large for that."""
    return table.join(batch.select(*keys), keys, "left_semi")


def except_known(batch: DataFrame, table: DataFrame, keys: list[str], hinted: DataFrame | None = None) -> DataFrame:
    """Rows of ``batch`` with keys not in ``table``, without shuffling the table for small batches."""
    known = known_rows(table.select(*keys), batch if hinted is None else hinted, keys)
    return batch.join(known.distinct(), keys, "left_anti")
