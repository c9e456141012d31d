"""A number for each row that stays the same when a table is read again."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.operators.sizes import small
from linkloom.session import materialize

ROW = "__row"
_ROWS_BITS = 40


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with a whole number ``__row`` that is different for each row, repeated rows included.

    Rows of a Parquet table are numbered by their file and their place in it, so the table is only read. Anything else is
    written once with its numbers. A column of that name is replaced.
    """
    plain = df.drop(ROW)
    if _is_scan(df):
        try:
            placed = plain.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__place"))
        except AnalysisException:  # a format without places
            return materialize(plain.withColumn(ROW, F.monotonically_increasing_id()), "numbered")
        files = placed.select("__file").distinct().select("__file", (F.row_number().over(Window.orderBy("__file")) - 1).cast("long").alias("__number"))
        number = F.shiftleft("__number", _ROWS_BITS).bitwiseOR(F.col("__place"))
        return placed.join(small(materialize(files, "files")), "__file").withColumn(ROW, number).drop("__file", "__place", "__number")
    return materialize(plain.withColumn(ROW, F.monotonically_increasing_id()), "numbered")


def _is_scan(df: DataFrame) -> bool:
    """Whether rows are those of files, at most chosen among and cut to columns: then none comes twice."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter"):
        plan = plan.child()
    return plan.nodeName().startswith("Relation") or plan.nodeName() == "LogicalRelation"
