"""A corpus pipeline: language, quality, near duplicates, packing.

Each stage takes (spark, docs, sf_dir) and works on all documents that the stage before kept. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm import jaccard, langid, quality, queries
from linkloom.llm.numbered import ROW, numbered
from linkloom.operators.sizes import small
from linkloom.session import materialize


def _chosen(docs: DataFrame, verdict: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows of ``docs`` that ``verdict`` keeps. All columns but the text have other names meanwhile, so those that are named like
    a result of an operator come through unchanged."""
    names = {c: f"__column_{i}" if c != "text" else c for i, c in enumerate(docs.columns)}
    kept = verdict(docs.select(*[F.col(f"`{c}`").alias(name) for c, name in names.items()]))
    return kept.select(*[F.col(name).alias(c) for c, name in names.items()])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known well enough; learned from the labels of ``docs`` themselves.

    Null texts and texts without a letter go, and so does everything where no row has a label. Rows are judged one by one:
    repeated rows and repeated or null ids are no special case, equal texts fare alike (ties keep both), and no rows give none.
    Columns come through as they are, whatever their names.
    """
    model = langid.fit(docs)
    return _chosen(docs, lambda rows: langid.predict(rows, model).filter(~F.col("rejected")))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are long enough and do not repeat themselves.

    Null and empty texts go. Rows are judged one by one, as in ``language_id``, and columns come through as they are.
    """
    return _chosen(docs, lambda rows: quality.repetition(rows).filter("kept"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies (five words, similarity 0.8): that of the smallest doc_id, null last.

    Of rows that are equal or have one id, also one stays of each group; a row of another text stays whatever its id. Null
    texts and texts without words are in no group, so they stay. No rows give none, and columns come through as they are.
    """
    rows = numbered(docs)
    extra = materialize(jaccard.labelled(rows).filter(~F.col("first")).select(ROW), "near-duplicates")
    return rows.join(small(extra), ROW, "left_anti").drop(ROW)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, packed into sequences of 1,024 tokens.

    A null or empty text is a piece of one token. Rows are packed one by one, whatever their ids; no rows give none.
    """
    return queries.pack_fifty(docs)


STAGES = [
    ("language_id", language_id), ("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as a table and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name}")
    return docs


# Learned models and packing have no SQL form: tests compare the stages with brute force instead.
ORACLE_SQL = None
