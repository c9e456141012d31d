"""Page rows: duplicates by content hash, and updates after a fetch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.operators.sizes import BROADCAST_BYTES, except_known, fits_broadcast
from linkloom.operators.skew import MIN_HOT_ROWS, SLICES, skew_join
from linkloom.session import materialize


def hash_lookup(
    hashes: DataFrame, page: DataFrame, slices: int = SLICES, min_rows: int = MIN_HOT_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """(answers, rejects): ``hashes`` with ``exists`` and ``page_id``; empty hashes are rejects.

    The page with the lowest id answers, which is the only one where hashes are unique.
    """
    empty = F.col("content_hash").isNull() | (F.col("content_hash") == "")
    known = page.filter(F.col("content_hash").isNotNull()).groupBy("content_hash").agg(F.min("id").alias("page_id"))
    asked = hashes.filter(~empty)
    answers = skew_join(asked, known, "content_hash", F.struct(*asked.columns), slices=slices, min_rows=min_rows)
    return answers.withColumn("exists", F.col("page_id").isNotNull()), hashes.filter(empty)


def mark_duplicates(
    batch: DataFrame, page: DataFrame | None = None, slices: int = SLICES, min_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """``batch`` (id, accessed_time, content_hash, …) with ``original_id`` and ``is_duplicate``.

    A hash already in ``page`` wins; otherwise the earliest row of the batch does, by time and id.
    The originals come from one combined aggregation, never from sorting all copies in one task,
    and copies of a very common hash are spread when they meet their original. Rows without a hash
    are their own originals.
    """
    order = F.struct("accessed_time", "id")
    firsts = batch.filter(F.col("content_hash").isNotNull()).groupBy("content_hash").agg(
        F.min_by("id", order).alias("original_id"), F.count("*").alias("n"),
    )
    counts = firsts.select("content_hash", "n")
    originals = firsts.drop("n")
    if page is not None:
        known = page.filter(F.col("content_hash").isNotNull()).groupBy("content_hash").agg(F.min("id").alias("_known"))
        originals = originals.join(known, "content_hash", "left").select(
            "content_hash", F.coalesce("_known", "original_id").alias("original_id")
        )
    marked = skew_join(
        batch, originals, "content_hash", F.col("id"), counts=counts, slices=slices, min_rows=min_rows
    )
    original = F.coalesce("original_id", "id")
    return marked.select(*batch.columns, original.alias("original_id"), (original != F.col("id")).alias("is_duplicate"))


def duplicate_links(marked: DataFrame) -> DataFrame:
    """Edges original → duplicate."""
    return marked.filter("is_duplicate").select(F.col("original_id").alias("from_page"), F.col("id").alias("to_page"))


def duplicate_updates(marked: DataFrame) -> DataFrame:
    """Updates that turn duplicates into DUPLICATE rows; they keep their own site."""
    return marked.filter("is_duplicate").select(
        "id", F.lit("DUPLICATE").alias("page_type_code"), "http_status_code", "accessed_ip",
        F.lit(False).alias("has_site_id"), F.lit(None).cast("bigint").alias("site_id"),
        F.lit(None).cast("string").alias("html_content"), F.lit(None).cast("string").alias("content_hash"),
    )


def page_update(
    page: DataFrame, updates: DataFrame, now: Column, limit: int = BROADCAST_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """(page, rejects): ``page`` with ``updates`` applied; updates of unknown ids are rejects.

    ``updates`` has one row per id: page_type_code, http_status_code, accessed_ip, has_site_id,
    site_id, html_content, content_hash. The site is set only with has_site_id, also to NULL;
    text is kept only for HTML; relevance and URL never change. ``now`` may use columns of updates,
    by the name ``u``.

    The ids of updates are written once. If they fit a broadcast, pages that are not updated stay where
    they are, and only updated ones are shuffled; beyond ``limit`` bytes all are joined at once.
    """
    ids = materialize(updates.select("id"), "updated")
    if not fits_broadcast(ids, limit):
        return _with_updates(page, updates, now), updates.join(page.select("id"), "id", "left_anti")
    asked = F.broadcast(ids)
    rest, touched = page.join(asked, "id", "left_anti"), page.join(asked, "id", "left_semi")
    updated = rest.select(*page.columns).unionByName(_with_updates(touched, updates, now))
    return updated, except_known(updates, page, ["id"], asked)


def _with_updates(page: DataFrame, updates: DataFrame, now: Column) -> DataFrame:
    new = updates.withColumn("_hit", F.lit(True)).alias("u")
    joined = page.alias("p").join(new, F.col("p.id") == F.col("u.id"), "left")
    hit = F.col("u._hit").isNotNull()
    values = {
        "page_type_code": F.col("u.page_type_code"),
        "http_status_code": F.col("u.http_status_code"),
        "accessed_time": now,
        "accessed_ip": F.col("u.accessed_ip"),
        "site_id": F.when(F.col("u.has_site_id"), F.col("u.site_id")).otherwise(F.col("p.site_id")),
        "html_content": F.when(F.col("u.page_type_code") == "HTML", F.col("u.html_content")),
        "content_hash": F.col("u.content_hash"),
    }
    return joined.select(*[
        (F.when(hit, values[name]).otherwise(F.col(f"p.{name}")) if name in values else F.col(f"p.{name}")).alias(name)
        for name in page.columns
    ])


def html_count(page: DataFrame) -> DataFrame:
    return page.filter(F.col("page_type_code") == "HTML").agg(F.count("*").alias("html_page_count"))


def crawl_done(page: DataFrame, max_pages: int, iteration: int = 0, every: int = 1) -> DataFrame:
    """One row: whether there are more than ``max_pages`` HTML pages, looked at every n-th turn."""
    looked = F.lit(iteration % every == 0)
    return html_count(page).select((looked & (F.col("html_page_count") > max_pages)).alias("done"))
