"""The frontier: enqueueing URLs, resolving them to ids, linking pages, claiming the best ones."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.constants import SEED_RELEVANCE, SINGLE_INSERT_SITE_ID
from linkloom.functions import urls
from linkloom.operators.ids import dense_ids, max_id
from linkloom.operators.skew import MIN_HOT_ROWS, SLICES, skew_join
from linkloom.schemas import LINK_BATCH, PAGE

# Above this k, the per-domain ranking first ranks inside salted groups: Spark cuts a window to its
# top k before the shuffle only up to its own threshold of the same size.
GROUP_LIMIT = 1000
RANK_SALTS = 64
# Ids of one score are counted in this many equal ranges at a time.
ID_RANGES = 4096


def explode_link_batches(bodies: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """(links, rejects) of JSON bodies ``{from_page_id, links: [{url, relevance}]}``.

    Links keep all other columns and get from_page_id, position, url and relevance. Bodies that are
    no such JSON, or have no ``links``, are rejects; an empty list gives no rows.
    """
    parsed = bodies.withColumn("_parsed", F.from_json(body, LINK_BATCH, {"mode": "PERMISSIVE"}))
    keep = [name for name in bodies.columns if name != body]
    links = parsed.select(
        *keep, F.col("_parsed.from_page_id").alias("from_page_id"),
        F.posexplode("_parsed.links").alias("position", "_link"),
    ).select(*keep, "from_page_id", "position", "_link.url", "_link.relevance")
    return links, parsed.filter(F.col("_parsed.links").isNull()).drop("_parsed")


def frontier_rows(df: DataFrame, site_id: int | None = None) -> DataFrame:
    """Complete page rows in state FRONTIER from (id, url, relevance)."""
    given = {"id": F.col("id"), "url": F.col("url"), "relevance": F.col("relevance"), "site_id": F.lit(site_id),
             "page_type_code": F.lit("FRONTIER")}
    return df.select(*[
        given.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name) for field in PAGE.fields
    ])


def first_of_batch(batch: DataFrame, order: Column) -> DataFrame:
    """(url, relevance): the first of repeated URLs wins. Repeats are combined before the shuffle."""
    first = F.min_by(F.struct("relevance"), order).alias("_first")
    return batch.filter(F.col("url").isNotNull()).groupBy("url").agg(first).select("url", "_first.relevance")


def insert_ignore(page: DataFrame, batch: DataFrame, order: Column, site_id: int | None = None) -> DataFrame:
    """New FRONTIER rows for URLs of ``batch`` (url, relevance) that ``page`` lacks.

    Rows that exist are left as they are, also when the batch scores them higher.
    """
    return insert_unknown(first_of_batch(batch, order), page, max_id(page), site_id)


def insert_unknown(first: DataFrame, known: DataFrame, start: Column | int, site_id: int | None = None) -> DataFrame:
    """New FRONTIER rows, numbered from ``start`` on, for distinct URLs (url, relevance) that ``known`` lacks. That is all pages, or
    what an index found of them for these URLs."""
    return frontier_rows(dense_ids(except_existing(first, known), "url", start=start), site_id)


def insert_counts(batch: DataFrame, inserted: DataFrame) -> DataFrame:
    """(n_requested, n_inserted): callers used to get the first, rows really added are the second."""
    return batch.agg(F.count("*").alias("n_requested")).select(
        "n_requested", inserted.agg(F.count("*")).scalar().alias("n_inserted")
    )


def raise_relevance(page: DataFrame, batch: DataFrame) -> DataFrame:
    """Option: ``page`` with FRONTIER rows raised to the highest relevance seen in ``batch``."""
    best = batch.groupBy("url").agg(F.max("relevance").alias("_best"))
    higher = (F.col("page_type_code") == "FRONTIER") & (
        F.coalesce(F.col("_best") > F.col("relevance"), F.col("relevance").isNull() & F.col("_best").isNotNull())
    )
    raised = page.join(best, "url", "left").withColumn(
        "relevance", F.when(higher, F.col("_best")).otherwise(F.col("relevance"))
    )
    return raised.select(*page.columns)


def http_only(links: DataFrame, link: str = "link") -> DataFrame:
    """Option: drop links such as ``mailto:`` and script text, which otherwise enter the frontier."""
    return links.filter(urls.is_web(F.col(link)))


def seed_frontier(
    spark: SparkSession, page: DataFrame, seeds: Iterable[str], relevance: int = SEED_RELEVANCE, normalize: bool = True,
) -> DataFrame:
    """New FRONTIER rows for a hand-written list of seed URLs, normalised unless told otherwise."""
    rows = [(i, seed, relevance) for i, seed in enumerate(seeds)]
    batch = spark.createDataFrame(rows, "position int, link string, relevance int")
    return seed_rows(page, batch, normalize)


def seed_rows(page: DataFrame, batch: DataFrame, normalize: bool = True) -> DataFrame:
    """The same for seeds that are a table (position, link, relevance)."""
    if normalize:
        batch = urls.normalize_links(batch.withColumn("base", F.lit("")), link="link", out="url")
    else:
        batch = batch.withColumn("url", F.col("link"))
    return insert_ignore(page, batch, F.col("position"))


def frontier_append(
    page: DataFrame, batch: DataFrame, order: Column, site_id: int = SINGLE_INSERT_SITE_ID,
) -> tuple[DataFrame, DataFrame]:
    """(new rows, rejects) for single inserts: without relevance, and a known or repeated URL is an error.

    ``order`` must be unique; the first of repeated URLs is taken, all others are rejects.
    """
    ordered = batch.withColumn("_order", order)
    first = ordered.filter(F.col("url").isNotNull()).groupBy("url").agg(F.min("_order").alias("_order"))
    taken = except_existing(first, page)
    rows = frontier_rows(
        dense_ids(taken.select("url"), "url", start=max_id(page)).withColumn("relevance", F.lit(None)), site_id
    )
    return rows, ordered.join(taken.select("_order"), "_order", "left_anti").drop("_order")


def except_existing(batch: DataFrame, page: DataFrame) -> DataFrame:
    """Rows of ``batch`` whose URL is not known; its URLs should be distinct."""
    return batch.join(page.select("url"), "url", "left_anti")


def intersect_known(batch: DataFrame, page: DataFrame) -> DataFrame:
    """Rows of ``batch`` whose URL is known; its URLs should be distinct."""
    return batch.join(page.select("url"), "url", "left_semi")


def union_state(page: DataFrame, inserted: DataFrame) -> DataFrame:
    return page.unionByName(inserted)


def url_to_id(
    links: DataFrame, page: DataFrame, url: str = "url", out: str = "to_page", slices: int = SLICES, min_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """``links`` with the id of their URL; links to unknown URLs are dropped. Popular URLs are salted."""
    ids = page.select(F.col("url").alias(url), F.col("id").alias(out))
    return skew_join(links, ids, url, F.struct(*links.columns), "inner", slices=slices, min_rows=min_rows)


def link_insert_ignore(link: DataFrame, pairs: DataFrame) -> DataFrame:
    """New (from_page, to_page) rows; pairs without a source, repeated or known ones are left out."""
    fresh = pairs.select("from_page", "to_page").filter(F.col("from_page").isNotNull() & F.col("to_page").isNotNull())
    return fresh.distinct().join(link, ["from_page", "to_page"], "left_anti")


def _best_first() -> list[Column]:
    # Rows without a score come first, as in a descending order that puts NULL on top.
    return [F.col("relevance").desc_nulls_first(), F.col("id")]


def open_frontier(page: DataFrame) -> DataFrame:
    return page.filter(F.col("page_type_code") == "FRONTIER").select("id", "url", "relevance")


def frontier_topk(page: DataFrame, k: int = 1) -> DataFrame:
    """The k best FRONTIER rows (id, url, relevance), ties by id."""
    return best_rows(open_frontier(page), k)


def best_rows(rows: DataFrame, k: int, limit: int = GROUP_LIMIT, ranges: int = ID_RANGES) -> DataFrame:
    """The k best of ``rows`` (id, relevance, …), ties by id; ids are unique.

    Small k are merged in one task, which sees k rows of every other task. For larger ones, counts by score and then by
    ranges of ids find the last row that is taken, and the answer is a filter: no task gets k rows, nothing is shuffled
    but counts. That runs a few small jobs at once, so ``rows`` should be a stored table.
    """
    if k <= limit:
        return rows.orderBy(*_best_first()).limit(k)
    counts = rows.groupBy("relevance").agg(F.count("*").alias("n"))
    cut = _holding(counts, F.col("relevance").desc_nulls_first(), k)
    if cut is None:  # fewer than k rows
        return rows
    left = k - cut.before
    score = F.lit(cut.relevance).cast(rows.schema["relevance"].dataType)
    tied = F.col("relevance").eqNullSafe(score)
    better = F.lit(False) if cut.relevance is None else F.col("relevance").isNull() | (F.col("relevance") > score)
    if left == cut.n:
        return rows.filter(better | tied)
    low, high = rows.filter(tied).agg(F.min("id"), F.max("id")).first()
    while low < high:
        width = (high - low) // ranges + 1
        place = F.expr(f"(id - {low}) div {width}")
        within = rows.filter(tied & F.col("id").between(low, high)).groupBy(place.alias("place"))
        hit = _holding(within.agg(F.count("*").alias("n"), F.max("id").alias("last")), F.col("place"), left)
        left -= hit.before
        low, high = low + hit.place * width, hit.last
        if left == hit.n:  # the whole range is taken
            low = high
    return rows.filter(better | (tied & (F.col("id") <= high)))


def _holding(counts: DataFrame, order: Column, k: int) -> Row | None:
    """The row of a small frame of counts ``n`` that holds the k-th of all, with what stands ``before`` it."""
    earlier = Window.partitionBy(F.lit(0)).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    summed = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    return summed.filter((F.col("before") < k) & (F.col("before") + F.col("n") >= k)).first()


def frontier_topk_per_site(page: DataFrame, k: int = 1) -> DataFrame:
    """The k best FRONTIER rows of every domain, with ``domain`` and ``rank``."""
    rows = open_frontier(page).withColumn("domain", urls.domain_of(F.col("url")))
    if k > GROUP_LIMIT:
        rows = rows.withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(RANK_SALTS)))
        salted = Window.partitionBy("domain", "_salt").orderBy(*_best_first())
        rows = rows.withColumn("_rank", F.row_number().over(salted)).filter(F.col("_rank") <= k).drop("_rank", "_salt")
    best = Window.partitionBy("domain").orderBy(*_best_first())
    return rows.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def frontier_claim(page: DataFrame, claimed: DataFrame, now: Column) -> DataFrame:
    """``page`` with the claimed ids in state CRAWLING at ``now``. One job claims, so no locks.

    ``claimed`` may carry a broadcast hint (``sizes.small``); ``page`` then is not shuffled.
    """
    marks = claimed.select("id", F.lit(True).alias("_claimed"))
    hit = F.col("_claimed") & (F.col("page_type_code") == "FRONTIER")
    return page.join(marks, "id", "left").withColumns({
        "accessed_time": F.when(hit, now).otherwise(F.col("accessed_time")),
        "page_type_code": F.when(hit, "CRAWLING").otherwise(F.col("page_type_code")),
    }).select(*page.columns)


def stale_claims(page: DataFrame, before: Column) -> DataFrame:
    """Rows still CRAWLING since before ``before``: claims whose crawl was lost."""
    return page.filter((F.col("page_type_code") == "CRAWLING") & (F.col("accessed_time") < before)).select(
        "id", "url", "accessed_time"
    )
