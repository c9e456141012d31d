"""Fetched pages as a stream: ingesting them into the store, first sightings, running counts.

A page stream has the columns of ``schemas.FETCHED``. Checkpoints of the streams go to the shared
folder unless the caller names another.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from linkloom import schemas
from linkloom.functions import urls
from linkloom.operators import pages
from linkloom.operators.sizes import except_known, known_rows, small
from linkloom.plans import rounds
from linkloom.session import materialize, new_folder, scratch
from linkloom.sources.keys import KeyIndex, Point, Sizes
from linkloom.sources.store import OPEN_STATES, Store

_POINT = "batch bigint, base int, buckets int, rows bigint, added bigint"


def _responses(arrived: DataFrame) -> DataFrame:
    """Arrived pages in the form that ``rounds.process`` takes."""
    return arrived.withColumns({
        "domain": urls.domain_of(F.col("url")),
        "site_id": F.lit(None).cast("bigint"),
        "relevance": F.lit(None).cast("int"),
    })


def _run(writer, location: str) -> StreamingQuery:
    return writer.option("checkpointLocation", location).trigger(availableNow=True).start()


def stream_ingest(arriving: DataFrame, store: Store, checkpoint: str | None = None) -> StreamingQuery:
    """Settle arriving pages in ``store``: each text is accepted once, later copies become
    DUPLICATE and are linked from their original.

    A micro-batch is one version of the store, whose commit names the stream (by its checkpoint) and the
    batch. A batch that is replayed after a failure or a restart is found there and skipped.
    """
    location = checkpoint or new_folder(arriving.sparkSession, "stream-ingest")
    return _run(arriving.writeStream.foreachBatch(
        lambda batch, number: ingest_batch(store, batch, number, location)
    ), location)


def _known(arrived: DataFrame, state: rounds.State) -> tuple[DataFrame, DataFrame]:
    """Arrived rows that can be taken, and (id, url) of the others.

    An open page is updated by its id: it keeps its URL, site and relevance. A new id with a new URL is a new page. Pages
    that are settled, and new ids for a URL that another page has, are rejects. Of several rows for one id or
    URL in a batch, the first by time, then id, is taken.
    """
    ids = small(arrived.select("id").distinct())
    by_id = materialize(known_rows(state.page.select("id", "url", "site_id", "relevance", "page_type_code"), ids, ["id"]), "known-ids")
    stored = by_id.select("id", F.col("url").alias("_url"), F.col("site_id").alias("_site"), F.col("relevance").alias("_relevance"), F.col("page_type_code").alias("_state"))
    rows = arrived.join(small(stored), "id", "left").withColumns({
        "url": F.coalesce("_url", "url"), "site_id": F.col("_site"), "relevance": F.col("_relevance"), "_new": F.col("_state").isNull(),
    })
    asked = materialize(rows.filter("_new").select("url").distinct(), "new-urls")
    urls_of = state.pages_of("url", asked).select("url").distinct()
    taken = rows.join(small(materialize(urls_of, "known-urls")).withColumn("_taken", F.lit(True)), "url", "left")
    fits = F.when(F.col("_new"), F.col("_taken").isNull()).otherwise(F.col("_state").isin(*OPEN_STATES))
    narrow = taken.select("id", "url", "accessed_time", F.coalesce(fits, F.lit(False)).alias("_fits"))
    order = ("accessed_time", "id")
    first = (
        narrow.filter("_fits").groupBy("url").agg(F.min(F.struct(*order)).alias("_first")).select("url", "_first.*")
        .groupBy("id").agg(F.min(F.struct("accessed_time", "url")).alias("_first")).select("id", "_first.*")
    )
    first = materialize(first, "first-arrived")
    same = (taken["id"] == first["id"]) & (taken["url"] == first["url"]) & taken["accessed_time"].eqNullSafe(first["accessed_time"])
    kept = taken.join(small(first), same, "left_semi").drop("_url", "_site", "_relevance", "_state", "_new", "_taken")
    if kept.select("id").count() > first.count():  # rows alike in id, URL and time; texts only move if there are any
        kept = kept.dropDuplicates(["id"])
    rejects = narrow.join(first.select("id", "url"), ["id", "url"], "left_anti")
    return kept, rejects.select("id", "url")


def ingest_batch(store: Store, batch: DataFrame, number: int, stream: str) -> None:
    if not store.applied(stream, number):
        with scratch(store.spark, "micro-batch"):
            _ingest(store, batch, number, stream)


def _ingest(store: Store, batch: DataFrame, number: int, stream: str) -> None:
    state = rounds.load(store)
    kept, rejects = _known(_responses(batch), state)
    responses = materialize(rounds.process(kept).withColumn("text_no", F.monotonically_increasing_id()), "arrived")
    processed = responses.drop("html_content")
    store.write_rejects(rejects, store.status().version + 1)
    marked = materialize(rounds.mark(processed, state), "marked")
    duplicates = small(marked.filter("is_duplicate").select("id", "is_duplicate"))
    pairs = pages.duplicate_links(marked)
    spark = batch.sparkSession
    settled = materialize(rounds.settle(processed, duplicates), "settled")
    store.append(rounds.Changes(
        settled=settled,
        texts=rounds.texts(responses, settled),
        link=except_known(pairs, state.link, ["from_page", "to_page"]),
        **{name: schemas.empty(spark, table) for name, table in (
            ("frontier", "page"), ("site", "site"), ("page_data", "page_data"), ("image", "image"),
        )},
    ), stream, number)


def first_seen(arriving: DataFrame) -> DataFrame:
    """(content_hash, id, url) of accepted HTML pages: of each text the first by time, then id. Copies are combined before the
    shuffle, so a text with very many of them is one row per task."""
    hashed = rounds.process(_responses(arriving)).filter(F.col("page_type_code") == "HTML")
    first = F.min(F.struct("accessed_time", "id", "url")).alias("_first")
    return hashed.groupBy("content_hash").agg(first).select("content_hash", "_first.id", "_first.url")


def stream_first_seen(arriving: DataFrame, out: str, checkpoint: str | None = None, sizes: Sizes = Sizes()) -> StreamingQuery:
    """Append first sightings to parquet files in ``out``, one folder ``batch=N`` per micro-batch.

    The stream keeps no state: texts seen before are found in a stored index of their hashes (in ``out/_seen``), of which a
    micro-batch reads the buckets that it touches. A replayed batch overwrites what it wrote.
    """
    spark = arriving.sparkSession
    index = KeyIndex(spark, f"{out}/_seen", "content_hash", sizes)
    writer = arriving.writeStream.foreachBatch(lambda batch, number: first_seen_batch(batch, number, index, out))
    return _run(writer, checkpoint or new_folder(spark, "stream-first-seen"))


def first_seen_batch(batch: DataFrame, number: int, index: KeyIndex, out: str) -> None:
    spark = batch.sparkSession
    with scratch(spark, "first-seen"):
        point = _seen_point(index, number)
        if point is None:
            point = index.write_base(spark.createDataFrame([], index.schema), 0)
        firsts = materialize(first_seen(batch), "firsts")
        known = index.lookup(firsts, point, number).select("content_hash")
        path = f"{out}/batch={number}"
        firsts.join(small(materialize(known, "seen")), "content_hash", "left_anti").write.mode("overwrite").parquet(path)
        after = index.add(spark.read.schema("content_hash string, id bigint").parquet(path), number + 1, point)
        row = spark.createDataFrame([(number, *vars(after).values())], _POINT)
        row.coalesce(1).write.mode("overwrite").json(f"{index.root}/points/{number}")


def _seen_point(index: KeyIndex, number: int) -> Point | None:
    """Where the index stood after the batches before ``number``."""
    if not number:
        return None
    points = index.spark.read.schema(_POINT).json(f"{index.root}/points/*").filter(F.col("batch") < number)
    row = points.orderBy(F.col("batch").desc()).first()
    return None if row is None else Point(row.base, row.buckets, row.rows, row.added)


def type_counts(arriving: DataFrame) -> DataFrame:
    """(page_type_code, n), before duplicates are marked."""
    typed = rounds.process(_responses(arriving)).select("page_type_code")
    return typed.groupBy("page_type_code").agg(F.count("*").alias("n"))


def stream_html_count(arriving: DataFrame, out: str, checkpoint: str | None = None) -> StreamingQuery:
    """Running counts by page state, as one small table ``batch=N`` in ``out`` per micro-batch.

    The stream keeps no state: a micro-batch adds its counts to those of the one before, which are read from ``out``. A
    replayed batch overwrites what it wrote.
    """
    writer = arriving.writeStream.foreachBatch(lambda batch, number: html_count_batch(batch, number, out))
    return _run(writer, checkpoint or new_folder(arriving.sparkSession, "stream-html-count"))


def html_count_batch(batch: DataFrame, number: int, out: str) -> None:
    counts = type_counts(batch)
    if number:
        before = batch.sparkSession.read.schema("page_type_code string, n bigint").parquet(f"{out}/batch={number - 1}")
        counts = counts.unionByName(before).groupBy("page_type_code").agg(F.sum("n").alias("n"))
    counts.coalesce(1).write.mode("overwrite").parquet(f"{out}/batch={number}")


def stream_stored_count(store: Store, out: str, checkpoint: str | None = None) -> StreamingQuery:
    """Running counts of stored pages by state, duplicates told apart, as one small table ``batch=N`` in ``out`` per micro-batch.

    The stream reads the commits of ``store``, so versions that failed are never counted. A micro-batch adds the counts of its
    versions, by partitions alone, to those of the one before; a version that is a new base is counted from there.
    """
    spark = store.spark
    commits = spark.readStream.schema("version int, base int").json(f"{store.root}/_commits/*")

    def write(batch: DataFrame, number: int) -> None:
        last = batch.agg(F.max(F.struct("version", "base"))).first()[0]
        if last is None:
            return
        before, first = None, last.base
        if number:
            earlier = _counts(spark, out).filter(F.col("batch") < number)
            seen = earlier.agg(F.max(F.struct("batch", "version"))).first()[0]
            if seen is not None and seen.version >= last.base:
                before, first = earlier.filter(F.col("batch") == seen.batch).select("page_type_code", "n"), seen.version + 1
        counts = store.settled(first, last.version).groupBy("page_type_code").agg(F.count("*").alias("n"))
        if before is not None:
            counts = counts.unionByName(before).groupBy("page_type_code").agg(F.sum("n").alias("n"))
        counts.withColumn("version", F.lit(last.version)).coalesce(1).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return _run(commits.writeStream.foreachBatch(write), checkpoint or new_folder(spark, "stream-stored-count"))


def _counts(spark, out: str) -> DataFrame:
    return spark.read.schema("page_type_code string, n bigint, version int, batch int").parquet(out)


def latest_counts(spark, out: str) -> DataFrame:
    """(page_type_code, n) of the newest micro-batch."""
    counts = spark.read.schema("page_type_code string, n bigint, batch int").parquet(out)
    newest = counts.agg(F.max("batch").alias("batch")).scalar()
    return counts.filter(F.col("batch") == newest).select("page_type_code", "n")
