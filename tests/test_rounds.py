"""Whole rounds, the store, and streams that have to end where batches do."""

import datetime as dt
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from linkloom import schemas
from linkloom.operators import quality
from linkloom.plans import catalog, rounds
from linkloom.session import materialize, new_folder
from linkloom.sources.keys import KeyIndex, Sizes
from linkloom.sources.store import Store
from linkloom.sources.tables import page_stream
from linkloom.streaming import pages as streams

T0 = dt.datetime(2024, 1, 1)
HOME = """<html><script>x</script><a href="/a#t">a</a><a href="/B.PDF">b</a><a href="/private/x">p</a>
<img src="/i/Pic.png"><a href="https://other.example/forum/1">o</a><a href="mailto:me@h">m</a><p onclick="">c</p></html>"""
PAGES = [
    # url, html, status, type
    ("https://h.example", HOME, 200, "text/html"),
    ("https://h.example/a", "<a href='/'>home</a><a href='/copy'>c</a><a href='/bin'>b</a>", 200, "text/html"),
    ("https://h.example/copy", "<a href='/'>home</a>\n<a href='/copy'>c</a>  <a href='/bin'>b</a>", 200, "text/html"),
    ("https://h.example/bin", "%PDF", 200, "application/pdf"),
    ("https://other.example/forum/1", "<p>gone</p>", 503, "text/html"),
    ("https://h.example/map", "<p>map</p>", 404, "text/html"),
]
XML = '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc>https://h.example/map</loc></url></urlset>'


@pytest.fixture(scope="module")
def inputs(spark):
    fetched = [(i, u, h, s, t, "10.0.0.1", T0 + dt.timedelta(seconds=i)) for i, (u, h, s, t) in enumerate(PAGES)]
    robots = [("h.example", "User-agent: *\nDisallow: /private\nSitemap: https://h.example/sitemap.xml")]
    return rounds.Inputs(
        spark.createDataFrame(fetched, schemas.FETCHED),
        spark.createDataFrame(robots, "domain string, robots_content string"),
        spark.createDataFrame([("https://h.example/sitemap.xml", XML)], "sitemap_url string, xml string"),
    )


OPTIONS = rounds.Options(agent="loom", ip="10.0.0.1", now=dt.datetime(2024, 2, 1), keywords=("forum",), focus="h.example")


def seeded(spark, url="https://h.example"):
    seed = {"id": 1, "url": url, "page_type_code": "FRONTIER", "relevance": 3}
    store = Store(spark, new_folder(spark, "store"))
    assert store.status() is None
    store.replace({"page": spark.createDataFrame([tuple(seed.get(n) for n in schemas.PAGE.names)], schemas.PAGE)})
    return store


def by_url(df):
    return {r.url: r for r in df.collect()}


def test_first_round(spark, inputs):
    store = seeded(spark)
    state = rounds.load(store)
    changes = rounds.crawl_round(state, inputs, OPTIONS)
    after = rounds.apply(state, changes)
    got = by_url(after.page)
    assert {u: (r.page_type_code, r.relevance) for u, r in got.items()} == {
        "https://h.example": ("HTML", 3), "https://h.example/a": ("FRONTIER", 1), "https://h.example/map": ("FRONTIER", 3),
        "https://other.example/forum/1": ("FRONTIER", 1), "mailto:me@h": ("FRONTIER", 0),
    }
    assert "<script>" not in got["https://h.example"].html_content
    names = {r.id: u for u, r in got.items()}
    assert {(names[r.from_page], names[r.to_page]) for r in after.link.collect()} == {("https://h.example", u) for u in got}
    assert [(r.page_id, r.data_type_code) for r in after.page_data.collect()] == [(1, "PDF")]
    assert [(r.page_id, r.filename, r.content_type, bytes(r.data)) for r in after.image.collect()] == [(1, "pic.png", "image", b"")]
    assert [(r.domain, r.sitemap_content) for r in after.site.collect()] == [("h.example", "https://h.example/map ")]
    tables = {"page": after.page, "site": after.site, "link": after.link, "page_data": after.page_data, "image": after.image}
    assert quality.fk_violations(tables).count() == 0 and quality.unique_violations(tables).count() == 0


def test_same_round_again_adds_nothing(spark, inputs):
    store = seeded(spark)
    state = rounds.load(store)
    after = rounds.apply(state, rounds.crawl_round(state, inputs, OPTIONS))
    again = rounds.State(**{**vars(after), "page": after.page.withColumn(
        "page_type_code", F.when(F.col("id") == 1, "FRONTIER").when(F.col("page_type_code") == "FRONTIER", "CRAWLING").otherwise(F.col("page_type_code"))
    ).withColumn("content_hash", F.lit(None).cast("string"))})
    changes = rounds.crawl_round(again, inputs, OPTIONS)
    assert changes.frontier.count() == changes.link.count() == changes.site.count() == 0


def test_crawl_to_the_end(spark, inputs):
    store = seeded(spark)
    on_demand = rounds.Inputs(lambda claimed: inputs.fetched.join(claimed.select("url"), "url"), inputs.robots, inputs.sitemaps)
    n = rounds.crawl_to_limit(store, on_demand, OPTIONS)
    state = rounds.load(store)
    got = by_url(state.page)
    kinds = {u: r.page_type_code for u, r in got.items()}
    assert kinds == {
        "https://h.example": "HTML", "https://h.example/a": "HTML", "https://h.example/copy": "DUPLICATE", "https://h.example/bin": "BINARY",
        "https://other.example/forum/1": "BINARY", "https://h.example/map": "HTML", "mailto:me@h": "BINARY",
    }
    assert got["https://other.example/forum/1"].http_status_code == 500 and got["mailto:me@h"].http_status_code == 500
    assert got["https://h.example/copy"].content_hash is None and got["https://h.example/copy"].site_id == got["https://h.example"].site_id
    assert (got["https://h.example/a"].id, got["https://h.example/copy"].id) in {(r.from_page, r.to_page) for r in state.link.collect()}
    status = store.status()
    assert n == status.version == 3 and status.html_pages == 3 and status.frontier_pages == 0
    assert rounds.crawl_to_limit(store, inputs, OPTIONS) == 0
    tables = state.tables()
    assert quality.fk_violations(tables).count() == 0 and quality.unique_violations(tables).count() == 0


def test_limits(spark, inputs):
    store = seeded(spark)
    assert rounds.crawl_to_limit(store, inputs, OPTIONS, max_rounds=1) == 1
    assert rounds.crawl_to_limit(store, inputs, OPTIONS, max_pages=0) == 0
    few = rounds.Options(agent="loom", k=1, http_only=True)
    assert rounds.claim(rounds.load(store).page, few).count() == 1
    one_each = rounds.Options(agent="loom", per_site=1)
    assert rounds.claim(rounds.load(store).page, one_each).count() == 3


def test_failed_write_leaves_the_version(spark, inputs):
    store = seeded(spark)
    state = rounds.load(store)
    changes = rounds.crawl_round(state, inputs, OPTIONS)
    store._write(changes.link, "link", 1)
    assert store.status().version == 0 and rounds.load(store).link.count() == 0
    store.append(changes)
    assert rounds.load(store).link.count() == changes.link.count()


def page_files(spark, n_files=3):
    rows = [(i, f"https://h.example/{i}", f"<p>{i % 7}</p>", 200, "text/html" if i % 5 else "image/png", "ip", T0 + dt.timedelta(seconds=i)) for i in range(60)]
    folder = new_folder(spark, "arriving")
    for part in range(n_files):
        spark.createDataFrame(rows[part::n_files], schemas.FETCHED).coalesce(1).write.mode("append").parquet(folder)
    return folder


def test_streams_end_where_batches_do(spark):
    folder = page_files(spark)
    stored = spark.read.schema(schemas.FETCHED).parquet(folder)
    store = Store(spark, new_folder(spark, "store"))
    store.replace({"page": schemas.empty(spark, "page")})
    checkpoint = new_folder(spark, "checkpoint")
    query = streams.stream_ingest(page_stream(spark, folder, 1), store, checkpoint)
    query.awaitTermination()
    assert store.status().version == 3
    state = rounds.load(store)
    counts = {r.page_type_code: r["count"] for r in state.page.groupBy("page_type_code").count().collect()}
    assert counts == {"HTML": 7, "DUPLICATE": 41, "BINARY": 12}
    assert state.link.count() == 41
    assert quality.unique_violations({"page": state.page, "link": state.link}).count() == 0
    # A batch that is replayed is skipped, also by a stream that was started again.
    streams.ingest_batch(store, stored, 2, checkpoint)
    assert store.status().version == 3
    again = streams.stream_ingest(page_stream(spark, folder, 1), store, checkpoint)
    again.awaitTermination()
    assert store.status().version == 3
    assert store.rejects().count() == 0

    out = new_folder(spark, "seen")
    streams.stream_first_seen(page_stream(spark, folder, 1), out).awaitTermination()
    seen = spark.read.parquet(out)
    assert sorted(r.content_hash for r in seen.collect()) == sorted(r.content_hash for r in streams.first_seen(stored).collect())

    out = new_folder(spark, "counts")
    streams.stream_html_count(page_stream(spark, folder, 1), out).awaitTermination()
    assert {r.page_type_code: r.n for r in streams.latest_counts(spark, out).collect()} == {"HTML": 48, "BINARY": 12}


def test_stream_restarts_after_a_commit(spark, monkeypatch):
    folder = page_files(spark)
    store = Store(spark, new_folder(spark, "store"))
    open_page = (3, None, "FRONTIER", "https://h.example/3", None, None, None, None, 7, None)
    store.replace({"page": spark.createDataFrame([open_page], schemas.PAGE)})
    checkpoint = new_folder(spark, "checkpoint")
    real, calls = store.append, []

    def failing(*args):
        real(*args)
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("lost after the commit")

    monkeypatch.setattr(store, "append", failing)
    with pytest.raises(Exception, match="lost after the commit"):
        streams.stream_ingest(page_stream(spark, folder, 1), store, checkpoint).awaitTermination()
    monkeypatch.setattr(store, "append", real)
    streams.stream_ingest(page_stream(spark, folder, 1), store, checkpoint).awaitTermination()
    page = rounds.load(store).page
    assert page.count() == page.select("id").distinct().count() == page.select("url").distinct().count() == 60
    assert page.filter("id = 3").first().relevance == 7 and page.filter("page_type_code = 'FRONTIER'").count() == 0


def test_first_sightings_need_no_state(spark):
    """Texts of earlier batches are found in the index, over folds of it; a replayed batch changes nothing."""
    stored = spark.read.schema(schemas.FETCHED).parquet(page_files(spark))
    out = new_folder(spark, "seen")
    index = KeyIndex(spark, f"{out}/_seen", "content_hash", Sizes(bucket_rows=2, fold_rows=2, fold_share=0.0))
    for number in (0, 1, 1, 2, 3):
        part = stored.filter(F.col("id").between(number * 3, number * 3 + 2) if number < 3 else F.col("id") > 5)
        streams.first_seen_batch(part, number, index, out)
    got = sorted((r.content_hash, r.id) for r in spark.read.parquet(out).collect())
    assert got == sorted((r.content_hash, r.id) for r in streams.first_seen(stored).collect()) and len(got) == 7


def test_stored_counts_follow_the_store(spark):
    """After each batch, the running count of HTML pages is that of the store: duplicates do not count."""
    folder = page_files(spark)
    store = Store(spark, new_folder(spark, "store"))
    store.replace({"page": spark.createDataFrame([(900, None, "HTML", "https://h.example/old", "x", None, None, None, 7, "h")], schemas.PAGE)})
    out, checkpoint = new_folder(spark, "counts"), new_folder(spark, "checkpoint")
    stored = spark.read.schema(schemas.FETCHED).parquet(folder)
    for number in range(3):
        streams.ingest_batch(store, stored.filter(F.col("id") % 3 == number), number, "s")
        if number == 2:
            store.compact()
        streams.stream_stored_count(store, out, checkpoint).awaitTermination()
        got = {r.page_type_code: r.n for r in streams.latest_counts(spark, out).collect()}
        want = {r.page_type_code: r["count"] for r in store.read()["page"].groupBy("page_type_code").count().collect()}
        assert got == want and got["HTML"] == store.status().html_pages
        streams.stream_stored_count(store, out, checkpoint).awaitTermination()  # nothing new
        assert {r.page_type_code: r.n for r in streams.latest_counts(spark, out).collect()} == want


def test_stream_rejects(spark):
    store = Store(spark, new_folder(spark, "store"))
    store.replace({"page": spark.createDataFrame([(1, None, "FRONTIER", "https://h.example/1", None, None, None, None, 3, None)], schemas.PAGE)})
    row = lambda i, u, t: (i, f"https://h.example/{u}", f"<p>{i}</p>", 200, "text/html", "ip", T0 + dt.timedelta(seconds=t))
    streams.ingest_batch(store, spark.createDataFrame([row(9, 1, 0), row(1, 1, 1), row(5, 5, 2), row(6, 5, 3)], schemas.FETCHED), 0, "s")
    assert {(r.id, r.relevance) for r in rounds.load(store).page.collect()} == {(1, 3), (5, None)}
    assert {r.id for r in store.rejects().collect()} == {9, 6}
    streams.ingest_batch(store, spark.createDataFrame([row(1, 1, 9)], schemas.FETCHED), 1, "s")
    assert rounds.load(store).page.count() == 2


def document_tables(spark, tmp_path):
    """The same documents as one file and as a folder of two."""
    rows = [(i, f"<p>text {i % 5}</p>", ("en", "fr", "de")[i % 3], "web", 10) for i in range(30)]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    one, two = tmp_path / "one", tmp_path / "two"
    documents.coalesce(1).write.parquet(str(tmp_path / "written"))
    one.mkdir()
    shutil.copy(next((tmp_path / "written").glob("part-*")), one / "documents.parquet")
    documents.repartition(2).write.parquet(str(two / "documents.parquet"))
    return str(one), str(two)


def test_first_seen_of_tables_in_folders(spark, tmp_path):
    for sf in document_tables(spark, tmp_path):
        assert catalog.stream_first_seen(spark, sf).distinct().count() == catalog.stream_first_seen(spark, sf).count() == 5
        pages = catalog.stream_ingest(spark, sf).groupBy("page_type_code").count()
        assert {r.page_type_code: r["count"] for r in pages.collect()} == {"HTML": 5, "DUPLICATE": 15, "BINARY": 10}


def test_counts_of_tables_in_folders(spark, tmp_path):
    for sf in document_tables(spark, tmp_path):
        assert {r.page_type_code: r.n for r in catalog.stream_html_count(spark, sf).collect()} == {"HTML": 20, "BINARY": 10}


def test_unused_texts_are_found_without_reading_texts(spark, monkeypatch):
    rows = [(1, 1, "a", "h"), (2, 2, None, None), (3, 3, "c", "k")]
    responses = materialize(spark.createDataFrame(rows, "id bigint, text_no bigint, html_content string, content_hash string"), "responses")
    settled = spark.createDataFrame([(1, 1), (2, None), (3, None)], "id bigint, text_no bigint")
    read = {}
    monkeypatch.setattr(rounds, "materialize", lambda df, name: read.update({name: df}) or materialize(df, name))
    assert [tuple(r) for r in rounds.texts(responses, settled).collect()] == [(1, 1, "a")]
    assert "html_content" not in read["unused-texts"]._jdf.queryExecution().sparkPlan().toString()


def test_counts_run_on_without_state(spark):
    folder, checkpoint, out = page_files(spark, 2), new_folder(spark, "checkpoint"), new_folder(spark, "counts")
    streams.stream_html_count(page_stream(spark, folder, 1), out, checkpoint).awaitTermination()
    more = [(i, f"https://h.example/{i}", "<p>more</p>", 200, "text/html", "ip", T0) for i in range(60, 70)]
    more = spark.createDataFrame(more, schemas.FETCHED)
    more.coalesce(1).write.mode("append").parquet(folder)
    streams.stream_html_count(page_stream(spark, folder, 1), out, checkpoint).awaitTermination()

    def counted():
        rows = spark.read.schema("page_type_code string, n bigint, batch int").parquet(out).collect()
        assert len(rows) == len({(r.batch, r.page_type_code) for r in rows})
        return {(r.batch, r.page_type_code): r.n for r in rows if r.batch}

    assert counted() == {(1, "HTML"): 48, (1, "BINARY"): 12, (2, "HTML"): 58, (2, "BINARY"): 12}
    streams.html_count_batch(more, 2, out)  # replayed
    assert counted() == {(1, "HTML"): 48, (1, "BINARY"): 12, (2, "HTML"): 58, (2, "BINARY"): 12}
    assert {r.page_type_code: r.n for r in streams.latest_counts(spark, out).collect()} == {"HTML": 58, "BINARY": 12}
    assert not (Path(checkpoint) / "state").exists()
