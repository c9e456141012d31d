"""The store's deltas and indexes: they hold what whole tables would, and write and read by the batch."""

import os
import random
import re

from pyspark.sql import functions as F

from linkloom import schemas
from linkloom.plans import rounds
from linkloom.session import materialize
from linkloom.sources.keys import MOST_BUCKETS, KeyIndex, Sizes
from linkloom.sources.store import Store

NONE = ("site", "link", "page_data", "image")


def pages(spark, rows):
    """(id, state, hash) as pages."""
    full = [(i, None, state, f"https://h.example/{i}", None, None, None, None, i % 3, key) for i, state, key in rows]
    return spark.createDataFrame(full, schemas.PAGE)


def changes(spark, settled, frontier):
    return rounds.Changes(pages(spark, settled), schemas.empty(spark, "page_text"), frontier=pages(spark, frontier), **{n: schemas.empty(spark, n) for n in NONE})


def in_folder(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(path) for f in files if f.startswith("part-"))


def test_versions_hold_what_whole_tables_would(spark, tmp_path):
    """Random rounds, over folds of open pages and indexes, against a dictionary of all pages."""
    rng = random.Random(4)
    store = Store(spark, str(tmp_path / "s"), Sizes(bucket_rows=8, fold_rows=12, fold_share=0.2))
    want = {i: ("FRONTIER" if i % 4 else "HTML", None if i % 4 else f"k{i}") for i in range(40)}
    status = store.replace({"page": pages(spark, [(i, *v) for i, v in want.items()])})
    folded = set()
    for _ in range(5):
        opened = [i for i, (state, _) in want.items() if state == "FRONTIER"]
        done = [(i, "HTML", f"k{i}") if i % 3 else (i, "BINARY", None) for i in rng.sample(opened, 5)]
        straight = [(len(want) + 100, "HTML", f"k{len(want) + 100}")]  # settled without having been open
        new = [(max(want) + 200 + i, rng.choice(["FRONTIER", "CRAWLING"]), None) for i in range(4)]
        status = store.append(changes(spark, done + straight, new))
        want |= {i: (state, key) for i, state, key in done + straight + new}
        got = {r.id: (r.page_type_code, r.content_hash) for r in store.read()["page"].collect()}
        assert got == want and store.read()["page"].count() == len(want)
        assert status == store.status() and status.last_ids["page"] == max(want)
        assert status.frontier_pages == sum(s == "FRONTIER" for s, _ in want.values()) and status.html_pages == sum(s == "HTML" for s, _ in want.values())
        folded.add((status.open_base, status.keys["url"].base, status.keys["content_hash"].base))
        asked = spark.createDataFrame([(f"https://h.example/{i}", f"k{i}") for i in range(0, 2000, 3)] + [(None, None)], "url string, content_hash string")
        asked = materialize(asked, "asked")
        for key, value in (("url", lambda i: f"https://h.example/{i}"), ("content_hash", lambda i: want[i][1])):
            known = sorted((value(i), i) for i in want if i % 3 == 0 and value(i) is not None)
            assert sorted(map(tuple, store.known(key, asked, status).collect())) == known
    assert len({x[0] for x in folded}) > 1 and len({x[1] for x in folded}) > 1
    before = {r.id: r.page_type_code for r in store.read()["page"].collect()}
    assert {r.id: r.page_type_code for r in (store.compact(), store.read()["page"])[1].collect()} == before


def test_a_failed_version_is_not_seen(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "s"), Sizes(bucket_rows=4, fold_rows=1, fold_share=0.0))
    store.replace({"page": pages(spark, [(i, "FRONTIER", None) for i in range(9)])})
    step = changes(spark, [(1, "HTML", "k1")], [(20, "FRONTIER", None)])
    commit = store._commit
    monkeypatch.setattr(store, "_commit", lambda status: 1 / 0)
    for _ in range(2):
        try:
            store.append(step)
        except ZeroDivisionError:
            pass
    asked = spark.createDataFrame([(f"https://h.example/{i}",) for i in (1, 20)], "url string")
    assert [r.id for r in store.known("url", asked, store.status()).collect()] == [1]
    assert store.read()["page"].filter("page_type_code = 'FRONTIER'").count() == 9
    monkeypatch.setattr(store, "_commit", commit)
    status = store.append(step)
    assert sorted(r.id for r in store.known("url", asked, status).collect()) == [1, 20] and status.frontier_pages == 9


def test_bytes_of_a_version_follow_the_batch(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    n = 200_000
    full = spark.range(n).select(*[
        (F.concat(F.lit("https://h.example/"), F.md5(F.col("id").cast("string"))) if f.name == "url" else F.col("id") if f.name == "id" else F.lit("FRONTIER")
         if f.name == "page_type_code" else F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.PAGE.fields
    ])
    store.replace({"page": full})
    store.append(changes(spark, [(1, "HTML", "k")], [(n + 1, "FRONTIER", None)]))
    root = str(tmp_path / "s")
    first = in_folder(f"{root}/open_added/v=0") + in_folder(f"{root}/keys_url/base=0")
    later = sum(in_folder(f"{root}/{t}/v=1") for t in ("open_added", "open_removed", "page_settled", "keys_url/later", "keys_content_hash/later"))
    assert first > 10_000_000 and later < first / 200
    assert store.status().frontier_pages == n


def test_a_lookup_reads_the_buckets_of_its_batch(spark, tmp_path):
    rows = spark.range(4000).select(F.concat(F.lit("u"), "id").alias("url"), "id")
    index = KeyIndex(spark, str(tmp_path / "i"), "url", Sizes(bucket_rows=32))
    point = index.write_base(materialize(rows, "rows"), 0)
    assert point.buckets == 128
    batch = materialize(spark.createDataFrame([("u7",), ("u900",), ("none",)], "url string"), "batch")
    found = index.lookup(batch, point, 0)
    assert sorted(map(tuple, found.collect())) == [("u7", 7), ("u900", 900)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    wanted = {int(b) for b in re.findall(r"\d+", re.search(r"PartitionFilters: \[.*?bucket#\d+ IN \(([^)]*)\)", plan).group(1))}
    assert wanted == {r[0] for r in batch.select(index.bucket(point.buckets)).collect()} and len(wanted) <= 3
    read = index._base(point).filter(F.col("bucket").isin(wanted)).select(F.input_file_name().alias("f")).distinct().count()
    assert read <= 3 < index._base(point).select(F.input_file_name().alias("f")).distinct().count()
    assert index.write_base(spark.range(10).selectExpr("cast(id as string) AS url", "id"), 1, 10**15).buckets == MOST_BUCKETS


def test_texts_stay_apart_from_the_state(spark, tmp_path):
    """After the pass over the responses, no exchange carries a text; texts of duplicates are not kept; they meet pages when asked for."""
    import datetime as dt

    store = Store(spark, str(tmp_path / "s"))
    seeds = [(i, None, "FRONTIER", f"https://h.example/{i}", None, None, None, None, 1, None) for i in range(6)]
    store.replace({"page": spark.createDataFrame(seeds, schemas.PAGE)})
    texts = ["<p>a</p>", "<p>b</p>", "<p>a</p>", None, "<a href='/0'>c</a>"]
    fetched = [(i, f"https://h.example/{i}", t, 200, "text/html", "ip", dt.datetime(2024, 1, 1, 0, 0, i)) for i, t in enumerate(texts)]
    fetched += [(1, "https://h.example/1", "<p>late</p>", 200, "text/html", "ip", dt.datetime(2024, 1, 2))]
    inputs = rounds.Inputs(
        spark.createDataFrame(fetched, schemas.FETCHED), spark.createDataFrame([], "domain string, robots_content string"),
        spark.createDataFrame([], "sitemap_url string, xml string"),
    )
    changes = rounds.crawl_round(rounds.load(store), inputs, rounds.Options(agent="loom"))
    for name, df in vars(changes).items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        if name == "texts":
            assert "Exchange" not in plan.replace("BroadcastExchange", "")
        else:
            assert not [scan for scan in re.findall(r"ReadSchema: \S+", plan) if "html_content" in scan], name
    store.append(changes)
    state = rounds.load(store)
    assert "html_content" not in state.page.columns and state.page_text.count() == 3
    want = {0: "<p>\na\n</p>", 1: "<p>\nb\n</p>", 2: None, 3: None, 4: '<a href="/0">\nc\n</a>', 5: None}
    assert {r.id: r.html_content for r in state.full_page().collect()} == want
    store.compact()
    assert {r.id: r.html_content for r in rounds.load(store).full_page().collect()} == want
    assert [tuple(r) for r in state.link.orderBy("from_page").collect()] == [(0, 2), (4, 0)]
