"""What keeps rounds whole and balanced: repeated responses, large top-k, hot keys, delays, scratch folders."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from linkloom import schemas, session
from linkloom.operators import frontier, graph, schedule, sitemaps, sites, skew
from linkloom.plans import rounds
from linkloom.sources.store import Store

T0 = dt.datetime(2024, 1, 1)


def page_table(spark, rows):
    """Page rows from dicts; all other columns are NULL."""
    return spark.createDataFrame([tuple(row.get(name) for name in schemas.PAGE.names) for row in rows], schemas.PAGE)


@pytest.mark.parametrize("k", [1, 2, 7, 50, 199, 200, 300])
def test_large_topk_equals_the_merged_one(spark, k):
    rng = random.Random(k)
    ids = rng.sample(range(-1000, 10**12), 100) + list(range(5_000, 5_100))
    rows = [(i, rng.choice([None, 0, 0, 0, 1, 2])) for i in ids]
    df = session.materialize(spark.createDataFrame(rows, "id long, relevance int"), "rows")
    want = sorted(rows, key=lambda r: (r[1] is not None, -(r[1] or 0), r[0]))[:k]
    got = frontier.best_rows(df, k, limit=0, ranges=3).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_large_topk_merges_nothing_in_one_task(spark):
    df = session.materialize(spark.range(5000).select("id", (F.col("id") % 3).cast("int").alias("relevance")), "rows")
    plan = frontier.best_rows(df, 2000)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "TakeOrdered" not in plan
    assert frontier.best_rows(df.limit(0), 2000).count() == 0


def test_first_of_several_responses_counts(spark):
    store = Store(spark, session.new_folder(spark, "store"))
    urls = ["https://h.example/a", "https://h.example/b"]
    store.replace({"page": page_table(spark, [{"id": i, "url": u, "page_type_code": "FRONTIER"} for i, u in enumerate(urls)])})
    fetched = [
        (9, urls[0], "<p>late</p>", 200, "text/html", "10.0.0.1", T0 + dt.timedelta(seconds=5)),
        (9, urls[0], "<p>early</p>", 200, "text/html", "10.0.0.1", T0),
        (9, urls[0], "<p>early</p>", 200, "text/html", "10.0.0.1", T0),
        (9, urls[1], "<p>other</p>", 200, "text/html", "10.0.0.1", T0),
    ]
    inputs = rounds.Inputs(
        spark.createDataFrame(fetched, schemas.FETCHED), spark.createDataFrame([], "domain string, robots_content string"),
        spark.createDataFrame([], "sitemap_url string, xml string"),
    )
    changes = rounds.crawl_round(rounds.load(store), inputs, rounds.Options(agent="loom"))
    assert sorted((r.id, r.html_content) for r in changes.settled_pages().collect()) == [(0, "<p>\nearly\n</p>"), (1, "<p>\nother\n</p>")]


def test_rounds_leave_no_intermediate_tables_and_claim_what_is_missing(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    rows = [{"id": i, "url": f"https://h.example/{i}", "page_type_code": "FRONTIER", "relevance": i} for i in range(6)]
    store.replace({"page": page_table(spark, rows)})
    asked = []

    def fetch(claimed):
        asked.append(sorted(r.id for r in claimed.collect()))
        return claimed.select(
            "id", "url", F.concat(F.lit("<p>"), "url").alias("html"), F.lit(200).alias("http_status_code"), F.lit("text/html").alias("content_type"),
            F.lit("10.0.0.1").alias("accessed_ip"), F.lit(T0).cast("timestamp_ntz").alias("accessed_time"),
        )

    inputs = rounds.Inputs(
        fetch, spark.createDataFrame([], "domain string, robots_content string"), spark.createDataFrame([], "sitemap_url string, xml string"),
    )
    shared = session.shared_folder(spark)
    before = set(os.listdir(shared))
    assert rounds.crawl_to_limit(store, inputs, rounds.Options(agent="loom"), max_pages=3, only_missing=True) == 1
    assert asked == [[2, 3, 4, 5]]
    assert not [name for name in set(os.listdir(shared)) - before if os.listdir(f"{shared}/{name}")]
    tables = {name: df.count() for name, df in store.read().items()}
    assert store.compact().html_pages == 4
    assert {name: df.count() for name, df in store.read().items()} == tables


def test_claims_wait_for_their_site(spark):
    site = spark.createDataFrame(
        [(1, "slow.example", "User-agent: *\nCrawl-delay: 60", None), (2, "fast.example", None, None)], schemas.TABLES["site"],
    )
    seen = {"page_type_code": "HTML", "accessed_ip": "10.0.0.1", "accessed_time": T0}
    page = page_table(spark, [
        {"id": 1, "url": "https://slow.example/1", "site_id": 1, **seen}, {"id": 2, "url": "https://fast.example/1", "site_id": 2, **seen},
        *({"id": i, "url": f"https://{host}/x", "page_type_code": "FRONTIER"} for i, host in ((3, "slow.example"), (4, "fast.example"), (5, "new.example"))),
    ])

    def claimed(seconds, ip="10.0.0.1"):
        options = rounds.Options(agent="loom", ip=ip, now=T0 + dt.timedelta(seconds=seconds), due_only=True)
        return sorted(r.id for r in rounds.claim(page, options, site).collect())

    assert [claimed(s) for s in (1, 5, 59, 60)] == [[5], [4, 5], [4, 5], [3, 4, 5]]
    assert claimed(1, "10.0.0.2") == [3, 4, 5]


def test_lookup_join_keeps_alike_rows_of_hot_keys(spark):
    rows = [("hot",)] * 5000 + [(None,)] * 300 + [("lost",)] * 2000 + [(f"k{i}",) for i in range(50)]
    left = session.materialize(spark.createDataFrame(rows, "key string"), "left")
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("unused", 3)], "key string, value int")
    got = skew.lookup_join(left, right, "key", slices=5, min_rows=10).groupBy("key", "value").count().collect()
    want = {("hot", 1): 5000, (None, None): 300, ("lost", None): 2000, ("k1", 2): 1}
    assert {(r.key, r.value): r["count"] for r in got if (r.key, r.value) in want} == want
    assert sum(r["count"] for r in got) == len(rows)
    found = sites.site_lookup(left.withColumnRenamed("key", "domain"), spark.createDataFrame([(7, "hot")], "id long, domain string"), slices=5, min_rows=10)
    assert {(r.exists, r.site_id): r["count"] for r in found.groupBy("exists", "site_id").count().collect()} == {(True, 7): 5000, (False, None): 2350}


NS = "http://www.sitemaps.org/schemas/sitemap/0.9"
SITEMAPS = [
    (f'<s:urlset xmlns:s="{NS}"><s:url><s:loc>u</s:loc><loc>no</loc></s:url></s:urlset>', ["u"]),
    (f'<feed><urlset xmlns="{NS}"><url><loc> u </loc></url><url><x><loc lang="e">v</loc></x></url></urlset></feed>', ["u", "v"]),
    (f'<urlset xmlns="{NS}" xmlns:i="other"><url><loc>u</loc><i:loc>no</i:loc></url></urlset>', ["u"]),
    (f'<urlset xmlns="{NS}"><url><loc><![CDATA[a&b]]></loc></url><url><loc>a&amp;b<!-- c --></loc></url></urlset>', ["a&b", "a&b"]),
    (f'<urlset xmlns="{NS}"><!-- <url><loc>no</loc></url> --><url><loc>u</loc></url></urlset>', ["u"]),
    (f'<urlset xmlns="{NS}"><url><loc>u</loc></url><url><loc/></url></urlset>', []),
    (f'<urlset xmlns="{NS}"><url><loc>u</loc></url>', []),
    (f'<urlset xmlns="{NS}"><url><loc>u</loc><x>&</x></url></urlset>', []),
    ('<urlset xmlns="other"><url><loc>u</loc></url></urlset>', []), ('<urlset><url><loc>u</loc></url></urlset>', []), ("", []), (None, []), ("text", []),
]


def test_locations_at_any_depth_and_prefix(spark):
    files = spark.createDataFrame([(i, xml) for i, (xml, _) in enumerate(SITEMAPS)], "i int, xml string")
    found = {}
    for row in sitemaps.sitemap_urls(files).orderBy("i", "position").collect():
        found.setdefault(row.i, []).append(row.url)
    assert found == {i: want for i, (_, want) in enumerate(SITEMAPS) if want}


@pytest.mark.parametrize("limit", [1000, 1])
def test_schedules_keep_the_delay(spark, limit):
    """No two slots of a site are closer than its delay, none is before the site may be asked, or beyond the horizon; and the best
    pages come first."""
    now = T0 + dt.timedelta(seconds=10)
    rows = [(i, f"https://{('slow', 'free', 'odd', 'new')[i % 4]}.example/{i}" if i % 9 else f"mailto:{i}", (None, 1, 2)[i % 3]) for i in range(400)]
    df = session.materialize(spark.createDataFrame(rows, "id long, url string, relevance int"), "rows")
    latest = spark.createDataFrame([("ip", "slow.example", now - dt.timedelta(seconds=3)), ("other", "new.example", now), ("ip", "odd.example", now)],
                                   "accessed_ip string, domain string, accessed_time timestamp_ntz")
    delays = spark.createDataFrame([("slow.example", 60), ("free.example", 0), ("odd.example", -1)], "domain string, crawl_delay long")
    got = schedule.fetch_schedule(df, latest, delays, "ip", F.lit(str(now)).cast("timestamp_ntz"), 600.0, limit=limit).collect()
    best = sorted(rows, key=lambda r: (r[2] is not None, -(r[2] or 0), r[0]))
    want = {}
    for domain, first, delay in (("slow.example", 57, 60), ("free.example", 0, 0), ("odd.example", 5, 5), ("new.example", 0, 5), ("", 0, 5)):
        own = [r[0] for r in best if (r[1].split("/")[2] if "//" in r[1] else "") == domain]
        want |= {i: now + dt.timedelta(seconds=first + k * delay) for k, i in enumerate(own) if first + k * delay <= 600}
    assert {r.id: r.not_before for r in got} == want and len(got) == len(want)


def test_rounds_claim_by_schedule(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    rows = [{"id": i, "url": f"https://h{i % 2}.example/{i}", "page_type_code": "FRONTIER", "relevance": i} for i in range(10)]
    store.replace({"page": page_table(spark, rows)})
    asked = []

    def fetch(claimed):
        asked.append(sorted((r.id, r.not_before) for r in claimed.collect()))
        return claimed.select(
            "id", "url", F.concat(F.lit("<p>"), "url").alias("html"), F.lit(200).alias("http_status_code"), F.lit("text/html").alias("content_type"),
            F.lit("ip").alias("accessed_ip"), F.col("not_before").alias("accessed_time"),
        )

    inputs = rounds.Inputs(
        fetch, spark.createDataFrame([("h0.example", "User-agent: *\nCrawl-delay: 2")], "domain string, robots_content string"),
        spark.createDataFrame([], "sitemap_url string, xml string"),
    )
    options = rounds.Options(agent="loom", ip="ip", now=T0, horizon=5.0)
    rounds.crawl_to_limit(store, inputs, options, max_rounds=1)
    # The robots file of a site is read when it is claimed first, so its delay holds from the next round on.
    assert asked == [[(6, T0 + dt.timedelta(seconds=5)), (7, T0 + dt.timedelta(seconds=5)), (8, T0), (9, T0)]]
    rounds.crawl_to_limit(store, inputs, rounds.Options(agent="loom", ip="ip", now=T0 + dt.timedelta(seconds=6), horizon=3.0), max_rounds=1)
    assert asked[1] == [(2, T0 + dt.timedelta(seconds=9)), (4, T0 + dt.timedelta(seconds=7))]


def test_sitemap_texts_in_parts(spark):
    """Parts of a site over the size of one are bounded by it and a URL, and make up the whole text."""
    urls = [f"https://big.example/{i:03}/{'x' * (i % 11)}" for i in range(500)]
    listed = spark.createDataFrame([("big.example", 0, "a"), ("big.example", 1, "b"), ("small.example", 0, "c")], "domain string, line_no int, sitemap_url string")
    found = spark.createDataFrame([("a" if i < 300 else "b", i, u) for i, u in enumerate(urls)] + [("c", 0, "u" * 900)], "sitemap_url string, position int, url string")
    parts = sitemaps.sitemap_parts(listed, found, part_bytes=256).orderBy("part").collect()
    own = [r.text for r in parts if r.domain == "big.example"]
    assert "".join(own) == "".join(f"{u} " for u in urls) and max(map(len, own)) <= 256 + 40 and len(own) > 40
    assert [r.text for r in parts if r.domain == "small.example"] == ["u" * 900 + " "]
    site = spark.createDataFrame([("big.example", "r"), ("small.example", None), ("none.example", "r")], "domain string, robots_content string")
    got = {r.domain: r.sitemap_content for r in sitemaps.sitemap_content(site, listed, found).collect()}
    assert got == {"big.example": "".join(own), "small.example": None, "none.example": ""}


def test_long_ways_have_short_plans_and_links_stay_in_place(spark):
    """A path of 30 levels with side ways: the plan of the result holds no more tables than a fold, and a large level is dealt to
    the buckets of the links, not the links to it."""
    link = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(i, 100 + i % 3) for i in range(30)] + [(5, 2), (None, 7), (7, None)], "from_page long, to_page long")
    got = graph.reachable_pages(link, spark.createDataFrame([(0,)], "id long"))
    want = {i: i for i in range(31)} | {100: 1, 101: 2, 102: 3}
    assert {r.id: r.depth for r in got.collect()} == want and got.count() == len(want)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation") <= graph.FOLD_LEVELS + 1
    edges = graph._by_source(link)
    level = session.materialize(spark.range(3), "level")
    plan = graph.next_level(spark.table(edges), level, graph.BROADCAST_LEVEL + 1, level)._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan
    scan = plan[plan.index(edges) - 400 : plan.index(edges)]
    assert "Exchange" not in scan and spark.table(edges).count() == 61
    spark.sql(f"DROP TABLE {edges}")
