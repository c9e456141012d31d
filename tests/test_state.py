"""Frontier, pages, sites, quality and graph on hand tables and brute force."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from linkloom import schemas
from linkloom.operators import appends, frontier, graph, ids, pages, quality, sites, sitemaps, skew

T0 = dt.datetime(2024, 1, 1)


def page_of(spark, rows):
    """rows: dicts with some page columns."""
    full = [tuple(row.get(f.name) for f in schemas.PAGE.fields) for row in rows]
    return spark.createDataFrame(full, schemas.PAGE)


def tuples(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_skew_join_keeps_every_pair(spark):
    rng = random.Random(3)
    left = [(i, rng.choice(["hot"] * 6 + ["a", "b", "c", None])) for i in range(400)]
    right = [("hot", 1), ("a", 2), ("b", 3), ("b", 4)]
    l, r = spark.createDataFrame(left, "i int, k string"), spark.createDataFrame(right, "k string, v int")
    for how in ("left", "inner", "left_semi", "left_anti"):
        got = skew.skew_join(l, r, "k", F.col("i"), how, slices=10, min_rows=1)
        want = l.join(r, "k", how)
        assert tuples(got, *sorted(want.columns)) == tuples(want, *sorted(want.columns)), how
    hot = skew.hot_keys(skew.key_counts(l, "k"), "k", slices=4, min_rows=1).collect()
    assert [h.k for h in hot] == ["hot"] and hot[0].n_salts >= 2


def test_dense_ids(spark):
    keys = [f"u{i}" for i in range(500)]
    df = spark.createDataFrame([(k,) for k in keys], "url string")
    got = ids.dense_ids(df, "url", start=10, hex_digits=2).collect()
    assert sorted(r.id for r in got) == list(range(11, 511)) and {r.url for r in got} == set(keys)


def test_link_batches(spark):
    bodies = [
        (1, '{"from_page_id": 7, "links": [{"url": "a", "relevance": 1}, {"url": "b", "relevance": 2}]}'),
        (2, '{"from_page_id": null, "links": [{"url": "a", "relevance": 3}]}'), (3, '{"from_page_id": 7, "links": []}'),
        (4, '{"from_page_id": 7'), (5, '{"from_page_id": 7}'),
    ]
    links, rejects = frontier.explode_link_batches(spark.createDataFrame(bodies, "n int, body string"))
    assert tuples(links, "n", "from_page_id", "position", "url", "relevance") == sorted(
        [(1, 7, 0, "a", 1), (1, 7, 1, "b", 2), (2, None, 0, "a", 3)], key=repr)
    assert tuples(rejects, "n") == [(4,), (5,)]


def test_insert_ignore_and_links(spark):
    page = page_of(spark, [{"id": 4, "url": "known", "page_type_code": "FRONTIER", "relevance": 0}])
    batch = spark.createDataFrame(
        [(0, 4, "new", 2), (1, 4, "new", 9), (2, 4, "known", 3), (3, None, "other", 1)],
        "position int, from_page_id long, url string, relevance int")
    new = frontier.insert_ignore(page, batch, F.col("position"))
    assert tuples(new, "url", "relevance", "site_id", "page_type_code") == [("new", 2, None, "FRONTIER"), ("other", 1, None, "FRONTIER")]
    assert sorted(r.id for r in new.collect()) == [5, 6]
    assert frontier.insert_counts(batch, new).first().asDict() == {"n_requested": 4, "n_inserted": 2}
    state = frontier.union_state(page, new)
    assert frontier.insert_ignore(state, batch, F.col("position")).count() == 0
    pairs = frontier.url_to_id(batch, state, slices=5, min_rows=1).withColumnRenamed("from_page_id", "from_page")
    assert pairs.count() == 4
    first = frontier.link_insert_ignore(schemas.empty(spark, "link"), pairs)
    by_url = {r.url: r.id for r in state.collect()}
    assert tuples(first, "from_page", "to_page") == sorted([(4, by_url["new"]), (4, 4)])
    assert frontier.link_insert_ignore(first, pairs).count() == 0
    assert tuples(frontier.raise_relevance(state, batch), "url", "relevance") == [("known", 3), ("new", 9), ("other", 1)]


def test_single_insert_and_seeds(spark):
    page = page_of(spark, [{"id": 1, "url": "k"}])
    batch = spark.createDataFrame([(1, "k"), (2, "n"), (3, "n"), (4, None)], "position int, url string")
    rows, rejects = frontier.frontier_append(page, batch, F.col("position"))
    assert tuples(rows, "id", "url", "site_id", "relevance") == [(2, "n", 3, None)]
    assert tuples(rejects, "position") == [(1,), (3,), (4,)]
    seeds = ["https://H.example/", "https://h.example/#x"]
    assert tuples(frontier.seed_frontier(spark, page, seeds), "url", "relevance") == [("https://h.example", 3)]
    assert len(frontier.seed_frontier(spark, page, seeds, normalize=False).collect()) == 2


def test_topk_and_claim(spark):
    rows = [(1, "http://a/1", "FRONTIER", 1), (2, "http://a/2", "FRONTIER", None), (3, "http://b/3", "FRONTIER", 2),
            (4, "http://a/4", "HTML", 9), (5, "http://a/5", "FRONTIER", 1), (6, "http://b/6", "FRONTIER", 2)]
    page = page_of(spark, [dict(zip(("id", "url", "page_type_code", "relevance"), r)) for r in rows])
    assert [r.id for r in frontier.frontier_topk(page, 4).collect()] == [2, 3, 6, 1]
    for k in (1, 2000):
        got = tuples(frontier.frontier_topk_per_site(page, k).filter("rank <= 1"), "domain", "id")
        assert got == [("a", 2), ("b", 3)]
    now = F.lit(T0).cast("timestamp_ntz")
    claimed = frontier.frontier_claim(page, frontier.frontier_topk(page, 2), now)
    assert tuples(claimed.filter("page_type_code = 'CRAWLING'"), "id", "accessed_time") == [(2, T0), (3, T0)]
    assert frontier.frontier_claim(page, frontier.frontier_topk(page.filter("id = 4"), 2), now).filter("page_type_code='CRAWLING'").count() == 0
    assert frontier.stale_claims(claimed, F.lit(T0 + dt.timedelta(hours=1)).cast("timestamp_ntz")).count() == 2


def test_mark_duplicates_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, T0 + dt.timedelta(seconds=rng.randint(0, 9)), rng.choice(["hot"] * 5 + ["a", "b", "kept", None])) for i in range(1, 301)]
    batch = spark.createDataFrame(rows, "id long, accessed_time timestamp_ntz, content_hash string")
    page = page_of(spark, [{"id": 900, "content_hash": "kept"}])
    want = []
    for i, t, h in rows:
        first = i if h is None else 900 if h == "kept" else min((u, j) for j, u, g in rows if g == h)[1]
        want.append((i, first, first != i))
    for min_rows in (skew.MIN_HOT_ROWS, 1):
        got = pages.mark_duplicates(batch, page, slices=10, min_rows=min_rows)
        assert tuples(got, "id", "original_id", "is_duplicate") == sorted(want, key=repr)
    assert pages.duplicate_links(got).count() == sum(w[2] for w in want)


def test_hash_lookup(spark):
    page = page_of(spark, [{"id": 2, "content_hash": "x"}, {"id": 1, "content_hash": "x"}, {"id": 3}])
    asked = spark.createDataFrame([("x",), ("y",), ("",), (None,)], "content_hash string")
    answers, rejects = pages.hash_lookup(asked, page)
    assert tuples(answers, "content_hash", "exists", "page_id") == [("x", True, 1), ("y", False, None)]
    assert rejects.count() == 2


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_page_update(spark, limit):
    page = page_of(spark, [{"id": i, "site_id": 8, "url": f"u{i}", "page_type_code": "CRAWLING", "relevance": 2} for i in (1, 2, 3)])
    updates = spark.createDataFrame(
        [(1, "HTML", 200, "ip", True, None, "text", "h"), (2, "BINARY", 404, "ip", False, None, "text", None), (9, "HTML", 200, "ip", False, None, "t", "g")],
        "id long, page_type_code string, http_status_code int, accessed_ip string, has_site_id boolean, site_id long, html_content string, content_hash string")
    updated, rejects = pages.page_update(page, updates, F.lit(T0).cast("timestamp_ntz"), limit)
    assert tuples(updated, "id", "page_type_code", "site_id", "html_content", "relevance", "content_hash", "accessed_time") == [
        (1, "HTML", None, "text", 2, "h", T0), (2, "BINARY", 8, None, 2, None, T0), (3, "CRAWLING", 8, None, 2, None, None)]
    assert tuples(rejects, "id") == [(9,)]
    assert pages.html_count(updated).first()[0] == 1
    assert [pages.crawl_done(updated, n, i, 10).first().done for n, i in ((0, 0), (1, 0), (0, 3))] == [True, False, False]


DELAYS = [
    ("10.0.0.1", "a.example", None, 2.0), ("10.0.0.1", "a.example", 3.0, 0.0), ("10.0.0.1", "a.example", 3.5, 0.5),
    ("10.0.0.1", "a.example", 0.0, 0.0), ("10.0.0.1", "a.example", -1.0, 2.0), ("10.0.0.9", "a.example", None, 0.0),
    ("10.0.0.1", "new.example", 60.0, 0.0), ("10.0.0.1", "a.example", float("nan"), 2.0),
]


def test_delay(spark):
    access = spark.createDataFrame([("10.0.0.1", "a.example", T0), ("10.0.0.1", "a.example", T0 - dt.timedelta(1)), ("10.0.0.1", "a.example", None)],
                                   "accessed_ip string, domain string, accessed_time timestamp_ntz")
    requests = spark.createDataFrame([(i, *d) for i, d in enumerate(DELAYS)], "n int, ip string, site_url string, robots_delay double, want double")
    now = F.lit(T0 + dt.timedelta(seconds=3)).cast("timestamp_ntz")
    for mode in ("exact", "like"):
        got = sites.politeness_delay(requests, sites.last_access(access), now, mode).collect()
        assert len(got) == len(DELAYS) and all(abs(r.delay - r.want) < 1e-9 for r in got), mode


def like(domain, text, flags=0):
    """Brute force for domain LIKE %text%."""
    pattern, i, text = "", 0, f"%{text}%"
    while i < len(text):
        if text[i] == "\\":
            i += 1
            pattern += re.escape(text[i])
        else:
            pattern += {"%": ".*", "_": "."}.get(text[i], re.escape(text[i]))
        i += 1
    return re.fullmatch(pattern, domain, flags | re.S) is not None


ASKED = ["example.com", "", "a", "%", "_", "____________", "%_%", "a%c", "b.e_ample", "EXAMPLE", "x\\_y", "x_y", "\\a", "zzz", "a\\", "..", "%.com", "\\\\", "\\_", "____________________"]
DOMAINS = ["example.com", "sub.example.com", "a.b.c", "x_y.org", "xzy.org", "", "AB.example", "a%.net", "b\\c", "com"]


def test_like_modes_against_brute_force(spark):
    rng = random.Random(9)
    site = spark.createDataFrame([(i + 1, d, None, None) for i, d in enumerate(DOMAINS + DOMAINS[:3])], schemas.SITE)
    asked = spark.createDataFrame([(d,) for d in ASKED], "domain string")
    got = {r.domain: (r.exists, r.site_id) for r in sites.site_lookup(asked, site, "like").collect()}
    for text in ASKED:
        hits = [i + 1 for i, d in enumerate(DOMAINS) if like(d, text, re.I)]
        assert got[text] == (bool(hits), min(hits, default=None)), text
    rows = [(f"ip{rng.randint(0, 2)}", rng.choice(DOMAINS), T0 + dt.timedelta(seconds=rng.randint(0, 999))) for _ in range(60)]
    access = spark.createDataFrame(rows, "accessed_ip string, domain string, accessed_time timestamp_ntz")
    requests = spark.createDataFrame([(t, f"ip{i}", 10_000.0) for t in ASKED for i in range(3)], "site_url string, ip string, robots_delay double")
    pairs = sites.access_join(access, requests, "like")
    want = sorted((t, f"ip{i}", d, when) for t in ASKED for i in range(3) for ip, d, when in rows if ip == f"ip{i}" and like(d, t))
    assert sorted((r.site_url, r.ip, r.domain, r.accessed_time) for r in pairs.collect()) == want
    now = F.lit(T0 + dt.timedelta(seconds=1000)).cast("timestamp_ntz")
    for r in sites.politeness_delay(requests, sites.last_access(access), now, "like").collect():
        times = [w[3] for w in want if w[:2] == (r.site_url, r.ip)]
        expected = max(0, 10_000 - 1000 + (max(times) - T0).seconds) if times else 0
        assert abs(r.delay - expected) < 1e-6, (r, expected)


def test_sites_created_once(spark):
    site = spark.createDataFrame([(3, "a.example", "r", None)], schemas.SITE)
    wanted = spark.createDataFrame([("a.example", "x", None), ("b.example", "y", ""), ("b.example", "y", ""), ("example", None, None)],
                                   "domain string, robots_content string, sitemap_content string")
    new = sites.site_get_or_create(site, wanted)
    assert tuples(new, "domain", "robots_content") == [("b.example", "y"), ("example", None)]
    assert sorted(r.id for r in new.collect()) == [4, 5]
    assert tuples(sites.site_get_or_create(site, wanted, "like"), "domain") == [("b.example",)]


def test_access_from_tables(spark):
    site = spark.createDataFrame([(1, "a", None, None), (2, "b", None, None), (3, "a", None, None)], schemas.SITE)
    page = page_of(spark, [{"id": i, "site_id": s, "accessed_ip": "ip", "accessed_time": T0 + dt.timedelta(seconds=i)} for i, s in enumerate((1, 1, 2, 3, None))])
    joined = sites.site_access(site, page, slices=3, min_rows=1)
    assert joined.count() == 4
    assert tuples(sites.last_access(joined), "domain", "accessed_time") == tuples(sites.last_page_access(site, page), "domain", "accessed_time")


def test_appends(spark):
    image = schemas.empty(spark, "image")
    new = spark.createDataFrame(
        [(1, "f1", "image", "aGk=", "2024-01-01T00:00:00.5"), (1, "f2", "image", "", None), (1, "f3", "image", "a", None), (1, "f4", "image", "aGk=", "never"), (1, "f5", "image", None, None)],
        "page_id long, filename string, content_type string, data string, accessed_time string")
    rows, rejects = appends.image_append(image, new, "filename")
    assert [(f, bytes(d), t) for f, d, t in tuples(rows, "filename", "data", "accessed_time")] == [("f1", b"hi", dt.datetime(2024, 1, 1, 0, 0, 0, 500000)), ("f2", b"", None)]
    assert tuples(rejects, "filename") == [("f3",), ("f4",), ("f5",)]
    link = spark.createDataFrame([(1, 2)], schemas.LINK)
    pairs = spark.createDataFrame([(0, 1, 2), (1, 1, 3), (2, 1, 3), (3, None, 3)], "n int, from_page long, to_page long")
    rows, rejects = appends.link_append_strict(link, pairs, F.col("n"))
    assert tuples(rows, "from_page", "to_page") == [(1, 3)] and tuples(rejects, "n") == [(0,), (2,), (3,)]
    data = spark.createDataFrame([("k", 5, "PDF", None)], "k string, page_id long, data_type_code string, data binary")
    assert tuples(appends.page_data_append(schemas.empty(spark, "page_data"), data, "k"), "id", "page_id", "data_type_code", "data") == [(1, 5, "PDF", None)]


def test_image_data_is_decoded_once(spark):
    """Line breaks and other characters are skipped; the rows and the count of a bucket each decode data once."""
    new = spark.createDataFrame(
        [(1, "f1", "image", "aG\r\nk=", None), (1, "f2", "image", "-a!G*k\u00e9=", None), (1, "f3", "image", "a\r\n", None), (1, "f4", "image", "aG= =", None)],
        "page_id long, filename string, content_type string, data string, accessed_time string")
    rows, rejects = appends.image_append(schemas.empty(spark, "image"), new, "filename")
    assert [(f, bytes(d)) for f, d in tuples(rows, "filename", "data")] == [("f1", b"hi"), ("f2", b"hi"), ("f4", b"h")]
    assert tuples(rejects, "filename") == [("f3",)]
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(data") == 2


@pytest.mark.parametrize("kind,body,ok", [
    ("site", '{"domain": "a"}', True), ("site", '{"domain": "a", "robots_content": null}', True), ("site", '{"domain": null}', False),
    ("site", '{"domain": 1}', False), ("site", "{}", False), ("site", "[1]", False), ("site", '{"domain": "a"', False), ("site", None, False),
    ("delay", '{"site_url": "a", "ip": "i"}', True), ("delay", '{"site_url": "a", "ip": "i", "robots_delay": "3"}', True),
    ("delay", '{"site_url": "a", "ip": "i", "robots_delay": "x"}', False), ("delay", '{"site_url": "a"}', False),
    ("link", '{"from_page": 1, "to_page": "2"}', True), ("link", '{"from_page": 1, "to_page": 1.5}', False), ("link", '{"from_page": 1}', False),
    ("page", '{"page_type_code": "HTML", "accessed_ip": "i", "http_status_code": 200, "extra": 1}', True),
])
def test_contracts(spark, kind, body, ok):
    good, rejects = quality.validate_rows(spark.createDataFrame([(body,)], "body string"), kind)
    assert (good.count(), rejects.count()) == ((1, 0) if ok else (0, 1))


def test_text_delay_counts_as_missing(spark):
    bodies = [('{"site_url": "a", "ip": "i", "robots_delay": "3"}',), ('{"site_url": "b", "ip": "i", "robots_delay": 3}',)]
    good, _ = quality.validate_rows(spark.createDataFrame(bodies, "body string"), "delay")
    assert tuples(good, "site_url", "robots_delay") == [("a", None), ("b", 3.0)]


def test_constraints(spark):
    page = page_of(spark, [{"id": 1, "url": "u", "page_type_code": "HTML", "content_hash": "h"}, {"id": 2, "url": "u", "page_type_code": "ODD", "content_hash": None},
                           {"id": 3, "url": "v", "content_hash": "h", "site_id": 5}, {"id": 4}])
    link = spark.createDataFrame([(1, 2), (1, 2), (1, 7)], schemas.LINK)
    tables = {"page": page, "link": link, "site": schemas.empty(spark, "site")}
    assert tuples(quality.fk_violations(tables), "constraint", "value", "n_rows") == [("link.to_page", "7", 1), ("page.page_type_code", "ODD", 1), ("page.site_id", "5", 1)]
    assert tuples(quality.unique_violations(tables), "constraint", "value", "n_rows") == [("link.from_page,to_page", "1,2", 2), ("page.content_hash", "h", 2), ("page.url", "u", 2)]
    good, rejects = quality.length_checks(page_of(spark, [{"id": 1, "url": "x" * 3000}, {"id": 2, "url": "x" * 3001}, {"id": 3}]), "page")
    assert tuples(good, "id") == [(1,), (3,)] and tuples(rejects, "id") == [(2,)]


def test_reachable(spark):
    link = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 3), (1, 2), (7, 8), (3, 4), (1, 3)], schemas.LINK)
    seeds = spark.createDataFrame([(1,), (1,)], "id long")
    assert tuples(graph.reachable_pages(link, seeds), "id", "depth") == [(1, 0), (2, 1), (3, 1), (4, 2)]
    assert tuples(graph.reachable_pages(link, seeds, 1), "id", "depth") == [(1, 0), (2, 1), (3, 1)]


SITEMAP = '<?xml version="1.0"?><{0} xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">{1}</{0}>'
FILES = [
    ("a", SITEMAP.format("urlset", "<url><loc> https://h/1 </loc><lastmod>x</lastmod></url><url><loc>https://h/2</loc></url>")),
    ("b", SITEMAP.format("sitemapindex", "<sitemap><loc>https://h/s.xml</loc></sitemap>")),
    ("c", "<urlset><url><loc>https://h/no</loc></url></urlset>"), ("d", SITEMAP.format("urlset", "<url><loc>https://h/x</loc>")),
    ("e", SITEMAP.format("urlset", "<url><loc>https://h/y</loc></url><url><loc/></url>")), ("f", ""), ("g", None),
]


def test_sitemaps(spark):
    found = sitemaps.sitemap_urls(spark.createDataFrame(FILES, "sitemap_url string, xml string"))
    assert tuples(found, "sitemap_url", "position", "url") == [("a", 0, "https://h/1"), ("a", 1, "https://h/2"), ("b", 0, "https://h/s.xml")]
    site = spark.createDataFrame([("h", "Sitemap: b\nSitemap: a"), ("i", "User-agent: *"), ("j", None)], "domain string, robots_content string")
    from linkloom.operators import robots
    content = sitemaps.sitemap_content(site, robots.robots_sitemaps(site), found)
    assert {r.domain: r.sitemap_content for r in content.collect()} == {"h": "https://h/s.xml https://h/1 https://h/2 ", "i": "", "j": None}
    rules = robots.robots_rules(spark.createDataFrame([("h", "User-agent: *\nDisallow: /2")], "domain string, robots_content string"), "x")
    rows = sitemaps.sitemap_frontier(robots.robots_sitemaps(site), found, rules)
    assert tuples(rows, "url", "relevance") == [("https://h/1", 3), ("https://h/s.xml", 3)]
