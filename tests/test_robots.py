"""Robots columns against the standard library's robots parser."""

import random
from urllib.robotparser import RobotFileParser

from pyspark.sql import functions as F

from linkloom.operators import robots as R

AGENT = "Loom-Bot/1.0"
HAND = [
    "User-agent: *\nDisallow: /d\nAllow: /d/x", "User-agent: *\nAllow: /d/x\nDisallow: /d",
    "User-agent: loom\nDisallow: /a\n\nUser-agent: *\nDisallow: /", "User-agent: *\nDisallow: /\n\nUser-agent: LOOM-bot\nDisallow:",
    "User-agent: x\nUser-agent: loom-bot\nDisallow: /a", "User-agent: loom\n\nDisallow: /a", "User-agent: loom\n# c\nDisallow: /a",
    "User-agent: loom\n   \nDisallow: /a", "Disallow: /a", "User-agent: *\nDisallow:", "User-agent:\nDisallow: /a",
    "User-agent: *\nDisallow: /*.pdf\nDisallow: *\nDisallow: /x$", "User-agent: *\nCrawl-delay: 3\nCrawl-delay: x",
    "User-agent: *\nCrawl-delay: 0", "User-agent: *\nCrawl-delay: 1.5\nDisallow: /", "User-agent: *\nSitemap: https://h/s.xml\nDisallow: /a",
    "Sitemap: https://h/1.xml\r\nUser-agent: *\r\nDisallow: /a\r\nSitemap: https://h/%61.xml", "", "nonsense", "User-agent: *\nDisallow: /a?\nAllow: /",
    "User-agent: *\nDisallow: /a%20b\nDisallow: /%7Euser\nDisallow: /a+b\nDisallow: /%zz\nDisallow: /ünï",
    "User-agent: *\nDisallow: /a;\nRequest-rate: 1/5\n\nUser-agent: *\nDisallow: /b",
]
PATHS = ["", "/", "/a", "/a/b", "/d", "/d/x", "/x", "/a b", "/~user/", "/a+b", "/%zz", "/ünï/x", "/z.pdf", "/a;b", "//h/a", "x", "/%3Fa", "/*", "/b"]
DOMAIN = "d{}.example"


def random_files(n, seed):
    rng = random.Random(seed)
    lines = ["User-agent: *", "User-agent: loom", "User-agent: other", "User-agent: ", "Disallow: /a", "Disallow: /", "Disallow:",
             "Allow: /a/b", "Allow: /", "Disallow: /d", "Crawl-delay: 3", "Crawl-delay: x", "Crawl-delay: 7", "Request-rate: 1/2",
             "Sitemap: https://h/s.xml", "# comment", "", "", "   ", "Other: x", "User-agent: loom-bot # c", "nocolon"]
    return ["\n".join(rng.choices(lines, k=rng.randint(0, 14))) for _ in range(n)]


def parser(text):
    rp = RobotFileParser()
    rp.parse(text.splitlines())
    return rp


def sites_of(spark, files):
    return spark.createDataFrame([(DOMAIN.format(i), t) for i, t in enumerate(files)], "domain string, robots_content string")


def test_verdicts_and_delays(spark, monkeypatch):
    files = HAND + random_files(700, 11)
    sites = sites_of(spark, files)
    links = [(i, p, f"https://{DOMAIN.format(i)}{p}" if p[:1] in ("", "/") else p) for i in range(len(files)) for p in PATHS]
    df = spark.createDataFrame([(i, p, u) for i, p, u in links if p != "x"], "i int, path string, link string")
    rules = R.robots_rules(sites, AGENT)
    for min_rows in (R.MIN_HOT_ROWS, 1):
        if min_rows == 1:  # as if nothing could be broadcast
            monkeypatch.setattr(R, "fits_broadcast", lambda df: False)
        got = R.robots_allowed(df, rules, slices=50, min_rows=min_rows).collect()
        assert len(got) == df.count()
        parsers = [parser(t) for t in files]
        wrong = [(files[r.i], r.path, r.allowed) for r in got if r.allowed != parsers[r.i].can_fetch(AGENT, r.path)]
        assert not wrong, (len(wrong), wrong[:10])
    delays = {r.domain: r.crawl_delay for r in R.crawl_delays(sites, AGENT).collect()}
    assert {i: delays.get(DOMAIN.format(i)) for i in range(len(files))} == {i: p.crawl_delay(AGENT) for i, p in enumerate(parsers)}
    maps = {}
    for r in R.robots_sitemaps(sites).orderBy("domain", "line_no").collect():
        maps.setdefault(r.domain, []).append(r.sitemap_url)
    assert {i: maps.get(DOMAIN.format(i)) for i in range(len(files))} == {i: p.site_maps() for i, p in enumerate(parsers)}


def test_links_without_host_are_allowed(spark):
    rules = R.robots_rules(sites_of(spark, ["User-agent: *\nDisallow: /"]), AGENT)
    links = spark.createDataFrame([("mailto:a@b",), ("https://unknown.example/",), ("https://d0.example/x",)], "link string")
    assert {r.link: r.allowed for r in R.robots_allowed(links, rules).collect()} == {
        "mailto:a@b": True, "https://unknown.example/": True, "https://d0.example/x": False}


def test_error_pages_give_no_rules(spark):
    robots = spark.createDataFrame([("a", "User-agent: *\nDisallow: /", 404), ("b", "User-agent: *\nDisallow: /", 200)],
                                   "domain string, robots_content string, status int")
    assert [r.domain for r in R.robots_rules(R.served(robots), AGENT).collect()] == ["b"]


def test_lowest_site_id_gives_the_rules(spark):
    sites = spark.createDataFrame([(2, "a", "x"), (1, "a", None), (3, "b", "y")], "id long, domain string, robots_content string")
    assert sorted((r.domain, r.robots_content) for r in R.one_robots_per_domain(sites).collect()) == [("a", None), ("b", "y")]


def test_rules_need_no_python_and_one_shuffle(spark):
    plan = R.robots_rules(sites_of(spark, HAND), AGENT)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(domain") == 1 and "Python" not in plan


def test_many_rules_cost_a_link_no_more_than_their_lengths(spark):
    """10,000 rules of one domain have few lengths: each path is looked up once per length, once for all its links."""
    rng = random.Random(6)
    paths = list(dict.fromkeys("/" + "".join(rng.choices("abcd", k=rng.randint(1, 12))) for _ in range(40_000)))[:10_000]
    order = [(path, rng.random() < 0.5) for path in paths]
    rules = spark.createDataFrame([("big.example", i, p, a) for i, (p, a) in enumerate(order)], "domain string, line_no int, path string, allow boolean")
    asked = ["/" + "".join(rng.choices("abcd", k=rng.randint(0, 14))) for _ in range(5000)] * 4
    links = spark.createDataFrame([(f"https://big.example{p}",) for p in asked], "link string")
    got = {r.link: r.allowed for r in R.robots_allowed(links, rules).distinct().collect()}
    first = {p: (i, a) for i, (p, a) in reversed(list(enumerate(order)))}
    for path in set(asked):
        hits = [first[path[:n]] for n in range(len(path) + 1) if path[:n] in first]
        assert got[f"https://big.example{path}"] == (min(hits)[1] if hits else True)
    index = R.prefix_index(rules)
    assert len(paths) == 10_000 and index.select("length").distinct().count() <= 13
    places = spark.createDataFrame([("big.example", p) for p in set(asked)], "domain string, path string")
    plan = R.denied_paths(places, index)._jdf.queryExecution().executedPlan().toString()
    assert "startswith" in plan.lower() and "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
