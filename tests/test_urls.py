"""URL columns against the standard library's URL parser, on hand cases and seeded random links."""

import random
from urllib.parse import urljoin, urlsplit

import pytest
from pyspark.sql import functions as F

from linkloom.constants import INDEX_NAMES, VOID_LINK
from linkloom.functions import urls

BASES = [
    "http://h.example/a/b/c.html", "https://h.example", "https://h.example/", "http://h.example/a//b/;p/q;r?x=1#f",
    "https://H.Example:8080/Dir/sub/?q", "h.example", "mailto:a@b.example",
]
HAND = [
    "", "?q", "#f", ".", "..", "./", "../", "../../../", "../../x", "//h/y", "///x", "//", "//?q", "x//y", "/x/../y",
    "/x/./y/.", "/x/..", "/index.html", "/x/myindex.html", "/x/Default.ASPX", "index.htm", "/x/index.html/",
    "MiXeD/Case", "JavaScript:void(0)", " javascript:void(0)", "mailto:a@b", "tel:+1 2", "a//", "/a//", "//h//",
    "\tx\ny", " /lead", "/trail ", "/ünï/Çode", "a;p", "/a;p/b;q", "..;x", ";x", "a?b/../c", "http:foo", "1:2", "a:b",
    "/x　", " /x", "/a b|c", "HTTP://Other.Example/Path/", "/x/index.html?q=1", "/x/index.html#t", "x/../..",
]


def expected(base, link):
    if not urlsplit(link).scheme:
        link = urljoin(base, link)
    text = link.strip().lower().split("#")[0].split("?")[0]
    text = text.removesuffix("/")
    return text.rsplit("/", 1)[0] if text.endswith(INDEX_NAMES) else text


def random_links(n, seed):
    rng = random.Random(seed)
    parts = ["a", "/", "..", ".", "//", "?", "#", "index.html", "b", "x.pdf", ";", "B"]
    return ["".join(rng.choices(parts, k=rng.randint(1, 7))) for _ in range(n)]


def test_normalize_agrees_with_url_parser(spark):
    links = sorted(set(HAND + random_links(600, 7)))
    rows = [(base, link) for base in BASES for link in links if link != VOID_LINK]
    df = urls.normalize_links(spark.createDataFrame(rows, "base string, link string"))
    wrong = [
        (r.base, r.link, r.url, expected(r.base, r.link)) for r in df.collect() if r.url != expected(r.base, r.link)
    ]
    assert not wrong, wrong[:20]


def test_void_link_dropped_only_when_exact(spark):
    rows = [("http://h.example", VOID_LINK), ("http://h.example", "JavaScript:void(0)")]
    out = urls.normalize_links(spark.createDataFrame(rows, "base string, link string")).collect()
    assert [r.url for r in out] == ["javascript:void(0)"]


def test_bad_brackets_become_null(spark):
    rows = [("http://h.example", "//[::1/x")]
    assert urls.normalize_links(spark.createDataFrame(rows, "base string, link string")).first().url is None


def test_domain_and_path(spark):
    cases = HAND + BASES + ["http://u:p@h:80/x?y", "https://h?x", "http://a b|c/d"]
    df = spark.createDataFrame([(c,) for c in cases], "url string")
    for row in df.select("url", urls.domain_of(F.col("url")).alias("d"), urls.path_of(F.col("url")).alias("p")).collect():
        split = urlsplit(row.url)
        assert (row.d, row.p) == (split.netloc, split.path), row.url


@pytest.mark.parametrize("url,code", [
    ("http://h/a.HTML", "HTML"), ("http://h/a.htm", "HTML"), ("http://h/robots.txt", "HTML"), ("http://h/a.pdf", "PDF"),
    ("http://h/a.JPG", "BINARY"), ("http://h/a.jpeg", "BINARY"), ("http://h/a.png", "BINARY"), ("http://h/a.doc", "DOC"),
    ("http://h/a.docx", "DOCX"), ("http://h/a.ppt", "PPT"), ("http://h/a.pptx", "PPTX"), ("http://h/a.gif", "HTML"),
    ("http://h/a", "HTML"), ("", "HTML"),
])
def test_url_type(spark, url, code):
    df = spark.createDataFrame([(url,)], "url string")
    assert df.select(urls.url_type(F.col("url"))).first()[0] == code


def test_relevance_defaults(spark):
    rows = [
        ("https://slo-tech.com/novice/1", 2), ("https://slo-tech.com/x", 1), ("https://www.slo-tech.com/forum", 1),
        ("https://h/clanki/forum", 1), ("https://h/x", 0), ("mailto:x", 0),
    ]
    df = spark.createDataFrame(rows, "url string, want int")
    assert all(r.got == r.want for r in df.withColumn("got", urls.relevance(F.col("url"))).collect())


def test_same_site_keeps_contained_host(spark):
    seed = "https://h.example/start"
    rows = [
        ("/x", "https://h.example/x"), ("https://h.example/y", "https://h.example/y"), ("https://other/z", None),
        ("https://other/?u=https://h.example", "https://other/?u=https://h.example"), ("x", None),
    ]
    df = spark.createDataFrame(rows, "href string, want string")
    got = df.withColumn("got", urls.same_site(F.col("href"), F.lit(seed))).collect()
    assert all(r.got == r.want for r in got)
