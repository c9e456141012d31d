import hashlib
import html as stdlib_html
from html import entities

import pytest
from pyspark.sql import functions as F

from linkloom.functions import html as H
from linkloom.operators import links as L

PAGE = "https://h.example/dir/page.html"
LINK_CASES = [
    ('<a href="/x">t</a>', ["https://h.example/x"]),
    ("<a href='/x'>t</a>", ["https://h.example/x"]),
    ("<a href=/x>t</a>", ["https://h.example/x"]),
    ("<A HREF=\"/X\">t</A>", ["https://h.example/x"]),
    ('<a href="">t</a><a href>t</a><a name="n">t</a>', []),
    ('<a title="a > b" href="/x">t</a>', ["https://h.example/x"]),
    ('<a title=\'href="/no"\' href="/yes">t</a>', ["https://h.example/yes"]),
    ('<a data-href="/no">t</a>', []),
    ('<a href="/first" href="/last">t</a>', ["https://h.example/last"]),
    ('<script>var x = "<a href=\'/no\'>";</script><a href="/yes">t</a>', ["https://h.example/yes"]),
    ('<script>open', []),
    ('<!-- <a href="/no">t</a> --><a href="/yes">t</a>', ["https://h.example/yes"]),
    ('<!-- <script> --><a href="/yes">t</a><script></script>', ["https://h.example/yes"]),
    ('<style>a:after{content:"<a href=/no>"}</style>', []),
    ('<a href="/a&#38;b&#x2F;c&amp;d#t">t</a>', ["https://h.example/a&b/c&d"]),
    ('<a href="/x"></a><a href="/x#t"></a><a href="/x?q"></a>', ["https://h.example/x"]),
    ('<div onclick="go(1)"></div>', ["https://h.example/dir/go(1)"]),
    ('<div onclick=""></div>', ["https://h.example/dir/page.html"]),
    ('<a href="javascript:void(0)" onclick="">t</a>', ["https://h.example/dir/page.html"]),
    ('<link href="/no"><abbr href="/no">t</abbr>', []),
    ('<a\n href = "/x" >t</a>', ["https://h.example/x"]),
    ("<a href='/it\"s'>t</a>", ['https://h.example/it"s']),
]


@pytest.fixture(scope="module")
def extracted(spark):
    rows = [(i, PAGE, html) for i, (html, _) in enumerate(LINK_CASES)]
    df = spark.createDataFrame(rows, "page_id long, url string, raw string")
    df = df.select("page_id", "url", H.clean_html(F.col("raw")).alias("html_content"))
    found = {}
    for row in L.distinct_links(L.extract_links(df)).collect():
        found.setdefault(row.page_id, []).append(row.link)
    return found


@pytest.mark.parametrize("i", range(len(LINK_CASES)))
def test_links(extracted, i):
    assert sorted(extracted.get(i, [])) == sorted(LINK_CASES[i][1]), LINK_CASES[i]


def test_long_tags_and_blank_runs(spark):
    big = f'<a title="{"y" * 200_000}" {" b=c" * 20_000} href="/x">{" " * 300_000}t</a>'
    df = spark.createDataFrame([(1, PAGE, big)], "page_id long, url string, raw string")
    df = df.select("page_id", "url", H.clean_html(F.col("raw")).alias("html_content"))
    assert [r.link for r in L.extract_links(df).collect()] == ["https://h.example/x"]


def test_images(spark):
    html = '<img src="/a/B.png"><img src=""><img><img src="c.gif" onclick="f()">'
    df = spark.createDataFrame([(1, PAGE, html)], "page_id long, url string, html_content string")
    got = L.extract_images(df).withColumn("filename", L.image_filename(F.col("link"))).collect()
    assert sorted((r.link, r.filename) for r in got) == [
        ("https://h.example/a/b.png", "b.png"), ("https://h.example/dir/c.gif", "c.gif"),
    ]


def test_clean_html_ignores_layout_and_removed_elements(spark):
    same = [
        "<p>a  b</p><script>1</script>", "<p>\n  a  b </p><SCRIPT src=x>2</script >", "<meta name=x>\n<p>a  b</p>\n\n",
        "<p>a  b<style>p{}</style></p>",
    ]
    other = ["<p>a b</p>", "<p>a  c</p>", "<p>a  b</p><!-- c -->", "<p>a  b</p><scripted>"]
    df = spark.createDataFrame([(x,) for x in same + other], "raw string").select(H.clean_html(F.col("raw")).alias("c"))
    got = [r.c for r in df.collect()]
    assert set(got[:4]) == {"<p>\na  b\n</p>"}
    assert len(set(got)) == 1 + len(other)


def test_hash_is_sha256_of_utf8(spark):
    df = spark.createDataFrame([("žluťoučký",), ("",)], "t string")
    for row in df.withColumn("h", H.content_hash(F.col("t"))).collect():
        assert row.h == hashlib.sha256(row.t.encode()).hexdigest()


def test_unescape_agrees_with_stdlib(spark):
    cases = [
        "a", "&amp;", "&amp;lt;", "&#38;lt;", "&#x26;#39;", "&eacute;t&eacute;", "&unknown;", "a&b", "&", "&#0065;", "&#x1F600;",
        "&#0;", "&#xD800;", "&#99999999999;", "&apos;", "&copy;&nbsp;x", "&#39", "&lt;&gt;&quot;",
    ]
    df = spark.createDataFrame([(c,) for c in cases], "t string").withColumn("u", H.unescape(F.col("t")))
    assert {r.t: r.u for r in df.collect()} == {c: stdlib_html.unescape(c) for c in cases}


def test_needs_render(spark):
    rows = [("<div data-placeholder>", True), ("DATA-PLACEHOLDER", False), ("Please Enable JavaScript", True), ("", False)]
    df = spark.createDataFrame(rows, "t string, want boolean").withColumn("got", H.needs_render(F.col("t")))
    assert all(r.got == r.want for r in df.collect())


def test_numeric_entities_like_a_parser(spark):
    import html as parser

    from linkloom.functions import html

    texts = ["&#x100000041;", "&#10000000065;", "&#146;", "&#128;", "&#129;", "&#x9F;", "&#0000065;", "&#x0;", "&#xD800;", "&#1114112;", "&#65;&#x42;"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", html.unescape(F.col("t")).alias("got")).collect()
    assert {r.t: r.got for r in rows} == {t: parser.unescape(t) for t in texts}


def test_all_entities_like_a_parser(spark):
    texts = [f"&{name}" for name in entities.html5] + [f"x&{name}y=1" for name in entities.html5 if not name.endswith(";")]
    texts += [f"&#{code};" for code in (*range(0, 300), 0xFDD0, 0xFDEF, 0xFFFD, 0xFFFE, 0xFFFF, 0x1FFFE, 0x10FFFF, 0x110000)]
    texts += ["&notit;", "&ampamp;", "&" + "n" * 40 + ";", "&amp;lt", "&x", "a &b; c"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", H.unescape(F.col("t")).alias("got")).collect()
    assert {r.t: r.got for r in rows if r.got != stdlib_html.unescape(r.t)} == {}


def test_clean_html_is_canonical(spark):
    groups = [
        ["<P>x &amp; y</P>", "<p>x &#38; y</p >", "<p>x &AMP; y</p>"],
        ["<a href='u'>t</a>", '<a href="u">t</a>', "<A  HREF = u >t</A>", "<a\nhref='u'/>t</a>"],
        ["<p title='a\"b'>&copy;</p>", '<p title="a&quot;b">©</p>', '<p title="a&#34;b">&#xA9;</p>'],
        ["<b>&lt;i&gt;</b>", "<b>&#60;i&#62;</b>", "<B>&lt;i&gt;</B>"],
        ["<input disabled>", '<input disabled="">'],
        ["<!-- <P> --><p>", "<!-- <P> --><P>"],
        ["<b><i></b>"], ["<p>", ], ["x & y"], ["x &amp; y"], [""],
    ]
    rows = [(i, x) for i, group in enumerate(groups) for x in group]
    got = spark.createDataFrame(rows, "i int, raw string").select("i", H.clean_html(F.col("raw")).alias("c")).collect()
    assert len({(r.i, r.c) for r in got}) == len(groups) == len({r.c for r in got})
    assert {r.c for r in got if r.i == 1} == {'<a href="u">\nt\n</a>'}


def test_clean_html_of_very_many_attributes(spark):
    big = "<a" + ' b="c"' * 50_000 + "><P" + " b=c" * 50_000 + ">"
    row = spark.createDataFrame([(big,)], "t string").select(H.clean_html(F.col("t")).alias("c")).first()
    assert row.c == "<a" + ' b="c"' * 50_000 + ">\n<p" + ' b="c"' * 50_000 + ">"


def test_plans_stay_short(spark):
    """Each text is written once in the plan, whatever is asked of it: long plans cost seconds before a row is read."""
    pages = spark.createDataFrame([("<p>", "u")], "html string, url string")
    cleaned = pages.select("url", H.clean_html(F.col("html")).alias("html_content"))
    for df, most in ((cleaned, 60_000), (L.extract_links(cleaned), 130_000)):
        assert len(df._jdf.queryExecution().optimizedPlan().toString()) < most


def test_plain_text_is_searched_for_no_pattern(spark):
    """Patterns come behind a search for their first character, which most of the time is all that plain text pays for."""
    texts = ["plain", "a > b", "", None, "<b>x", "&amp &lt;", "<A HREF='u'>", "&eacute;", "a < b & c"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select(H.clean_html(F.col("t")).alias("c"), H.link_tags(F.col("t")).alias("tags"), "i").orderBy("i").collect()
    assert [r.c for r in got] == ["plain", "a > b", "", None, "<b>\nx", "&amp; &lt;", '<a href="u">', "\u00e9", "a < b & c"]
    assert [r.tags for r in got] == [[], [], [], None, [], [], ["<A HREF='u'>"], [], []]
    plan = df.select(H.clean_html(F.col("t")), H.link_tags(F.col("t")))._jdf.queryExecution().analyzed().toString().lower()
    assert plan.count("contains(") > 4 and "&) and rlike" in plan
