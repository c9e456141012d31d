"""Crawl tables derived from the generic input tables, row by row and over whole tables.

They stand in for a crawl: ``pages`` become responses, ``documents`` become pages with repeated
texts, ``events`` become accesses. Statuses and types are spread over rows by their ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom import schemas
from linkloom.functions import html as H
from linkloom.functions import urls
from linkloom.operators import links
from linkloom.sources.tables import table

AGENT = "linkloom"
FOCUS = "blog.tionsh.example.net"
KEYWORDS = ("the", "de", "tion")
NOW = "2024-01-31 00:00:00"
DOCS_HOST = "docs.example.com"
DOC_ID_OFFSET = 1_000_000_000_000


def now():
    return F.lit(NOW).cast("timestamp_ntz")


def seconds_after_start(seconds) -> Column:
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("SECOND", seconds, start)


def fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = table(spark, sf_dir, "pages")
    failed = F.col("page_id") % 17 == 0
    last_digit = F.col("page_id") % 10
    kind = (
        F.when(failed, F.lit(None).cast("string")).when(last_digit == 7, "application/pdf").when(last_digit == 8, "image/png")
        .when(last_digit == 9, "video/mp4").otherwise("text/html; charset=utf-8")
    )
    return page.select(
        F.col("page_id").alias("id"), "url", "html", F.when(failed, 500).otherwise(200).alias("http_status_code"),
        kind.alias("content_type"), F.concat(F.lit("10.0.0."), (F.col("page_id") % 4).cast("string")).alias("accessed_ip"),
        seconds_after_start(F.col("page_id") * 7).alias("accessed_time"),
    )


def domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(urls.domain_of(F.col("url")).alias("domain")).distinct()


def site_robots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(domain, robots_content), three kinds of robots files by the length of the domain."""
    lines = F.when(F.length("domain") % 3 == 0, F.lit("User-agent: *\nDisallow: /en/\nCrawl-delay: 3")).when(
        F.length("domain") % 3 == 1,
        F.concat(F.lit("User-agent: *\nDisallow: /d\nAllow: /\nSitemap: https://"), F.col("domain"), F.lit("/sitemap.xml")),
    )
    return domains(spark, sf_dir).select("domain", lines.alias("robots_content"))


def access(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("10.0.0."), F.col("user_id").cast("string")).alias("accessed_ip"),
        F.concat("event_type", F.lit(".example.com")).alias("domain"), F.col("ts").alias("accessed_time"),
    )


def delay_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(site_url, ip, robots_delay): all pairs with an access and one without, for three delays."""
    pairs = access(spark, sf_dir).select(F.col("domain").alias("site_url"), F.col("accessed_ip").alias("ip")).distinct()
    unseen = spark.createDataFrame([("unseen.example.com", "10.0.0.0")], pairs.schema)
    delays = F.explode(F.array(F.lit(None).cast("double"), F.lit(3600.0), F.lit(86400.0)))
    return pairs.unionByName(unseen).withColumn("robots_delay", delays)


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = table(spark, sf_dir, "documents")
    url = F.concat(F.lit(f"https://{DOCS_HOST}/"), "source", F.lit("/"), F.col("doc_id").cast("string"))
    return doc.select(F.col("doc_id").alias("id"), url.alias("url"), F.col("text").alias("html_content"))


def hashed_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, url, accessed_time, content_hash, http_status_code, accessed_ip) of documents as pages."""
    return docs(spark, sf_dir).select(
        "id", "url", seconds_after_start(F.col("id") % 100).alias("accessed_time"),
        H.content_hash(H.clean_html(F.col("html_content"))).alias("content_hash"),
        F.lit(200).alias("http_status_code"), F.lit("10.0.0.1").alias("accessed_ip"),
    )


def cleaned_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", "url", H.clean_html(F.col("html")).alias("html_content"))


def raw_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, url, kind, value) of all links as written."""
    return links.link_attributes(cleaned_pages(spark, sf_dir))


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, link): normalised links, each once per page."""
    return links.distinct_links(links.extract_links(cleaned_pages(spark, sf_dir)).select("page_id", "link"))


def scored_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_links(spark, sf_dir).select(
        "page_id", F.col("link").alias("url"), urls.relevance(F.col("link"), FOCUS, KEYWORDS).alias("relevance")
    )


def file_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links with suffixes of all file types."""
    suffixes = F.array(*[F.lit(s) for s in (
        "", ".html", ".pdf", ".PNG", ".doc", ".docx", ".ppt", ".pptx", ".gif", "/robots.txt",
    )])
    pick = F.element_at(suffixes, ((F.length("link") + F.col("page_id")) % 10 + 1).cast("int"))
    return page_links(spark, sf_dir).select("page_id", F.concat("link", pick).alias("link"))


def known_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page table of all page URLs in the frontier: ids are the lowest page ids, relevance 3."""
    spelled = urls.normalize_links(
        table(spark, sf_dir, "pages").select("page_id", "url", F.lit("").alias("base")), "base", "url", "spelled"
    )
    rows = spelled.groupBy(F.col("spelled").alias("url")).agg(F.min("page_id").alias("id"))
    given = {"id": F.col("id"), "url": F.col("url"), "page_type_code": F.lit("FRONTIER"), "relevance": F.lit(3)}
    return rows.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.PAGE.fields])


def mixed_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with states and relevance that differ by id, NULL relevance included."""
    state = F.element_at(F.array(*[F.lit(s) for s in ("FRONTIER", "HTML", "FRONTIER", "BINARY")]), (F.col("id") % 4 + 1).cast("int"))
    return known_page(spark, sf_dir).withColumns({
        "page_type_code": state, "relevance": F.when(F.col("id") % 7 != 0, (F.col("id") % 5).cast("int")),
    })


def round_fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses of a round: pages, with a file link and an image added, and documents as pages of one
    large site; URLs as the frontier spells them. A URL may come more than once, with its first page earliest."""
    extra = F.concat(
        F.col("html"), F.lit('<a href="/files/'), (F.col("id") % 30).cast("string"), F.lit('.pdf">f</a><img src="/img/'),
        (F.col("id") % 50).cast("string"), F.lit('.png">'),
    )
    spelled = urls.normalize_links(
        fetched(spark, sf_dir).withColumns({"html": extra, "base": F.lit("")}), "base", "url", "spelled"
    )
    columns = schemas.FETCHED.names
    web = spelled.drop("base", "url").withColumnRenamed("spelled", "url").select(*columns)
    doc = docs(spark, sf_dir).select(
        (F.col("id") + DOC_ID_OFFSET).alias("id"), "url", F.col("html_content").alias("html"), F.lit(200).alias("http_status_code"),
        F.lit("text/html").alias("content_type"), F.lit("10.0.0.1").alias("accessed_ip"),
        seconds_after_start(F.col("id") % 100).alias("accessed_time"),
    )
    return web.unionByName(doc)


def round_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page table before that round: everything in the frontier."""
    given = {"page_type_code": F.lit("FRONTIER"), "relevance": F.lit(3)}
    doc = docs(spark, sf_dir).select((F.col("id") + DOC_ID_OFFSET).alias("id"), "url")
    web = known_page(spark, sf_dir).select("id", "url")
    return web.unionByName(doc).select(*[
        (F.col(f.name) if f.name in ("id", "url") else given.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name)
        for f in schemas.PAGE.fields
    ])


def sitemap_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(domain, line_no, sitemap_url, xml): one sitemap file per page, with the page and one more URL."""
    domain = urls.domain_of(F.col("url"))
    address = F.concat(F.lit("https://"), domain, F.lit("/sitemap-"), F.col("page_id").cast("string"), F.lit(".xml"))
    xml = F.concat(
        F.lit('<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc> '),
        F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit(" </loc></url><url><loc>https://"), domain, F.lit("/d/"),
        F.col("page_id").cast("string"),
        F.when(F.col("page_id") % 9 == 0, "</loc></url>").otherwise("</loc></url></urlset>"),
    )
    return table(spark, sf_dir, "pages").select(
        domain.alias("domain"), F.col("page_id").cast("int").alias("line_no"), address.alias("sitemap_url"), xml.alias("xml")
    )


def site_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between pages as in a site map: every page to two deeper ones, some back to the start."""
    page = table(spark, sf_dir, "pages").select("page_id")
    child = F.explode(F.array(F.col("page_id") * 2 + 1, F.col("page_id") * 2 + 2, F.when(F.col("page_id") % 3 == 0, F.lit(0).cast("bigint"))))
    edges = page.select(F.col("page_id").alias("from_page"), child.alias("to_page"))
    return edges.join(page.select(F.col("page_id").alias("to_page")), "to_page", "left_semi").select("from_page", "to_page")


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, event_type, from_page, to_page): pairs with many repeats."""
    return table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.col("user_id").alias("from_page"), F.floor("value").cast("bigint").alias("to_page")
    )
