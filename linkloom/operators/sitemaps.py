"""Sitemap files: their URLs, the text kept with a site, and the frontier rows they give."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.constants import SEED_RELEVANCE, SITEMAP_NAMESPACE
from linkloom.functions import html as H
from linkloom.functions import urls
from linkloom.operators.robots import robots_allowed

# Bytes of a part of a site's sitemap text.
PART_BYTES = 16 * 1024 * 1024
_CDATA = r"<!\[CDATA\[(.*?)\]\]>"
_COMMENT = r"(?s)<!--.*?-->"
_BOUND = rf"""xmlns(?::([\w.\-]+))?\s*=\s*["']{SITEMAP_NAMESPACE.replace(".", "[.]")}["']"""
# A loc element up to its first child or its end.
_LOC = rf"(?s)<(?:([\w.\-]+):)?loc(?:\s[^>]*?)?(?:/>|>(?:[^<]++|{_CDATA.replace('(.*?)', '.*?')})*+)"


def sitemap_urls(files: DataFrame, xml: str = "xml") -> DataFrame:
    """(…, position, url): trimmed ``loc`` texts; nothing from a file that is not well-formed.

    A file with an empty ``loc`` gives nothing at all. ``loc`` counts at any depth, with a prefix that the file binds to the
    sitemap namespace, or without one where that is a default namespace; where in the file the binding stands is not looked at.
    """
    keep = [name for name in files.columns if name != xml]
    text = F.regexp_replace(xml, _COMMENT, "")
    parsed = files.filter(_well_formed(F.col(xml))).select(
        *keep, F.regexp_extract_all(text, F.lit(_BOUND), F.lit(1)).alias("_bound"),
        F.regexp_extract_all(text, F.lit(_LOC), F.lit(0)).alias("_found"),
    )
    own = F.filter("_found", lambda found: F.array_contains("_bound", F.regexp_extract(found, _LOC, 1)))
    locations = parsed.withColumn("_locations", F.transform(own, lambda found: urls.strip(_text(found))))
    whole = F.forall("_locations", lambda loc: loc.isNotNull() & (loc != ""))
    return locations.filter(whole).select(*keep, F.posexplode("_locations").alias("position", "url"))


def _well_formed(xml: Column) -> Column:
    record = F.from_xml(xml, "_none string, _corrupt_record string")
    return record.isNotNull() & record["_corrupt_record"].isNull()


def _text(found: Column) -> Column:
    """Text of an element: parts in CDATA as they are, entities decoded elsewhere; NULL for an empty one."""
    parts = F.regexp_extract_all(F.regexp_replace(found, r"(?s)^<[^>]*>", ""), F.lit(rf"(?s){_CDATA}|[^<]++"), F.lit(0))
    plain = F.transform(parts, lambda part: F.when(
        part.startswith("<![CDATA["), F.regexp_replace(part, rf"(?s)^{_CDATA}$", "$1")
    ).otherwise(H.unescape(part)))
    return F.array_join(plain, "")


def sitemap_parts(listed: DataFrame, found: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """(domain, part, text): the sitemap URLs of a site in order, each followed by one blank, in parts that begin within the same
    ``part_bytes`` bytes of the whole. So a part is at most one URL longer than that, whatever the size of a site.

    ``listed`` are the Sitemap lines (domain, line_no, sitemap_url), ``found`` the URLs of files
    (sitemap_url, position, url).
    """
    urls_of = listed.join(found.select("sitemap_url", "position", "url"), "sitemap_url").filter(F.col("url").isNotNull())
    order = Window.partitionBy("domain").orderBy("line_no", "position").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.octet_length("url") + 1
    placed = urls_of.withColumn("_end", F.sum(size).over(order)).withColumn("part", F.floor((F.col("_end") - size) / part_bytes))
    texts = placed.groupBy("domain", "part").agg(F.array_sort(F.collect_list(F.struct("line_no", "position", "url"))).alias("_urls"))
    return texts.select("domain", "part", F.concat(F.array_join("_urls.url", " "), F.lit(" ")).alias("text"))


def sitemap_content(sites: DataFrame, listed: DataFrame, found: DataFrame) -> DataFrame:
    """(domain, sitemap_content): all sitemap URLs of a site in order, each followed by one blank.

    '' without sitemaps; NULL without robots text. The text is one cell of ``site``, which its parts are put together for.
    """
    parts = sitemap_parts(listed, found).groupBy("domain").agg(F.array_sort(F.collect_list(F.struct("part", "text"))).alias("_parts"))
    texts = parts.select("domain", F.array_join("_parts.text", "").alias("_text"))
    has_robots = F.col("robots_content").isNotNull() & (F.col("robots_content") != "")
    return sites.select("domain", "robots_content").join(texts, "domain", "left").select(
        "domain", F.when(has_robots, F.coalesce("_text", F.lit(""))).alias("sitemap_content")
    )


def sitemap_frontier(
    listed: DataFrame, found: DataFrame, rules: DataFrame, relevance: int = SEED_RELEVANCE,
) -> DataFrame:
    """(domain, line_no, position, url, relevance): allowed sitemap URLs, normalised, to be enqueued."""
    parts = listed.join(found.select("sitemap_url", "position", F.col("url").alias("raw")), "sitemap_url")
    allowed = robots_allowed(parts, rules, link="raw").filter("allowed")
    normalized = urls.normalize_links(allowed, base="domain", link="raw", out="url")
    return normalized.select("domain", "line_no", "position", "url", F.lit(relevance).alias("relevance"))
