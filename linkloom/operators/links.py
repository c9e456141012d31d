"""Links and images of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions import html as H
from linkloom.functions import urls


def link_attributes(pages: DataFrame, html: str = "html_content") -> DataFrame:
    """Explode pages into (…, kind, value): ``a href``, any ``onclick`` and ``img src`` values.

    Each value comes once per page and kind. The page text itself does not travel on.
    """
    keep = [name for name in pages.columns if name != html]
    # Exploding a one-element array keeps the check for empty arrays, which comes with ``inline``, from being pushed down through
    # all of the above.
    found = with_link_values(pages, html, "_found").select(*keep, F.explode(F.array("_found")).alias("_found"))
    return found.select(*keep, F.inline("_found"))


def with_link_values(pages: DataFrame, html: str, out: str) -> DataFrame:
    """``pages`` with ``out``: an array of (kind, value), each once. A page is one row, so repeats are dropped inside it,
    before anything is exploded or shuffled."""
    tags = pages.withColumn("_tags", F.array_distinct(H.link_tags(F.col(html))))
    tags = tags.withColumn("_tags", F.transform("_tags", _named_attributes))
    found = tags.withColumn("_tags", F.array_distinct(F.flatten(F.transform("_tags", _wanted_values))))
    decoded = F.transform("_tags", lambda entry: F.struct(
        entry["kind"].alias("kind"), H.unescape(entry["value"]).alias("value")
    ))
    return found.withColumn(out, F.array_distinct(decoded)).drop("_tags")


def _named_attributes(tag: Column) -> Column:
    """(element, attributes) of a start tag, with each attribute's name next to its text."""
    return F.struct(
        H.tag_name(tag).alias("element"),
        F.transform(H.attributes(tag), lambda attribute: F.struct(
            H.attribute_name(attribute).alias("name"), attribute.alias("text")
        )).alias("attributes"),
    )


def _wanted_values(tag: Column) -> Column:
    """(kind, value) of the link attributes of one tag. The last of repeated attributes counts."""

    def value(name: str) -> Column:
        named = F.filter(tag["attributes"], lambda attribute: attribute["name"] == name)
        return H.attribute_value(F.try_element_at(named, F.lit(-1))["text"])

    values = F.array(
        F.struct(F.lit("href").alias("kind"), F.when(tag["element"] == "a", value("href")).alias("value")),
        F.struct(F.lit("onclick").alias("kind"), value("onclick").alias("value")),
        F.struct(F.lit("src").alias("kind"), F.when(tag["element"] == "img", value("src")).alias("value")),
    )
    return F.filter(values, lambda found: href_filter(found["kind"], found["value"]))


def extract_links(pages: DataFrame, url: str = "url", html: str = "html_content") -> DataFrame:
    """(…, link) for every ``a href`` and ``onclick``, normalised against the page URL."""
    return _normalized(link_attributes(pages, html).filter(F.col("kind") != "src"), url)


def extract_images(pages: DataFrame, url: str = "url", html: str = "html_content") -> DataFrame:
    """(…, link) for every ``img src``, normalised against the page URL."""
    return _normalized(link_attributes(pages, html).filter(F.col("kind") == "src"), url)


def _normalized(values: DataFrame, url: str) -> DataFrame:
    return urls.normalize_links(values, base=url, link="value", out="link").drop("kind", "value")


def distinct_links(links: DataFrame, page: str = "page_id", link: str = "link") -> DataFrame:
    """Each link once per page. A page's links sit in one task, so most repeats go before the shuffle."""
    return links.dropDuplicates([page, link])


def image_filename(link: Column) -> Column:
    return urls.last_segment(link)


def href_filter(kind: Column, value: Column) -> Column:
    """Empty ``href`` and ``src`` values do not count; ``onclick`` counts even when empty."""
    return value.isNotNull() & ((kind == "onclick") | (value != ""))
