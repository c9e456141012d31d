"""URL columns: authority, path, type, score, and links resolved to canonical form.

Everything here is a built-in column expression. ``normalize_links`` works in DataFrame steps, so
that each part of a URL is computed once and the whole stays inside generated code.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.constants import FOCUS_DOMAIN, INDEX_NAMES, KEYWORDS, SUFFIX_TYPES, VOID_LINK

# What a URL parser ignores in front of a URL, and what counts as white space around text.
_LEADING = "".join(map(chr, range(0x21)))
_SPACES = "".join(map(chr, (
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)))
_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
_BEFORE_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?"
# Schemes whose relative links can be resolved; a URL without scheme counts as well.
_RELATIVE_SCHEMES = (
    "", "ftp", "http", "gopher", "nntp", "imap", "wais", "file", "https", "shttp", "mms", "prospero",
    "rtsp", "rtsps", "rtspu", "sftp", "svn", "svn+ssh", "ws", "wss",
)


def strip(text: Column) -> Column:
    """Trim all Unicode white space, not only blanks."""
    return F.btrim(text, F.lit(_SPACES))


def parseable(url: Column) -> Column:
    """The form a URL parser looks at: no leading controls, no tabs or line breaks."""
    return F.translate(F.ltrim(url, F.lit(_LEADING)), "\t\r\n", "")


def domain_of(url: Column) -> Column:
    """Authority with port and user part, or '' where there is none."""
    return F.regexp_extract(parseable(url), _AUTHORITY, 1)


def path_of(url: Column) -> Column:
    """Path without query and fragment; for ``mailto:x`` that is ``x``."""
    return F.regexp_extract(F.regexp_replace(parseable(url), _BEFORE_PATH, ""), "^[^?#]*", 0)


def has_scheme(url: Column) -> Column:
    return parseable(url).rlike(_SCHEME)


def is_web(url: Column) -> Column:
    return F.lower(parseable(url)).rlike("^https?://")


def url_type(url: Column) -> Column:
    """HTML or a file type code, by suffix."""
    low = F.lower(url)
    branches = F.when(url.isNull(), F.lit(None).cast("string"))
    for suffixes, code in SUFFIX_TYPES:
        hit = F.lit(False)
        for suffix in suffixes:
            hit = hit | low.endswith(suffix)
        branches = branches.when(hit, code)
    return branches.otherwise("HTML")


def relevance(url: Column, focus: str = FOCUS_DOMAIN, keywords: Sequence[str] = KEYWORDS) -> Column:
    """One point for the focus domain, one for any keyword anywhere in the URL."""
    any_keyword = F.lit(False)
    for keyword in keywords:
        any_keyword = any_keyword | url.contains(keyword)
    return (domain_of(url) == focus).cast("int") + any_keyword.cast("int")


def last_segment(url: Column) -> Column:
    """What follows the last slash."""
    return F.substring_index(url, "/", -1)


def canonical(link: Column) -> Column:
    """Canonical text of a resolved link: trimmed, lower case, no fragment, query, end slash or index name."""
    low = F.lower(strip(link))
    cut = F.substring_index(F.substring_index(low, "#", 1), "?", 1)
    cut = F.regexp_replace(cut, r"/\z", "")
    names = "|".join(name.replace(".", "[.]") for name in INDEX_NAMES)
    return F.regexp_replace(cut, rf"/[^/]*(?:{names})\z", "")


def same_site(href: Column, seed: Column) -> Column:
    """Absolute form of ``href`` when it is on the seed's site (scheme and host contained), else NULL."""
    root = F.concat(
        F.lower(F.regexp_extract(parseable(seed), _SCHEME, 1)), F.lit("://"), domain_of(seed)
    )
    absolute = F.when(href.startswith("/"), F.concat(root, href)).otherwise(href)
    return F.when(absolute.contains(root), absolute)


def _bad_brackets(authority: Column) -> Column:
    return authority.contains("[") != authority.contains("]")


def _fold(segments: Column) -> Column:
    """Apply ``.`` and ``..`` from left to right."""
    nothing = F.array().cast("array<string>")

    def step(done: Column, part: Column) -> Column:
        return (
            F.when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
            .when(part == ".", done)
            .otherwise(F.concat(done, F.array(part)))
        )

    return F.aggregate(segments, nothing, step)


def normalize_links(df: DataFrame, base: str = "base", link: str = "link", out: str = "url") -> DataFrame:
    """Add ``out``: ``link`` resolved against ``base`` and made canonical.

    Rows with the void link are dropped. ``out`` is NULL where a URL parser would refuse the link
    (unbalanced brackets in the authority); such rows can be filtered into a rejects frame.
    """
    c = F.col
    keep = [name for name in df.columns if name != out]
    df = df.filter((c(link) != VOID_LINK) | c(link).isNull())
    df = df.withColumns({
        "_text": parseable(c(link)),
        "_base": parseable(c(base)),
    })
    df = df.withColumns({
        "_own": c("_text").rlike(_SCHEME),
        "_scheme": F.lower(F.regexp_extract("_base", _SCHEME, 1)),
        "_host": F.regexp_extract("_base", _AUTHORITY, 1),
        "_dir": F.regexp_extract(F.regexp_replace("_base", _BEFORE_PATH, ""), "^[^?#]*", 0),
        "_to_host": F.regexp_extract("_text", _AUTHORITY, 1),
        # A leading // without a host is dropped, and what follows it is a path.
        "_to": F.regexp_extract(F.regexp_replace("_text", "^//(?=[/?#]|\\z)", ""), "^[^?#]*", 0),
    })
    df = df.withColumns({
        "_root": F.concat(
            F.when(c("_scheme") != "", F.concat(c("_scheme"), F.lit(":"))).otherwise(""),
            F.when((c("_host") != "") | c("_scheme").isin("http", "https", "ftp"), F.concat(F.lit("//"), c("_host")))
            .otherwise(""),
        ),
        # Parameters behind the last segment's first semicolon stay out of the dot handling.
        "_path": F.regexp_extract("_to", r"^((?:.*/)?[^/;]*)", 1),
        "_params": F.regexp_extract("_to", r"^(?:.*/)?[^/;]*;([^/]*)\z", 1),
        "_base_path": F.regexp_extract("_dir", r"^((?:.*/)?[^/;]*)", 1),
    })
    link_parts = F.split("_path", "/", -1)
    base_parts = F.split("_base_path", "/", -1)
    kept_base = F.when(F.element_at(base_parts, -1) == "", base_parts).otherwise(
        F.slice(base_parts, 1, F.size(base_parts) - 1)
    )
    joined = F.concat(kept_base, link_parts)
    middle = F.filter(F.slice(joined, 2, F.greatest(F.size(joined) - 2, F.lit(0))), lambda part: part != "")
    squeezed = F.when(F.size(joined) <= 2, joined).otherwise(
        F.concat(F.slice(joined, 1, 1), middle, F.slice(joined, -1, 1))
    )
    all_parts = F.when(c("_path").startswith("/"), link_parts).otherwise(squeezed)
    # Only links that need it pay for splitting and folding.
    df = df.withColumn("_plain", c("_path").startswith("/") & ~c("_path").rlike(r"/\.\.?(?:/|\z)"))
    df = df.withColumn("_segments", F.when(~c("_own") & ~c("_plain"), all_parts))
    df = df.withColumn("_folded", _fold(c("_segments")))
    ends_in_dots = F.element_at("_segments", -1).isin(".", "..")
    folded = F.array_join(
        F.when(ends_in_dots, F.concat("_folded", F.array(F.lit("")))).otherwise(c("_folded")), "/"
    )
    df = df.withColumn("_resolved_path", F.when(c("_plain"), c("_path")).otherwise(
        F.when(folded == "", "/").otherwise(folded)
    ))
    # Without an authority, a path of two slashes is written so that it cannot be read as one.
    lead = (
        F.when((c("_root") != "") & ~c("_resolved_path").startswith("/"), "/")
        .when((c("_root") == "") & c("_resolved_path").startswith("//"), "//")
        .otherwise("")
    )
    rooted = F.concat(lead, c("_resolved_path"))
    with_params = F.when(c("_params") != "", F.concat(rooted, F.lit(";"), c("_params"))).otherwise(rooted)
    scheme_prefix = F.when(c("_scheme") != "", F.concat(c("_scheme"), F.lit(":"))).otherwise("")
    resolved = (
        F.when(c(link) == "", c(base))
        .when(c("_own") | ~c("_scheme").isin(*_RELATIVE_SCHEMES), c(link))
        .when(_bad_brackets(c("_to_host")) | _bad_brackets(c("_host")), F.lit(None).cast("string"))
        .when(c("_to_host") != "", F.concat(scheme_prefix, c("_text")))
        .when((c("_path") == "") & (c("_params") == ""), F.concat(c("_root"), c("_dir")))
        .otherwise(F.concat(c("_root"), with_params))
    )
    # Exploding a one-element array keeps later filters on ``out`` from being pushed down through all
    # the steps above, which would write the whole chain out once per use.
    return df.withColumn("_resolved", resolved).select(*keep, F.explode(F.array(canonical(c("_resolved")))).alias(out))
