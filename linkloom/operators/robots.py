"""Robots rules as rows, crawl delays, sitemap lines, and verdicts on links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.functions import urls
from linkloom.operators.sizes import fits_broadcast
from linkloom.operators.skew import MIN_HOT_ROWS, SLICES, skew_join
from linkloom.session import materialize

_LINE_BREAK = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
_RULE_KEYS = ("disallow", "allow", "crawl-delay", "request-rate")
_PLAIN_PATH = r"^[A-Za-z0-9_.\-~/]*\z"


def unquote(text: Column) -> Column:
    """Decode percent escapes; malformed escapes and plus signs stay as they are."""
    guarded = F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25")
    decoded = F.try_url_decode(F.replace(guarded, F.lit("+"), F.lit("%2B")))
    return F.when(text.contains("%"), F.coalesce(decoded, text)).otherwise(text)


def quote(text: Column) -> Column:
    """Percent-encode all but letters, digits and ``_.-~/``."""
    encoded = F.url_encode(text)
    for old, new in (("+", "%20"), ("%2F", "/"), ("*", "%2A"), ("%7E", "~")):
        encoded = F.replace(encoded, F.lit(old), F.lit(new))
    return F.when(text.rlike(_PLAIN_PATH), text).otherwise(encoded)


def _tidy(path: Column) -> Column:
    """Drop an empty fragment, query and parameter part, as taking a URL apart and joining it does."""
    for mark in ("#", r"\?", ";"):
        path = F.regexp_replace(path, rf"{mark}\z", "")
    return path


def with_tested_path(df: DataFrame, url: str, out: str) -> DataFrame:
    """Add the text robots prefixes are compared with: the path alone, uniformly quoted, at least ``/``."""
    c = F.col
    keep = df.columns
    df = df.withColumn("_raw_path", urls.path_of(c(url)))
    df = df.withColumn("_odd", ~c("_raw_path").rlike(r"^(?!//)" + _PLAIN_PATH[1:]))
    # The decoded path is read as a URL once more, so it can lose a scheme or authority.
    again = F.regexp_replace(unquote(c("_raw_path")), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?", "")
    df = df.withColumn("_again", F.when(c("_odd"), _tidy(again)))
    quoted = F.when(c("_odd"), quote(c("_again"))).otherwise(c("_raw_path"))
    df = df.withColumn("_quoted", quoted)
    return df.select(*keep, F.when(c("_quoted") == "", "/").otherwise(c("_quoted")).alias(out))


def one_robots_per_domain(sites: DataFrame) -> DataFrame:
    """(domain, robots_content) of the lowest id per domain; domains may repeat in ``site``."""
    return (
        sites.groupBy("domain")
        .agg(F.min_by(F.struct("robots_content"), "id").alias("_first"))
        .select("domain", "_first.robots_content")
    )


def served(robots: DataFrame, status: str = "status") -> DataFrame:
    """Robots files as usable rules: text served with an error status counts as no text."""
    ok = F.col(status).between(200, 299)
    return robots.withColumn("robots_content", F.when(ok, F.col("robots_content"))).drop(status)


def _split_lines(sites: DataFrame) -> DataFrame:
    """(domain, line_no, raw, key, value) of every line; key is NULL without a colon."""
    lines = sites.filter(F.col("robots_content").isNotNull()).select(
        "domain", F.posexplode(F.split("robots_content", _LINE_BREAK, -1)).alias("line_no", "raw")
    )
    text = urls.strip(F.substring_index("raw", "#", 1))
    lines = lines.withColumn("_text", text)
    cut = F.expr("locate(':', _text)")
    return lines.select(
        "domain", "line_no", "raw",
        F.when(cut > 0, F.lower(urls.strip(F.substring_index("_text", ":", 1)))).alias("key"),
        unquote(urls.strip(F.expr("substring(_text, locate(':', _text) + 1)"))).alias("value"),
    )


def chosen_group(sites: DataFrame, agent: str) -> DataFrame:
    """Lines (domain, line_no, key, value) of the one group of each file that applies to ``agent``.

    All windows share one partitioning by domain, so the lines of a file are shuffled once. A
    partition is one robots file, which came out of a single cell.
    """
    lines = _split_lines(sites).withColumn(
        "kind",
        F.when(F.col("raw") == "", "B").when(F.col("key") == "user-agent", "U").when(F.col("key").isin(*_RULE_KEYS), "R"),
    ).filter(F.col("kind").isNotNull())
    order = Window.partitionBy("domain").orderBy("line_no")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = (F.col("kind") == "U") & F.coalesce(F.lag("kind").over(order) != "U", F.lit(True))
    lines = lines.withColumn("_starts", starts.cast("int"))
    lines = lines.withColumns({
        "group": F.sum("_starts").over(running),
        "_blanks": F.sum((F.col("kind") == "B").cast("int")).over(running),
    })
    members = Window.partitionBy("domain", "group")
    lines = lines.withColumn(
        "_blanks_at_start", F.min(F.when(F.col("_starts") == 1, F.col("_blanks"))).over(members)
    ).filter((F.col("kind") != "B") & (F.col("_blanks") == F.col("_blanks_at_start")))
    name = agent.split("/")[0].lower()
    is_agent = F.col("kind") == "U"
    lines = lines.withColumns({
        "_default": F.max(is_agent & (F.col("value") == "*")).over(members),
        "_hit": F.max(is_agent & F.lit(name).contains(F.lower("value"))).over(members),
        "_rules": F.max(F.col("kind") == "R").over(members),
    }).filter(F.col("_rules") & (F.col("_default") | F.col("_hit")))
    rank = F.struct("_default", "group")
    best = F.min(rank).over(Window.partitionBy("domain"))
    return lines.withColumn("_best", best).filter(rank == F.col("_best")).filter(~is_agent).select(
        "domain", "line_no", "key", "value"
    )


def robots_rules(sites: DataFrame, agent: str) -> DataFrame:
    """(domain, line_no, path, allow) of the applying group, in file order."""
    group = chosen_group(sites, agent).filter(F.col("key").isin("allow", "disallow"))
    return group.select(
        "domain", "line_no", quote(_tidy(F.col("value"))).alias("path"),
        ((F.col("key") == "allow") | (F.col("value") == "")).alias("allow"),
    )


def crawl_delays(sites: DataFrame, agent: str) -> DataFrame:
    """(domain, crawl_delay) of the applying group: its last all-digit delay."""
    digits = F.when(F.col("value").rlike(r"^[0-9]+\z"), F.col("value").try_cast("bigint"))
    return (
        chosen_group(sites, agent).filter(F.col("key") == "crawl-delay")
        .withColumn("_delay", digits).filter(F.col("_delay").isNotNull())
        .groupBy("domain").agg(F.max_by("_delay", "line_no").alias("crawl_delay"))
    )


def prefix_index(rules: DataFrame) -> DataFrame:
    """(domain, length, hash, path, line_no, allow): of rules with one path, the first in the file. ``hash`` is that of the path."""
    first = rules.groupBy("domain", "path").agg(F.min(F.struct("line_no", "allow")).alias("_first"))
    return first.select(
        "domain", F.length("path").alias("length"), F.xxhash64("path").alias("hash"), "path", "_first.line_no", "_first.allow",
    )


def denied_paths(paths: DataFrame, index: DataFrame, slices: int = SLICES, min_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """The rows of ``paths`` (domain, path), distinct ones, that robots rules forbid.

    A path is cut to the lengths that rules of its domain have, and each cut is looked up by its hash: so the work of a
    path grows with the number of lengths, and not with the number of rules. The first rule of the file decides. ``index``
    comes from ``prefix_index`` and is a stored table.
    """
    lengths = materialize(index.groupBy("domain").agg(F.sort_array(F.collect_set("length")).alias("_lengths")), "rule-lengths")
    if fits_broadcast(lengths.select("domain", F.array_join("_lengths", ",").alias("text"))):
        probes = paths.join(F.broadcast(lengths), "domain")
    else:
        probes = skew_join(materialize(paths, "paths"), lengths, "domain", F.col("path"), "inner", slices=slices, min_rows=min_rows)
    probes = probes.select("domain", "path", F.explode("_lengths").alias("length")).filter(F.col("length") <= F.length("path"))
    probes = probes.withColumn("hash", F.xxhash64(F.expr("substring(path, 1, length)")))
    rules = index.withColumnRenamed("path", "_prefix")
    if fits_broadcast(rules):
        hits = probes.join(F.broadcast(rules), ["domain", "length", "hash"])
    else:  # short prefixes such as / are hot
        key = F.struct("domain", "length", "hash").alias("_key")
        probes = materialize(probes.select("path", key), "probes")
        hits = skew_join(probes, rules.select("_prefix", "line_no", "allow", key), "_key", F.col("path"), "inner", slices=slices, min_rows=min_rows)
        hits = hits.select("*", "_key.domain")
    first = hits.filter(F.startswith("path", "_prefix")).groupBy("domain", "path").agg(F.min(F.struct("line_no", "allow")).alias("_first"))
    return first.filter(~F.col("_first.allow")).select("domain", "path")


def robots_allowed(
    links: DataFrame, rules: DataFrame, link: str = "link", slices: int = SLICES, min_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """``links`` with a boolean ``allowed``: the first rule of the domain, in file order, whose path is a prefix decides; without one,
    or without rules, a link is allowed.

    Each path of a domain is judged once, however many links lead to it, and only forbidden paths go back to the links.
    ``links`` is read twice, so it should be a stored table.
    """
    placed = with_tested_path(links, link, "_path").withColumn("_domain", urls.domain_of(F.col(link)))
    placed = placed.withColumn("_place", F.struct(F.col("_domain").alias("domain"), F.col("_path").alias("path")))
    index = materialize(prefix_index(rules), "rule-prefixes")
    paths = placed.filter(F.col("_domain").isNotNull()).select("_place.*").distinct()
    denied = denied_paths(paths, index, slices, min_rows).select(F.struct("domain", "path").alias("_place"), F.lit(True).alias("_denied"))
    denied = materialize(denied, "denied")
    if fits_broadcast(denied.select("_place.*")):
        joined = placed.join(F.broadcast(denied), "_place", "left")
    else:
        # Copies of one popular link differ in their pages: all columns spread them.
        joined = skew_join(placed, denied, "_place", F.struct(*links.columns), slices=slices, min_rows=min_rows)
    return joined.select(*links.columns, F.col("_denied").isNull().alias("allowed"))


def robots_sitemaps(sites: DataFrame) -> DataFrame:
    """(domain, line_no, sitemap_url) of ``Sitemap`` lines, wherever they stand in the file."""
    return _split_lines(sites).filter(F.col("key") == "sitemap").select(
        "domain", "line_no", F.col("value").alias("sitemap_url")
    )
