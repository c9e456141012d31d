"""Sites: lookup by domain, creation, last access and politeness delay.

Domains match exactly by default. ``mode="like"`` is the substring form with ``%`` and ``_`` as
wildcards, case-sensitive for access and insensitive for site lookup.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.constants import DEFAULT_DELAY_SECONDS
from linkloom.operators.appends import site_append
from linkloom.operators.qgrams import like_lookup, matching_domains
from linkloom.operators.skew import MIN_HOT_ROWS, SLICES, lookup_join, skew_join


def site_access(site: DataFrame, page: DataFrame, slices: int = SLICES, min_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """(accessed_ip, domain, accessed_time): every access of a page, with the domain of its site."""
    accesses = page.select("site_id", "accessed_ip", "accessed_time")
    domains = site.select(F.col("id").alias("site_id"), "domain")
    spread = F.struct("accessed_ip", "accessed_time")
    joined = skew_join(accesses, domains, "site_id", spread, "inner", slices=slices, min_rows=min_rows)
    return joined.select("accessed_ip", "domain", "accessed_time")


def access_join(
    access: DataFrame, requests: DataFrame, mode: str = "exact", slices: int = SLICES, min_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Accesses (site_url, ip, domain, accessed_time) that each request (site_url, ip) means: same ip,
    and matching domain. Accesses of a busy pair of ip and domain are spread."""
    asked = requests.select("site_url", "ip").distinct()
    if mode == "exact":
        matches = asked.withColumn("domain", F.col("site_url"))
    else:
        # Find the matching domains first, then fetch their accesses by equality.
        known = access.select(F.col("accessed_ip").alias("ip"), "domain").distinct()
        matches = matching_domains(asked, known, "site_url", ["ip"])
    keyed = access.select(F.struct(F.col("accessed_ip").alias("ip"), "domain").alias("_pair"), "accessed_time")
    wanted = matches.select(F.struct("ip", "domain").alias("_pair"), "site_url")
    joined = skew_join(keyed, wanted, "_pair", F.col("accessed_time"), "inner", slices=slices, min_rows=min_rows)
    return joined.select("site_url", "_pair.ip", "_pair.domain", "accessed_time")


def last_access(access: DataFrame) -> DataFrame:
    """(accessed_ip, domain, accessed_time): latest access; combined before the shuffle."""
    return (
        access.filter(F.col("accessed_time").isNotNull() & F.col("accessed_ip").isNotNull())
        .groupBy("accessed_ip", "domain").agg(F.max("accessed_time").alias("accessed_time"))
    )


def last_page_access(site: DataFrame, page: DataFrame) -> DataFrame:
    """The same from the tables: pages shrink to one row per site and ip before sites are joined."""
    per_site = (
        page.filter(F.col("accessed_time").isNotNull() & F.col("accessed_ip").isNotNull() & F.col("site_id").isNotNull())
        .groupBy("site_id", "accessed_ip").agg(F.max("accessed_time").alias("accessed_time"))
    )
    domains = site.select(F.col("id").alias("site_id"), "domain")
    return last_access(per_site.join(domains, "site_id"))


def politeness_delay(
    requests: DataFrame, latest: DataFrame, now: Column, mode: str = "exact", default: float = DEFAULT_DELAY_SECONDS,
) -> DataFrame:
    """``requests`` (site_url, ip, robots_delay) with ``delay``: seconds to wait from ``now``.

    ``latest`` comes from last_access. A missing or negative robots delay means the default; no
    earlier access means no wait.
    """
    by_ip = latest.withColumnRenamed("accessed_ip", "ip")
    if mode == "exact":
        found = by_ip.withColumnRenamed("domain", "site_url").withColumnRenamed("accessed_time", "_last")
    else:
        asked = requests.select("site_url", "ip").distinct()
        found = like_lookup(asked, by_ip, "site_url", "domain", "accessed_time", F.max, by=["ip"], out="_last")
    pair = F.when(F.col("site_url").isNotNull() & F.col("ip").isNotNull(), F.struct("site_url", "ip")).alias("_pair")
    joined = lookup_join(requests.select("*", pair), found.select(pair, "_last"), "_pair")
    wait = F.when(F.col("robots_delay") >= 0, F.col("robots_delay").cast("double")).otherwise(F.lit(default))
    wait = F.when(F.isnan(F.col("robots_delay")), F.lit(default)).otherwise(wait)
    passed = (_micros(now) - _micros(F.col("_last"))) / 1e6
    delay = F.when(passed < wait, wait - passed).otherwise(F.lit(0.0))
    return joined.select(*requests.columns, delay.alias("delay"))


def waiting_domains(
    latest: DataFrame, delays: DataFrame, ip: str, now: Column, default: float = DEFAULT_DELAY_SECONDS,
) -> DataFrame:
    """(domain, delay): domains that ``ip`` cannot ask again at ``now``, and for how many seconds.

    ``latest`` comes from last_access, ``delays`` (domain, crawl_delay) from the robots files.
    """
    asked = latest.filter(F.col("accessed_ip") == ip).select("domain").distinct().join(delays, "domain", "left")
    requests = asked.select(
        F.col("domain").alias("site_url"), F.lit(ip).alias("ip"), F.col("crawl_delay").cast("double").alias("robots_delay")
    )
    waits = politeness_delay(requests, latest, now, default=default).filter(F.col("delay") > 0)
    return waits.select(F.col("site_url").alias("domain"), "delay")


def _micros(time: Column) -> Column:
    zero = F.expr("timestamp_ntz '1970-01-01 00:00:00'")
    return F.timestamp_diff("MICROSECOND", zero, time)


def any_first(df: DataFrame, key: str, id_column: str = "id") -> DataFrame:
    """One row per key: the one with the lowest id, where any would do."""
    rest = [name for name in df.columns if name != key]
    return df.groupBy(key).agg(F.min_by(F.struct(*rest), id_column).alias("_row")).select(
        key, *[F.col(f"_row.{name}").alias(name) for name in rest]
    )


def site_lookup(
    requests: DataFrame, site: DataFrame, mode: str = "exact", slices: int = SLICES, min_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """``requests`` (domain) with ``exists`` and ``site_id``, the lowest id that matches."""
    if mode == "exact":
        asked = requests.withColumn("_asked", F.col("domain"))
        hits = site.groupBy(F.col("domain").alias("_asked")).agg(F.min("id").alias("site_id"))
    else:
        asked = requests.withColumn("_asked", F.lower("domain"))
        lower = site.groupBy(F.lower("domain").alias("_low")).agg(F.min("id").alias("id"))
        hits = like_lookup(asked.select("_asked").distinct(), lower, "_asked", "_low", "id", F.min, out="site_id")
    found = lookup_join(asked, hits, "_asked", slices=slices, min_rows=min_rows)
    return found.select(*requests.columns, F.col("site_id").isNotNull().alias("exists"), "site_id")


def site_get_or_create(site: DataFrame, wanted: DataFrame, mode: str = "exact") -> DataFrame:
    """New site rows for the domains of ``wanted`` (domain, robots_content, sitemap_content) not found.

    Texts of a domain that comes more than once are taken from one of its rows.
    """
    first = wanted.groupBy("domain").agg(F.min(F.struct("robots_content", "sitemap_content")).alias("_row"))
    asked = first.select("domain", "_row.robots_content", "_row.sitemap_content")
    missing = site_lookup(asked, site, mode).filter(~F.col("exists")).drop("exists", "site_id")
    return site_append(site, missing)
