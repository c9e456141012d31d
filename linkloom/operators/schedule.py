"""A schedule of fetches: the open pages of each site get time slots that are its delay apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.constants import DEFAULT_DELAY_SECONDS
from linkloom.functions import urls
from linkloom.operators.frontier import GROUP_LIMIT, RANK_SALTS
from linkloom.operators.sizes import fits_broadcast
from linkloom.operators.skew import skew_join
from linkloom.session import materialize


def site_slots(domains: DataFrame, latest: DataFrame, delays: DataFrame, ip: str, now: Column, horizon: float, default: float = DEFAULT_DELAY_SECONDS) -> DataFrame:
    """(domain, first, delay, slots): when ``ip`` may ask a domain next, the seconds between its fetches, and how many fit
    from ``now`` to ``horizon`` seconds later, the end included; a delay of 0 has no bound (null).

    ``latest`` comes from last_access, ``delays`` (domain, crawl_delay) from the robots files. A missing or negative delay means
    the default.
    """
    seen = latest.filter(F.col("accessed_ip") == ip).groupBy("domain").agg(F.max("accessed_time").alias("_last"))
    rows = domains.select("domain").distinct().join(delays, "domain", "left").join(seen, "domain", "left")
    delay = F.when(F.col("crawl_delay") >= 0, F.col("crawl_delay").cast("double")).otherwise(F.lit(default))
    rows = rows.withColumn("delay", delay)
    after = F.expr("timestampadd(MICROSECOND, cast(round(delay * 1e6) AS bigint), _last)")
    rows = rows.withColumn("first", F.greatest(now, F.coalesce(after, now)))
    left = F.lit(horizon) - F.timestamp_diff("MICROSECOND", now, F.col("first")) / 1e6
    # A microsecond is the least step of time, so whole ones are counted.
    fit = F.expr("floor(round(_left * 1e6) / round(delay * 1e6)) + 1").cast("bigint")
    slots = F.when(F.col("_left") < 0, 0).when(F.col("delay") > 0, fit)
    return rows.withColumn("_left", left).select("domain", "first", "delay", slots.alias("slots"))


def fetch_schedule(
    rows: DataFrame, latest: DataFrame, delays: DataFrame, ip: str, now: Column, horizon: float, default: float = DEFAULT_DELAY_SECONDS,
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """``rows`` (id, url, relevance) that can be fetched within ``horizon`` seconds from ``now``, with ``domain`` and ``not_before``: the
    best page of a site comes when its delay since the last access of ``ip`` is over, each further one a delay later.

    Only as many rows of a site are ranked as slots can fit: a site with a large share of all pages is cut in every task before
    it is ranked in one. Sites without delay are not ranked at all. Rows are read twice, so they should be stored. URLs without a
    host are one site, with the default delay.
    """
    placed = rows.select("id", "url", "relevance", F.coalesce(urls.domain_of(F.col("url")), F.lit("")).alias("domain"))
    slots = materialize(site_slots(placed, latest, delays, ip, now, horizon, default), "slots")
    if fits_broadcast(slots):
        timed = placed.join(F.broadcast(slots), "domain")
    else:
        timed = skew_join(materialize(placed, "placed"), slots, "domain", F.col("id"), "inner")
    free = timed.filter("slots IS NULL").withColumn("not_before", F.col("first"))
    most = slots.agg(F.max("slots")).first()[0] or 0
    best = [F.col("relevance").desc_nulls_first(), F.col("id")]
    ranked = timed.filter("slots > 0")
    if most > limit:
        ranked = ranked.withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(RANK_SALTS)))
        ranked = ranked.withColumn("_rank", F.row_number().over(Window.partitionBy("domain", "_salt").orderBy(*best)))
        ranked = ranked.filter((F.col("_rank") <= most) & (F.col("_rank") <= F.col("slots"))).drop("_salt", "_rank")
    ranked = ranked.withColumn("_rank", F.row_number().over(Window.partitionBy("domain").orderBy(*best)))
    ranked = ranked.filter(F.col("_rank") <= most).filter(F.col("_rank") <= F.col("slots"))
    shift = "timestampadd(MICROSECOND, cast(round(delay * 1e6) AS bigint) * (_rank - 1), first)"
    ranked = ranked.withColumn("not_before", F.expr(shift))
    columns = ["id", "url", "relevance", "domain", "not_before"]
    return ranked.select(*columns).unionByName(free.select(*columns))
