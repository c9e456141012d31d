"""Reachability over the link table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions import urls
from linkloom.session import materialize, new_folder

# A level of at most this many ids (8 bytes each) is sent to all tasks instead of shuffling edges.
BROADCAST_LEVEL = 500_000
FOLD_LEVELS = 8


def reachable_pages(link: DataFrame, seeds: DataFrame, max_depth: int | None = None) -> DataFrame:
    """(id, depth): pages reachable from ``seeds`` (id), with the length of the shortest way.

    Breadth first. Links are written once, bucketed and sorted by their source, so no level shuffles them: small levels are
    broadcast, large ones are dealt to the buckets. Every level is written to the shared folder, so lost executors do not repeat
    earlier levels; every few levels, those so far become one table, so the plan of a level does not grow with its depth.
    Links are reduced to distinct new targets before they meet the pages seen already.
    """
    spark = link.sparkSession
    edges = _by_source(link)
    try:
        level = materialize(seeds.select("id").filter("id IS NOT NULL").distinct().withColumn("depth", F.lit(0)), "reach-0")
        folded, recent, size, depth = None, [level], level.count(), 0
        while size and (max_depth is None or depth < max_depth):
            depth += 1
            if len(recent) == FOLD_LEVELS:
                folded, recent = materialize(_together(folded, recent), "reached"), []
            fresh = next_level(spark.table(edges), level, size, _together(folded, recent))
            level = materialize(fresh.withColumn("depth", F.lit(depth)), f"reach-{depth}")
            size = level.count()
            recent = [*recent, level]
        return _together(folded, recent)
    finally:
        spark.sql(f"DROP TABLE {edges}")


def next_level(edges: DataFrame, level: DataFrame, size: int, visited: DataFrame) -> DataFrame:
    """(id) of the pages that links lead to from a level of ``size`` ids, and that were not visited."""
    ids = level.select(F.col("id").alias("from_page"))
    step = edges.join(F.broadcast(ids) if size <= BROADCAST_LEVEL else ids.hint("merge"), "from_page", "left_semi")
    return step.select(F.col("to_page").alias("id")).distinct().join(visited.select("id"), "id", "left_anti")


def _by_source(link: DataFrame) -> str:
    """The name of a table of the links, bucketed by their source; its files are in the shared folder."""
    spark = link.sparkSession
    buckets, path = int(spark.conf.get("spark.sql.shuffle.partitions")), new_folder(spark, "links-by-source")
    name = f"links_{path.rsplit('-', 1)[1]}"
    whole = link.select("from_page", "to_page").filter("from_page IS NOT NULL AND to_page IS NOT NULL")
    dealt = whole.repartition(buckets, "from_page").write.bucketBy(buckets, "from_page").sortBy("from_page")
    dealt.option("path", path).saveAsTable(name)
    return name


def _together(folded: DataFrame | None, levels: list[DataFrame]) -> DataFrame:
    parts = levels if folded is None else [folded, *levels]
    return reduce(DataFrame.unionByName, parts)


def same_site_links(links: DataFrame, seed: Column, href: str = "href") -> DataFrame:
    """``links`` with ``link``: absolute form of hrefs on the seed's site; all others are dropped."""
    return links.withColumn("link", urls.same_site(F.col(href), seed)).filter(F.col("link").isNotNull())
