"""Physical plans: what must not be in them, and what has to reach the scan."""

import re

import pytest

from linkloom import schemas
from linkloom.operators import frontier, pages
from linkloom.plans.catalog import QUERIES
from linkloom.session import new_folder
from linkloom.sources.store import Store

# Queries whose frames can be planned without running a job.
PLANNED = (
    "best_links", "normalize_url", "extract_links", "distinct_links", "clean_html", "content_hash", "link_route", "robots_rules",
    "crawl_delay", "dense_ids", "access_join", "access_join_like", "politeness_delay", "politeness_delay_like", "site_lookup_like",
    "site_get_or_create", "page_update", "frontier_topk", "frontier_claim", "frontier_topk_per_site", "link_append_strict",
    "link_insert_ignore", "sitemap_content", "sitemap_frontier", "intersect_known", "any_first",
)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLANNED)
def test_no_cross_joins_and_no_python(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|EvalPython|InPandas|InArrow", plan), plan


def test_topk_takes_ordered(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["frontier_topk"](spark, sf_dir))


def test_topk_per_site_limits_before_the_shuffle(spark, sf_dir):
    plan = plan_of(QUERIES["frontier_topk_per_site"](spark, sf_dir))
    assert re.search(r"WindowGroupLimit.*Final.*WindowGroupLimit.*Partial", plan, re.S)


def test_store_scans_prune_partitions_and_columns(spark):
    store = Store(spark, new_folder(spark, "store"))
    rows = [(i, None, kind, f"u{i}", "text", 200, None, None, 1, f"h{i}") for i, kind in enumerate(["HTML", "BINARY", "FRONTIER"])]
    store.replace({"page": spark.createDataFrame(rows, schemas.PAGE)})
    page = store.read()["page"]
    assert pages.html_count(page).first()[0] == 1
    plan = plan_of(pages.html_count(page))
    assert "page_type_code" in re.search(r"PartitionFilters: \[[^\]]*\]", plan).group(0)
    assert "html_content" not in "".join(re.findall(r"ReadSchema: \S+", plan))
    best = plan_of(frontier.frontier_topk(page, 5))
    assert "html_content" not in "".join(re.findall(r"ReadSchema: \S+", best))


def test_first_of_batch_combines_before_the_shuffle(spark):
    batch = spark.createDataFrame([("u", 1, 0)], "url string, relevance int, position int")
    plan = plan_of(frontier.first_of_batch(batch, batch.position))
    assert "partial_min" in plan


def test_marking_duplicates_sorts_no_group(spark):
    batch = spark.createDataFrame([], "id long, accessed_time timestamp_ntz, content_hash string")
    assert "Window" not in plan_of(pages.mark_duplicates(batch))
