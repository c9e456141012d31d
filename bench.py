"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS (default 1; of several, the best counts) set what is run. The
first query runs once untimed, to start the session up. Results go to a sink that discards them,
after all rows are computed.
"""

import json
import os
import re
import sys
import tempfile
import time

from linkloom import session
from linkloom.plans.catalog import QUERIES

HEADLINE = (
    "best_links", "extract_links", "normalize_url", "clean_html", "content_hash", "mark_duplicates", "robots_rules", "robots_allowed",
    "frontier_insert_ignore", "url_to_id", "link_insert_ignore", "frontier_topk", "frontier_topk_per_site", "politeness_delay", "access_join",
    "dense_ids", "reachable_pages", "crawl_round", "stream_ingest",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = session.build(
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="shared-"),
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("OFF")
    times = {}
    QUERIES[HEADLINE[0]](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in HEADLINE:
        best = None
        for _ in range(runs):
            begin = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - begin
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_headline_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": float(scale.group(1)) if scale else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
