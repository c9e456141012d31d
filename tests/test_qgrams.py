"""Substring lookups: equal to comparing all, and balanced where every request has one literal."""

import random

import pytest
from pyspark.sql import functions as F

from linkloom import session
from linkloom.operators import qgrams
from tests.test_state import like

DOMAINS = ["", "a", "ab", "abc", "shop.example.com", "x_y.com", "éa.com", "a%b", "a\\b", "com", "sub.example.net", "aaaa", None]
ASKED = ["", "a", "ab", ".com", "com", "abc", "aaa", "example", "a%com", "_b", "a\\%b", "%", "___", "\\\\", "zzz", "éa", "p.e%m", "shop%zzz", "com%shop", None]


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_lookups_equal_comparing_all(spark, limit):
    rng = random.Random(4)
    facts = [(rng.choice(["p", "q", None]), d, i) for i, d in enumerate(DOMAINS * 3)]
    requests = [(t, ip) for t in ASKED for ip in ("p", "q", "r", None)] * 2
    known = session.materialize(spark.createDataFrame(facts, "ip string, domain string, n int"), "facts")
    asked = session.materialize(spark.createDataFrame(requests, "text string, ip string"), "asked")
    sizes = {"limit": limit, "slices": 7, "min_rows": 2}
    fits = {(t, ip, d, n) for t, ip in requests if t is not None and ip for fact_ip, d, n in facts if d is not None and fact_ip == ip and like(d, t)}
    got = qgrams.matching_domains(asked, known.select("ip", "domain").distinct(), "text", ["ip"], **sizes).collect()
    assert sorted(map(tuple, got)) == sorted({f[:3] for f in fits})
    best = qgrams.like_lookup(asked, known, "text", "domain", "n", F.max, ["ip"], **sizes).collect()
    want = {}
    for t, ip, _, n in fits:
        want[t, ip] = max(n, want.get((t, ip), -1))
    assert len(best) == len(want) and {(r.text, r.ip): r.found for r in best} == want
    assert qgrams.matching_domains(asked.limit(0), known, "text", ["ip"], **sizes).count() == 0
    assert qgrams.like_lookup(asked, known.limit(0), "text", "domain", "n", F.max, ["ip"], **sizes).count() == 0


def test_requests_probe_their_rarest_gram(spark):
    rows = spark.range(4000).select(F.concat(F.lit("shop"), "id", F.lit(".example.com")).alias("domain"), "id")
    facts = session.materialize(rows, "facts")
    texts = [f"shop{i}%.example.com" for i in range(40)] + ["p0.exam", "example%nothing"]
    requests = spark.createDataFrame([(t,) for t in texts], "text string")
    probe = qgrams.Probe(requests, facts, "text", "domain", [])
    rarest = {r.text: r._key.gram for r in probe.probes(F.lit(True)).collect()}
    assert "example%nothing" not in rarest and rarest["p0.exam"] == "p0."
    counts = {r._key.gram: r.n for r in probe.seen.collect()}
    common = counts["com"]
    assert common == 4000 and all(counts[rarest[f"shop{i}%.example.com"]] < common for i in range(40))


def test_one_literal_in_all_requests_stays_balanced(spark):
    rows = spark.range(8000).select(F.concat(F.lit("d"), F.md5(F.col("id").cast("string")), F.lit(".com")).alias("domain"))
    facts = session.materialize(rows, "facts")
    requests = spark.createDataFrame([(".com",), ("_.com",), ("%.com",)], "text string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        pairs = qgrams.matching_domains(requests, facts, "text", [], limit=0, slices=400, min_rows=10)
        tasks = [r["count"] for r in pairs.groupBy(F.spark_partition_id().alias("task")).count().collect()]
        plan = pairs._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert sum(tasks) == 24000 and len(tasks) == 16 and max(tasks) < 2 * 24000 / 16
