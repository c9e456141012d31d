"""Operators on vectors, against brute force."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkloom.llm import codes, graphs

SCHEMA = "vec_id long, embedding array<float>, label int"


def some_vectors(n, width, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    centers = rng.normal(0, spread, (6, width))
    return [(int(i), (centers[i % 6] + rng.normal(0, 0.6 * spread, width)).astype(np.float32).tolist(), [0, 1, None][i % 3]) for i in rng.permutation(n)]


def odd_vectors(width):
    one = [0.5] * width
    return [
        (1001, None, 1), (1002, [math.nan] * width, 1), (1003, [None] + [1.0] * (width - 1), 1), (1004, [math.inf] + [0.0] * (width - 1), 2),
        (1005, [0.0] * width, 2), (1006, one, 2), (1006, one, 2), (None, one, 1), (1007, [-0.25] * width, None),
    ]


def brute_codes(rows, width, entries=256, rounds=4):
    """By Python's whole numbers, without a transform."""
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    size = width // 4
    cut = [[tuple(v[p * size : (p + 1) * size]) for _, v, _ in kept] for p in range(4)]
    first = sorted((k for k, r in enumerate(kept) if r[0] is not None), key=lambda k: (kept[k][0], kept[k][1]))[:entries]
    books = [[cut[p][k] for k in first] for p in range(4)]

    def assign(p):
        return [min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(books[p])) for x in cut[p]]

    for _ in range(rounds):
        for p in range(4):
            found = assign(p)
            for k in range(len(books[p])):
                own = [cut[p][i] for i, (_, at) in enumerate(found) if at == k]
                if own:
                    books[p][k] = tuple(sum(c) // len(own) for c in zip(*own, strict=True))
    final = [assign(p) for p in range(4)]
    errors = [sum(final[p][i][0] for p in range(4)) for i in range(len(kept))]
    by_label = {}
    for (_, _, label), e in zip(kept, errors, strict=True):
        by_label[label] = by_label.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(x) for p in range(4) for e in books[p] for x in e).encode()).hexdigest()
    return [(r[0], "".join(f"{final[p][i][1]:02x}" for p in range(4)), errors[i], by_label[r[2]], digest) for i, r in enumerate(kept)]


@pytest.mark.parametrize(("n", "width", "spread"), [(330, 12, 1.0), (20, 8, 1.0), (300, 20, 40_000.0)])
def test_codes(spark, n, width, spread):
    rows = some_vectors(n, width, n, spread) + odd_vectors(width)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("error", F.lit("clash")).repartition(5)
    found = codes.label_errors(*codes.compress(df, carry=["label"])).collect()
    key = lambda r: (r[0] is None, r)
    assert sorted((tuple(r) for r in found), key=key) == sorted(brute_codes(rows, width), key=key)


def test_codes_of_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert codes.label_errors(*codes.compress(empty, carry=["label"])).count() == 0
    ragged = spark.createDataFrame([(1, [1.0], 1), (2, [], 1), (3, [1.0, 2.0, 3.0, 4.0, 5.0], 1), (4, [1.0], 2)], SCHEMA)
    got = {r.vec_id: (r.code, r.error) for r in codes.compress(ragged)[0].collect()}
    assert got == {1: ("00000000", 0), 2: ("01000000", 0), 3: ("02020200", 0), 4: ("00000000", 0)}


def test_nearest_is_exact_and_ties_go_to_the_lowest():
    rng = random.Random(4)
    for width in (1, 3, 4, 16):
        parts = np.array([[rng.randint(-3, 3) for _ in range(width)] for _ in range(700)])
        entries = np.array([[rng.randint(-3, 3) for _ in range(width)] for _ in range(40)])
        index, distance = codes.nearest(parts, entries)
        whole = ((parts[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        assert (index == whole.argmin(axis=1)).all() and (distance == whole.min(axis=1)).all()
        sequency = (np.diff(codes.transform(np.eye(16, dtype=np.int64)).T, axis=1) != 0).sum(axis=1)
        assert sequency.tolist() == list(range(16))


def brute_search(rows, k, queries):
    """Exact: the nearest distinct rows in double precision, ties to the least id."""
    kept = {(i, tuple(np.float32(v).astype(float))) for i, v, _ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    asked = {}
    for i, v in kept:
        if i in queries:
            asked[i] = min(asked.get(i, v), v)
    out = {}
    for q, v in asked.items():
        near = sorted((-float((np.array(v) * np.array(w)).sum()), i) for i, w in kept if i != q and len(w) == len(v))
        out[q] = [(i, -s) for s, i in near[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.found_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    hits = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in near}) for q, near in want.items())
    return hits / max(1, sum(map(len, want.values())))


@pytest.mark.parametrize("shards", [1, 3])
def test_graph_search(spark, shards):
    rng = np.random.default_rng(shards)
    rows = [(i, (np.array(v) * rng.uniform(0.3, 3)).tolist(), label) for i, v, label in some_vectors(3000, 24, 9)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("shard", F.lit("clash")).repartition(6)
    settings = graphs.Settings(shards=shards, beam=64)
    got = found(graphs.search(graphs.build(df, settings=settings), df.filter("vec_id % 20 = 0"), k=20, settings=settings))
    want = brute_search(rows, 20, range(0, 3000, 20))
    assert recall(got, want) > 0.97 and set(got) == set(want)
    for q, near in got.items():
        exact = dict(brute_score(rows, q))
        assert [s for _, s in near] == pytest.approx([exact[i] for i, _ in near], rel=1e-14)
        assert near == sorted(near, key=lambda x: (-x[1], x[0]))


def brute_score(rows, q):
    vectors = {i: np.float32(v).astype(float) for i, v, _ in rows}
    return [(i, float(vectors[q] @ v)) for i, v in vectors.items() if i != q]


def test_graph_search_of_copies_and_odd_rows(spark):
    """A vector with many copies fills answers with its least ids; few rows are all found; widths do not mix."""
    copy = [0.5, 0.5, 0.5, 0.5]
    rows = [(5000 + i, copy, 1) for i in range(900)] + some_vectors(40, 4, 3) + odd_vectors(4)
    rows += [(60, copy, 1), (60, [9.0, 0.0, 0.0, 0.0], 1), (80, [1.0, 2.0], 1), (100, [2.0, -1.0], 1), (120, [], 1), (7777, [3.0, 3.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    ids = {i for i, _, _ in rows if i is not None and i % 20 == 0}
    want = brute_search(rows, 20, ids)
    got = found(graphs.search(graphs.build(df), df.filter("vec_id % 20 = 0")))
    assert got == want and len(want) > 40
    empty = df.filter("vec_id < -1")
    assert graphs.search(graphs.build(empty), empty).count() == 0
    assert graphs.search(graphs.build(df), empty).count() == 0
