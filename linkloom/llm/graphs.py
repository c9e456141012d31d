"""Approximate nearest neighbours by inner product: a robust-pruned directed graph for each shard, searched by beams.

Rows of equal vectors are one node, with the few least ids that can be in an answer. Nodes are dealt to shards by a hash of
the vector. A shard's nodes are put into its graph in batches of growing size: a greedy search of the graph so far proposes
neighbours, and of these only such stay as are not much nearer to a chosen one than to the node itself (relaxed by a
factor); edges go both ways, and lists that get too long are pruned again. A query searches each shard with a beam of candidates, a
block of queries at a time; scores are exact, and the best of all shards are ranked.

Vectors are divided by the shard's longest and get one more component that makes them equally long, so that the
largest inner product is the least distance.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.codes import usable
from linkloom.operators.sizes import small
from linkloom.session import materialize


@dataclass(frozen=True)
class Settings:
    """``degree`` bounds the edges of a node, ``beam`` the candidates of a search, ``proposed`` the neighbours to choose
    from, ``relax`` is the factor on distances between neighbours. A shard has at most ``shard_components`` numbers, which
    a task holds; below that there are up to ``shards``, of at least ``shard_rows`` nodes."""

    degree: int = 24
    beam: int = 96
    build_beam: int = 40
    proposed: int = 56
    relax: float = 1.2
    shards: int = 16
    shard_rows: int = 1024
    shard_components: int = 1 << 24
    wide: int = 4
    seed: int = 11


# Entries of a block's map of visited nodes, one byte each.
_VISITED = 1 << 26
_BLOCK = 512


def _vectors(column: pa.Array) -> np.ndarray:
    """Vectors of one width, in double precision."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _longer(vectors: np.ndarray) -> np.ndarray:
    """Vectors over the longest one, with a component more that makes all lengths 1."""
    peak = np.abs(vectors).max()
    scaled = vectors / peak
    lengths = np.square(scaled).sum(axis=1)
    most = lengths.max()
    return np.column_stack([scaled / np.sqrt(most), np.sqrt(np.maximum(0, 1 - lengths / most))]).astype(np.float32)


def _queries(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    scaled /= np.sqrt(np.square(scaled).sum(axis=1, keepdims=True))
    return np.column_stack([scaled, np.zeros(len(scaled))]).astype(np.float32)


def _alike(nodes: np.ndarray, ids: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Inner products of each query with its own list of nodes."""
    return np.matmul(nodes[ids], queries[:, :, None])[:, :, 0]


def beam_search(nodes: np.ndarray, edges: np.ndarray, start: int, queries: np.ndarray, beam: int, wide: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` nearest nodes found for each query of a block, and their inner products, nearest first; -1: none.

    All queries of the block move together: each step follows the edges of the ``wide`` nearest candidates that were not
    followed yet, until all candidates were.
    """
    n = len(queries)
    seen = np.zeros((n, len(nodes) + 1), bool)
    seen[:, -1] = True
    ids = np.full((n, beam), -1, np.int32)
    near = np.full((n, beam), -np.inf, np.float32)
    followed = np.ones((n, beam), bool)
    ids[:, 0], near[:, 0], followed[:, 0] = start, queries @ nodes[start], False
    seen[:, start] = True
    active = np.arange(n)
    while len(active):
        own, close, done = ids[active], near[active], followed[active]
        # Candidates are in order, so the first ones not followed are the nearest.
        turn = np.cumsum(~done, axis=1)
        pick = ~done & (turn <= wide)
        row, place = np.nonzero(pick)
        found = np.full((len(active), wide, edges.shape[1]), -1, np.int32)
        found[row, turn[row, place] - 1] = edges[own[row, place]]
        found = np.sort(found.reshape(len(active), -1), axis=1)
        found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
        new = ~seen[active[:, None], found]
        # Lists are cut to the longest one that is new.
        width = int(new.sum(axis=1).max(initial=0))
        order = np.argsort(~new, axis=1, kind="stable")[:, :width]
        found = np.where(np.take_along_axis(new, order, 1), np.take_along_axis(found, order, 1), -1)
        seen[active[:, None], found] = True
        score = np.where(found >= 0, _alike(nodes, found, queries[active]), -np.inf).astype(np.float32)
        every = np.concatenate([close, score], axis=1)
        top = np.argsort(-every, axis=1, kind="stable")[:, :beam]
        ids[active] = own = np.take_along_axis(np.concatenate([own, found], axis=1), top, 1)
        near[active] = np.take_along_axis(every, top, 1)
        done = np.take_along_axis(np.concatenate([done | pick, np.zeros(score.shape, bool)], axis=1), top, 1) | (own < 0)
        followed[active] = done
        active = active[~done.all(axis=1)]
    return ids, near


def prune(nodes: np.ndarray, ids: np.ndarray, near: np.ndarray, degree: int, relax: float) -> np.ndarray:
    """Of each row's candidates (-1: none), the nearest, then again the nearest of those that are not ``relax`` times
    nearer to a chosen one than to the row's own node; at most ``degree``."""
    order = np.argsort(-near, axis=1, kind="stable")
    ids, near = np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)
    own = nodes[ids]
    between = 2 - 2 * np.matmul(own, own.transpose(0, 2, 1))
    away = 2 - 2 * near
    alive = ids >= 0
    out = np.full((len(ids), degree), -1, np.int32)
    rows = np.arange(len(ids))
    for k in range(degree):
        first = alive.argmax(axis=1)
        some = alive[rows, first]
        if not some.any():
            break
        out[some, k] = ids[rows, first][some]
        alive &= relax * relax * between[rows, first] > away
        alive[rows, first] = False
    return out


def graph(vectors: np.ndarray, settings: Settings = Settings()) -> tuple[np.ndarray, np.ndarray, int]:
    """The nodes (as ``_longer`` makes them), the edges (a row of ids for each, -1: none), and the node where searches begin."""
    nodes = _longer(vectors)
    n = len(nodes)
    edges = np.full((n, settings.degree), -1, np.int32)
    start = int((nodes @ nodes.mean(axis=0)).argmax())
    order = np.random.default_rng(settings.seed).permutation(n)
    order = order[order != start]
    done = 0
    while done < len(order):
        size = min(max(1, done), _BLOCK, max(1, _VISITED // n), max(8, n // 16))
        batch = order[done : done + size]
        ids, near = beam_search(nodes, edges, start, nodes[batch], settings.build_beam, settings.wide)
        own = prune(nodes, ids[:, : settings.proposed], near[:, : settings.proposed], settings.degree, settings.relax)
        edges[batch] = own
        _back(nodes, edges, batch, own, settings)
        done += size
    return nodes, edges, start


def _back(nodes: np.ndarray, edges: np.ndarray, batch: np.ndarray, own: np.ndarray, settings: Settings) -> None:
    """Edges from the chosen neighbours back to the new nodes; lists that get too long are pruned."""
    row, place = np.nonzero(own >= 0)
    to, new = own[row, place], batch[row]
    order = np.lexsort([-np.einsum("ij,ij->i", nodes[to], nodes[new]), to])
    to, new = to[order], new[order]
    targets, first, counts = np.unique(to, return_index=True, return_counts=True)
    rank = np.arange(len(to)) - np.repeat(first, counts)
    room = settings.proposed - settings.degree
    kept = rank < room
    lists = np.full((len(targets), settings.proposed), -1, np.int32)
    lists[:, : settings.degree] = edges[targets]
    lists[np.searchsorted(targets, to[kept]), settings.degree + rank[kept]] = new[kept]
    lists = np.where(lists == targets[:, None], -1, lists)
    much = (lists >= 0).sum(axis=1) > settings.degree
    packed = np.take_along_axis(lists, np.argsort(lists < 0, axis=1, kind="stable"), 1)
    edges[targets[~much]] = packed[~much, : settings.degree]
    if much.any():
        near = np.where(lists[much] >= 0, _alike(nodes, lists[much], nodes[targets[much]]), -np.inf).astype(np.float32)
        edges[targets[much]] = prune(nodes, lists[much], near, settings.degree, settings.relax)


# ---- Tables


def build(rows: DataFrame, row_id: str = "vec_id", vector: str = "embedding", keep: int = 21, settings: Settings = Settings()) -> DataFrame:
    """The index of all rows, a table: (width, shard, node, start, ids, vector, edges).

    A node is a vector, with the ``keep`` least ids that have it: enough for answers of one less, whose ties go to the least
    ids and leave out the query's own. Vectors that are null or zero, or have null or non-finite components, and rows without
    id take no part. Repeated rows count once; of different vectors with one id, each is a node. Vectors of different widths
    are in different graphs. Other columns play no part.
    """
    kept = rows.filter(usable(vector) & F.exists(vector, lambda x: x != 0) & F.col(row_id).isNotNull())
    kept = kept.select(F.col(row_id).cast("long").alias("id"), F.col(vector).alias("vector"))
    hashed = kept.select("id", "vector", F.size("vector").alias("width"), F.xxhash64("vector").alias("high"), F.xxhash64(F.lit(1), "vector").alias("low"))
    key = ["width", "high", "low"]
    first = Window.partitionBy(*key).orderBy("id")
    ids = hashed.select(*key, "id").distinct().withColumn("_rank", F.row_number().over(first)).filter(F.col("_rank") <= keep)
    ids = ids.groupBy(*key).agg(F.sort_array(F.collect_list("id")).alias("ids"))
    vectors = hashed.groupBy(*key).agg(F.first("vector").alias("vector"))
    nodes = materialize(vectors.join(ids, key).select("width", "high", "ids", "vector"), "nodes")

    most = F.greatest(F.lit(1), F.floor(F.lit(settings.shard_components) / F.col("width")))
    counts = nodes.groupBy("width").agg(F.count("*").alias("n"))
    shards = F.greatest(F.ceil(F.col("n") / most), F.least(F.lit(settings.shards), F.ceil(F.col("n") / settings.shard_rows)))
    counts = materialize(counts.select("width", shards.cast("int").alias("_shards")), "widths")
    dealt = nodes.join(small(counts), "width").select("width", F.pmod("high", "_shards").cast("int").alias("shard"), "ids", "vector")
    # Graphs are long work on few bytes: a number of partitions that is set keeps shards from being put together in one task.
    total = counts.agg(F.sum("_shards")).first()[0] or 1
    dealt = dealt.repartition(2 * total, "width", "shard")

    def run(table: pa.Table) -> pa.Table:
        # The order of rows after a shuffle is not fixed, that of ids is.
        least = pc.list_element(table.column("ids"), 0)
        table = table.take(pc.sort_indices(pa.table({"id": least}), [("id", "ascending")]))
        _, edges, start = graph(_vectors(table.column("vector")), settings)
        n = len(edges)
        lists = pa.array(list(edges), pa.list_(pa.int32()))
        return pa.table([
            table.column("width"), table.column("shard"), pa.array(np.arange(n, dtype=np.int32)), pa.array(np.full(n, start, np.int32)),
            table.column("ids"), table.column("vector"), lists,
        ], ["width", "shard", "node", "start", "ids", "vector", "edges"])

    kind = dict(nodes.dtypes)["vector"]
    schema = f"width int, shard int, node int, start int, ids array<long>, vector {kind}, edges array<int>"
    return materialize(dealt.groupBy("width", "shard").applyInArrow(run, schema), "graphs")


def search(index: DataFrame, queries: DataFrame, k: int = 20, row_id: str = "vec_id", vector: str = "embedding", settings: Settings = Settings()) -> DataFrame:
    """(query_id, rank, found_id, score): the ``k`` nearest rows found for each query, without rows of its own id; ties go to
    the least id. Scores are inner products in double precision.

    Queries that are null, zero, or not finite, and those without id, have no answer; of several vectors with one id, the least
    is asked. A task holds one shard and a block of queries, which stream by; every query goes to each shard of its width.
    """
    asked = queries.filter(usable(vector) & F.exists(vector, lambda x: x != 0) & F.col(row_id).isNotNull())
    asked = asked.groupBy(F.col(row_id).cast("long").alias("query_id")).agg(F.min(vector).alias("vector")).withColumn("width", F.size("vector"))
    shards = materialize(index.select("width", "shard").distinct(), "shards")
    copies = asked.join(small(shards), "width").select("width", "shard", F.lit(1).alias("kind"), "query_id", "vector")
    rows = index.withColumn("kind", F.lit(0)).unionByName(copies, allowMissingColumns=True)
    rows = rows.repartition(max(1, 2 * shards.count()), "width", "shard").sortWithinPartitions("width", "shard", "kind", "node")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        shard, ready = None, None
        for batch in batches:
            keys = np.column_stack([batch.column(c).to_numpy() for c in ("width", "shard", "kind")])
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                part, here = batch.slice(a, b - a), tuple(keys[a, :2])
                if here != shard:
                    shard, ready, held = here, None, []
                if not keys[a, 2]:
                    held.append(part)
                    continue
                if ready is None:
                    ready, held = _Shard(pa.Table.from_batches(held)), []
                block = max(1, min(_BLOCK, _VISITED // len(ready.nodes)))
                for at in range(0, part.num_rows, block):
                    yield ready.answer(part.slice(at, block), k, settings)

    found = rows.mapInArrow(run, "query_id long, found_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "found_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "found_id", "score")


class _Shard:
    """One shard in a task's memory."""

    def __init__(self, table: pa.Table) -> None:
        self.vectors = _vectors(table.column("vector"))
        self.nodes = _longer(self.vectors)
        self.edges = pc.list_flatten(table.column("edges")).to_numpy().reshape(len(self.nodes), -1)
        self.start = table.column("start")[0].as_py()
        ids = table.column("ids").combine_chunks()
        self.counts = pc.list_value_length(ids).to_numpy()
        self.ids, self.first = pc.list_flatten(ids).to_numpy(), np.cumsum(self.counts) - self.counts

    def answer(self, block: pa.RecordBatch, k: int, settings: Settings) -> pa.RecordBatch:
        """The ``k`` best rows of this shard for each query of a block."""
        vectors, query = _vectors(block.column("vector")), block.column("query_id").to_numpy()
        found, _ = beam_search(self.nodes, self.edges, self.start, _queries(vectors), max(settings.beam, 2 * k), settings.wide)
        scores = (self.vectors[found] * vectors[:, None, :]).sum(axis=2)
        row, place = np.nonzero(found >= 0)
        node, score = found[row, place], scores[row, place]
        counts = self.counts[node]
        row, score = np.repeat(row, counts), np.repeat(score, counts)
        ids = self.ids[np.repeat(self.first[node] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())]
        other = ids != query[row]
        row, score, ids = row[other], score[other], ids[other]
        order = np.lexsort([ids, -score, row])
        row, score, ids = row[order], score[order], ids[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        best = rank < k
        return pa.RecordBatch.from_arrays([pa.array(query[row[best]]), pa.array(ids[best]), pa.array(score[best])], ["query_id", "found_id", "score"])
