"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence with itself.

1. Documents with equal shingle sets become one node (128 bits of digest, and the size).
2. Columns are put in an order: n-grams that many documents share last, others by hash. Two linked documents share at
   least so many columns at the beginning of their rows, as far as a size-derived bound says; only those columns are
   shuffled. Overlaps in them are added up for the pairs of each short column, and pairs below their bound are
   discarded. In a long column, documents of fitting sizes are chained instead; but only those with so many long
   columns that they can reach the bound by these.
3. Pairs and chains make groups. The whole rows of a group are shuffled once and multiplied with each other: overlaps
   add up over blocks of columns, and pairs that can no longer reach their bound are discarded. A group larger
   than a block is dealt to pairs of blocks. Every task returns a spanning forest and link counts, not the pairs.
4. The forests make the components.

No step gathers the documents of a long column, and no pair of a large group leaves its task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm import arrays
from linkloom.llm.components import components
from linkloom.llm.numbered import ROW, numbered
from linkloom.operators.sizes import small
from linkloom.operators.skew import skew_join
from linkloom.session import materialize

# Most n-grams that go last because many documents share them: their list is sent to all tasks, 8 bytes each.
MOST_COMMON = 200_000
# An n-gram of fewer documents than this is not on that list, whatever else is.
COMMON_FROM = 16
# n-grams in a block of documents, which is what a task holds at a time.
BLOCK_SHINGLES = 1 << 20
_COLUMNS = 4096
_SALTS = 64
# A column of more documents is chained.
LONG = 16


def shingle_sets(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the distinct ``n``-word shingles of each text, end to end, and their borders."""
    data, offsets = arrays.text_bytes(column)
    data = arrays.lower_ascii(data)
    starts, ends, first = arrays.words(data, offsets)
    hashes = arrays.word_hashes(data, starts, ends)
    at = arrays.window_starts(first, n)
    keys = arrays.span_hashes(hashes, at, at + n)
    borders = np.searchsorted(at, first)
    counts = np.diff(first)
    brief = np.flatnonzero((counts > 0) & (counts < n))
    whole = dict(zip(brief.tolist(), arrays.span_hashes(hashes, first[brief], first[brief + 1]), strict=True))
    sets = [np.unique(keys[borders[i] : borders[i + 1]]) if i not in whole else np.array([whole[i]], np.uint64) for i in range(len(counts))]
    return np.concatenate([np.zeros(0, np.uint64), *sets]), np.cumsum([0, *map(len, sets)])


def _map(docs: DataFrame, columns: list[str], schema: str, make: Callable[..., list[pa.Array]], n: int, text: str) -> DataFrame:
    """``make(part, keys, borders)`` gives the columns of ``schema`` for a slice of documents."""
    names = [field.split()[0] for field in schema.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrays.slices(batches, text):
            yield pa.RecordBatch.from_arrays(make(part, *shingle_sets(part.column(text), n)), names)

    return docs.select(*columns, text).mapInArrow(run, schema)


def _signed(keys: np.ndarray) -> pa.Array:
    return pa.array(keys.view(np.int64))


def digests(docs: DataFrame, n: int, text: str = "text") -> DataFrame:
    """(__row, n_shingles, high, low) for each row: the size and the digest of its shingle set. And (shingle, n): n-grams that
    come three times within a few million n-grams of a task, in rows of their own."""
    schema = f"{ROW} long, n_shingles long, high long, low long, shingle long, n long"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for part in arrays.slices(batches, text):
            keys, borders = shingle_sets(part.column(text), n)
            raw = [hashlib.blake2b(keys[a:b].tobytes(), digest_size=16).digest() for a, b in zip(borders[:-1], borders[1:], strict=True)]
            halves = np.frombuffer(b"".join(raw), np.int64).reshape(-1, 2)
            none = pa.nulls(part.num_rows, pa.int64())
            yield _batch(schema, [part.column(ROW), pa.array(np.diff(borders)), pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()), none, none])
            held.append(keys)
            size += len(keys)
            if size > 4 * BLOCK_SHINGLES:
                yield _frequent(schema, held)
                held, size = [], 0
        yield _frequent(schema, held)

    return docs.select(ROW, text).mapInArrow(run, schema)


def _batch(schema: str, columns: list[pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(columns, [field.split()[0] for field in schema.split(", ")])


def _frequent(schema: str, held: list[np.ndarray]) -> pa.RecordBatch:
    keys, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *held]), return_counts=True)
    often = counts > 2
    return _batch(schema, [*[pa.nulls(int(often.sum()), pa.int64())] * 4, _signed(keys[often]), pa.array(counts[often])])


def common_shingles(found: DataFrame, most: int = MOST_COMMON, least: int = COMMON_FROM) -> np.ndarray:
    """Sorted hashes of the ``most`` n-grams that many documents share, by the sums of ``digests``. The list decides on the order
    of columns only."""
    counts = found.filter("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("n").alias("n"))
    top = counts.filter(F.col("n") >= least).orderBy(F.desc("n"), "shingle").limit(most).select("shingle").toArrow()
    return np.sort(np.concatenate([np.zeros(0, np.int64), top.column("shingle").to_numpy()]).astype(np.int64).view(np.uint64))


def _postings(docs: DataFrame, n: int, percent: int, common: np.ndarray, text: str) -> DataFrame:
    """(shingle, salt, node, size): the columns at the beginning of each row. Common ones have a salt, as their lists may be
    long, which spreads nodes evenly; for the others it is -1."""
    def make(part, keys, borders):
        last = np.isin(keys, common) if len(common) else np.zeros(len(keys), bool)
        sizes = np.diff(borders)
        # Partners share at least ceil(percent * size / 100) columns, so as many as are needed of the first ones of both.
        first = sizes - (percent * sizes + 99) // 100 + 1 + sizes // 20
        chosen = [np.zeros(0, np.int64)]
        for a, b, k in zip(borders[:-1], borders[1:], first, strict=True):
            early = np.flatnonzero(~last[a:b])
            chosen.append(a + np.concatenate([early, np.flatnonzero(last[a:b])])[: k if b > a else 0])
        at = np.concatenate(chosen)
        rows = np.searchsorted(borders, at, side="right") - 1
        node = part.column(ROW).to_numpy()[rows]
        salt = np.where(last[at], (arrays.mix(node) % np.uint64(_SALTS)).astype(np.int64), -1)
        return [_signed(keys[at]), pa.array(salt.astype(np.int32)), pa.array(node), pa.array(sizes[rows].astype(np.int32))]

    return _map(docs, [ROW], "shingle long, salt int, node long, size int", make, n, text)


def _needed(size: Column) -> Column:
    """Columns among the first ones that a document of ``size`` shares with a linked one that is not smaller."""
    return 1 + F.floor(size / 20)


def _by_long(needed: Column) -> Column:
    """So many of them in long columns, or the rest and one more in short ones: one of both holds."""
    return 1 + F.floor((needed - 1) / 2)


def _candidates(postings: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of nodes with overlap enough in short columns; and in long columns, nodes that follow each other
    by size, where the sizes allow a link.

    A common column is chained within each of its salts; the first node of each salt and size then
    stands for all of them when salts are chained with each other.
    """
    def fits(smaller: Column, larger: Column) -> Column:
        return 100 * smaller.cast("long") >= percent * larger.cast("long")

    def chained(rows: DataFrame, *by: str) -> DataFrame:
        order = Window.partitionBy(*by).orderBy("size", "salt", "node")
        return rows.withColumns({f"_{c}": F.lag(c).over(order) for c in ("node", "size")})

    counted = postings.withColumn("_n", F.count("*").over(Window.partitionBy("shingle", "salt")))
    columns = ["shingle", "salt", "node", "size"]
    kept = materialize(counted.filter("salt >= 0 OR _n > 1"), "columns")
    is_long = (F.col("salt") >= 0) | (F.col("_n") > LONG)

    least = F.floor((F.col("size").cast("long") * percent + 99) / 100)
    able = kept.filter(is_long).groupBy("node", "size").agg(F.count("*").alias("_long")).filter(F.col("_long") >= _by_long(_needed(least)))
    reaching = kept.filter(is_long).select(*columns).join(able.select("node"), "node", "left_semi")
    follows = F.col("_size").isNotNull() & fits(F.col("_size"), F.col("size"))
    stands = (F.col("salt") >= 0) & (F.col("_size").isNull() | (F.col("size") != F.col("_size")))
    within = materialize(chained(reaching, "shingle", "salt").filter(follows | stands), "chains")
    between = chained(within.filter(stands).select(*columns), "shingle")
    chains = [part.filter(follows).select(F.col("_node").alias("a"), F.col("node").alias("b")) for part in (within, between)]

    lists = kept.filter(~is_long).groupBy("shingle").agg(F.sort_array(F.collect_list(F.struct("size", "node"))).alias("docs"))
    first = lists.select("docs", F.posexplode("docs").alias("i", "x"))
    pairs = first.select("x", F.explode(F.slice("docs", F.col("i") + 2, F.lit(LONG))).alias("y")).filter(fits(F.col("x.size"), F.col("y.size")))
    needed = _needed(F.col("x.size"))
    overlaps = pairs.groupBy(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).agg(
        F.count("*").alias("n"), F.min(needed + 1 - _by_long(needed)).alias("needed")
    )
    return chains[0].unionByName(chains[1]).unionByName(overlaps.filter("n >= needed").select("a", "b")).distinct()


def _dealt(groups: DataFrame, block_shingles: int, block_docs: int) -> DataFrame:
    """Nodes (node, component, n_shingles, copies) with the task that multiplies them: (large, major, i, j), and
    their block. Groups that fit a block share tasks; larger ones go to every pair of their blocks."""
    sizes = groups.groupBy("component").agg(F.sum("n_shingles").alias("_sum"), F.count("*").alias("_count"))
    blocks = F.greatest(F.ceil(F.col("_sum") / block_shingles), F.ceil(F.col("_count") / block_docs)).cast("int")
    sizes = materialize(sizes.select("component", "_sum", "_count", blocks.alias("_blocks")), "group-sizes")
    held = sizes.filter("_blocks = 1").agg(F.sum("_sum").alias("shingles"), F.sum("_count").alias("docs")).first()
    buckets = max(1, -(-(held.shingles or 0) // block_shingles), -(-(held.docs or 0) // block_docs))
    rows = groups.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int"))
    one = rows.filter("_blocks = 1").select(
        "node", "component", "copies", "block", F.lit(False).alias("large"), F.pmod(F.xxhash64("component"), F.lit(buckets)).alias("major"),
        F.lit(0).alias("i"), F.lit(0).alias("j"),
    )
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    many = rows.filter("_blocks > 1").select("*", other.alias("_other")).select(
        "node", "component", "copies", "block", F.lit(True).alias("large"), F.col("component").alias("major"),
        F.least("block", "_other").alias("i"), F.greatest("block", "_other").alias("j"),
    )
    return one.unionByName(many)


def _multiply(table: pa.Table, percent: int) -> pa.Table:
    """(node, root, links): for the groups of one task, the smallest node of each forest tree, and the documents linked."""
    table = table.combine_chunks().sort_by([("component", "ascending"), ("node", "ascending")])
    component, node, copies, block = (table.column(c).to_numpy() for c in ("component", "node", "copies", "block"))
    lists = table.column("keys").combine_chunks()
    keys = lists.flatten().to_numpy()
    borders = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
    cross = bool(len(node)) and table.column("i")[0].as_py() != table.column("j")[0].as_py()
    root, links = node.copy(), np.zeros(len(node), np.int64)
    edges = np.flatnonzero(np.concatenate([[True], component[1:] != component[:-1], [True]])) if len(node) else np.zeros(1, int)
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        linked = _linked(keys[borders[a] : borders[b]], borders[a : b + 1] - borders[a], block[a:b] if cross else None, percent)
        label = np.arange(b - a)
        while True:
            least = np.minimum(label, np.where(linked, label[None, :], b - a).min(axis=1))
            least = least[least]
            if (least == label).all():
                break
            label = least
        root[a:b] = node[a:b][label]
        links[a:b] = linked @ copies[a:b]
    return pa.table({"node": node, "root": root, "links": links})


def _linked(keys: np.ndarray, borders: np.ndarray, block: np.ndarray | None, percent: int) -> np.ndarray:
    """Which documents of a block (of two blocks: from one to the other) are linked: the product of their rows of
    the incidence matrix, added up over blocks of columns."""
    sizes = np.diff(borders)
    m = len(sizes)
    rows = np.repeat(np.arange(m), sizes)
    order = np.argsort(keys, kind="stable")
    keys, rows = keys[order], rows[order]
    new = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, bool)
    column = np.cumsum(new) - 1
    width = np.bincount(column)
    total = sizes[:, None] + sizes[None, :]
    alive = (100 * np.minimum(sizes[:, None], sizes[None, :]) >= percent * np.maximum(sizes[:, None], sizes[None, :])) & ~np.eye(m, dtype=bool)
    if block is not None:
        alive &= block[:, None] != block[None, :]
    overlap = np.zeros(m * m, np.int64)
    few = width[column] <= 8
    for d in range(1, 8):
        same = (column[d:] == column[:-d]) & few[d:]
        if not same.any():
            break
        overlap += np.bincount(rows[:-d][same] * m + rows[d:][same], minlength=m * m)
    overlap = overlap.reshape(m, m)
    overlap = overlap + overlap.T
    rows, column = rows[~few], column[~few]
    names, column = np.unique(column, return_inverse=True)
    for start in range(0, len(names), _COLUMNS):
        # What the remaining columns can still add bounds each pair.
        left = np.bincount(rows[column >= start], minlength=m)
        alive &= (100 + percent) * (overlap + np.minimum(left[:, None], left[None, :])) >= percent * total
        used = np.flatnonzero(alive.any(axis=1))
        if not len(used):
            break
        place = np.full(m, -1)
        place[used] = np.arange(len(used))
        here = (column >= start) & (column < start + _COLUMNS) & (place[rows] >= 0)
        dense = np.zeros((len(used), min(_COLUMNS, len(names) - start)), np.float32)
        dense[place[rows[here]], column[here] - start] = 1
        overlap[np.ix_(used, used)] += (dense @ dense.T).astype(np.int64)
    return alive & ((100 + percent) * overlap >= percent * total)


def labelled(
    docs: DataFrame, n: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text",
    block_shingles: int = BLOCK_SHINGLES, block_docs: int = 1024, most_common: int = MOST_COMMON, common_from: int = COMMON_FROM,
) -> DataFrame:
    """``jaccard_join`` for rows numbered by ``numbered``: (__row, doc_id, n_shingles, n_links, component_id, first).

    Rows are told apart by their numbers alone. ``first`` is true for one row of each component: that of the smallest doc_id
    (null: last), and of the smallest number among those.
    """
    docs = docs.select(ROW, F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = materialize(digests(docs, n), "digests")
    common = common_shingles(found, most_common, common_from)
    found = found.filter("shingle IS NULL").select(ROW, "n_shingles", F.when(F.col("n_shingles") > 0, F.struct("n_shingles", "high", "low")).alias("_class"))
    # Equal sets are one node, by the number of one of their rows. A class with a large share of all rows is spread over tasks.
    classes = found.filter("n_shingles > 0").groupBy("_class").agg(F.min(ROW).alias("rep"), F.count("*").alias("copies"))
    classes = materialize(classes, "classes")
    members = skew_join(found, classes, "_class", F.col(ROW), counts=classes.select("_class", F.col("copies").alias("n")))
    members = materialize(members.select(ROW, "n_shingles", "rep", "copies"), "members")
    others = members.filter(F.col("rep").isNull() | (F.col("rep") != F.col(ROW))).select(ROW)
    single = docs.join(small(materialize(others, "copies")), ROW, "left_anti").select(ROW, "text")
    pairs = materialize(_candidates(_postings(single, n, percent, common, "text"), percent), "pairs")
    groups = components(pairs)
    own = classes.select(F.col("rep").alias("node"), F.col("_class.n_shingles").alias("n_shingles"), "copies")
    groups = materialize(groups.join(own, "node"), "groups")
    dealt = materialize(_dealt(groups, block_shingles, block_docs), "dealt")
    rows = docs.select(ROW, "text").join(small(dealt.select(F.col("node").alias(ROW)).distinct()), ROW, "left_semi")

    def make(part, keys, borders):
        return [part.column(ROW), pa.ListArray.from_arrays(pa.array(borders, pa.int32()), _signed(keys))]

    # Only sets travel to the blocks, however many these are.
    sets = _map(rows, [ROW], "node long, keys array<long>", make, n, "text").join(small(dealt), "node")
    forest = materialize(
        sets.groupBy("large", "major", "i", "j").applyInArrow(lambda table: _multiply(table, percent), "node long, root long, links long"), "forest"
    )
    ends = components(forest.select(F.col("node").alias("a"), F.col("root").alias("b")))
    degrees = forest.groupBy("node").agg(F.sum("links").alias("links"))
    labels = materialize(degrees.join(ends, "node", "left").withColumnRenamed("node", "rep"), "labels")
    placed = skew_join(members, labels, "rep", F.col(ROW), counts=classes.select("rep", F.col("copies").alias("n")))
    # Rows without shingles are components of their own.
    placed = placed.withColumn("_component", F.coalesce("component", "rep", ROW)).join(docs.select(ROW, "doc_id"), ROW)
    placed = materialize(placed.select(ROW, "doc_id", "n_shingles", "links", "copies", "_component"), "placed")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", ROW)).alias("_least")
    ids = placed.groupBy("_component").agg(least, F.count("*").alias("n"))
    ids = materialize(ids.filter("n > 1").select("_component", F.col("_least.doc_id").alias("_id"), F.col(f"_least.{ROW}").alias("_row"), "n"), "components")
    joined = skew_join(placed, ids.drop("n"), "_component", F.col(ROW), counts=ids.select("_component", "n"))
    return joined.select(
        ROW, "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.coalesce("links", F.lit(0)) + F.col("copies") - 1).otherwise(F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("_row").isNull(), F.col("doc_id")).otherwise(F.col("_id")).alias("component_id"),
        (F.col("_row").isNull() | (F.col("_row") == F.col(ROW))).alias("first"),
    )


def jaccard_join(docs: DataFrame, n: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text", **plan: int) -> DataFrame:
    """(doc_id, n_shingles, n_links, component_id): per row of ``docs``, the size of its set of ``n``-word shingles,
    the number of other rows that it is linked with, and the smallest doc_id that links lead to, its own included.

    Words are what white space (ASCII) separates, A-Z in lower case; a text of fewer words than ``n`` is one shingle.
    Rows link when 100 * intersection >= percent * union. Texts without words and null texts have no shingle and no
    links. Rows are linked as rows, whatever their ids: repeated ids and null ids are no special case, and null is the
    component of rows only where no row that links lead to has an id. Ties and repeated rows are links like others; an empty
    table gives no rows. Other columns play no part. ``plan`` sets the sizes of blocks and lists of ``labelled``.
    """
    found = labelled(numbered(docs.select(doc_id, text)), n, percent, doc_id, text, **plan)
    return found.select(F.col("doc_id").alias(doc_id), "n_shingles", "n_links", "component_id")
