"""Compression of vectors to codes: product quantisation in whole numbers, with a Walsh-Hadamard transform.

Components become integers; a vector is cut into parts, and each part is the index of the nearest entry of its codebook.
Parts and entries are padded with zeros to a power of two and transformed (sums and differences only), which multiplies
all squared distances by the padded length. Squared differences are added up in sequency order, where most of a smooth
part's energy comes first: an entry whose sum so far is beyond the whole distance of another one is dropped. Dropping is
exact, and nothing is computed in floating point.

Codebooks are fitted on all rows: each round is one pass, in which a task adds its parts up by entry, and only these
sums (of the size of the codebooks) are shuffled and go to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.operators.sizes import fits_broadcast
from linkloom.operators.skew import lookup_join
from linkloom.session import materialize

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
# Rows whose distances to all entries a task holds at a time, and components of a step of elimination.
_ROWS = 512
# Below this, all sums of squares fit 64 bits; larger components are computed as Python's whole numbers.
_SAFE = 1 << 62
# Scaled components have to stay below this.
_MOST = 1 << 62


def usable(vector: str) -> Column:
    """Whether a vector takes part: not null, and all its components are finite numbers."""
    finite = lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))
    return F.col(vector).isNotNull() & F.forall(F.transform(vector, lambda x: x.cast("double")), finite)


def transform(parts: np.ndarray) -> np.ndarray:
    """Padded parts in sequency order: (rows, width) to (rows, padded width)."""
    rows, width = parts.shape
    size = 1 << max(0, width - 1).bit_length()
    out = np.zeros((rows, size), parts.dtype)
    out[:, :width] = parts
    step = 1
    while step < size:
        pairs = out.reshape(rows, size // (2 * step), 2, step)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(rows, size)
        step *= 2
    return out[:, _sequency(size)]


def _sequency(size: int) -> np.ndarray:
    """The natural index of the row with 0, 1, 2, … sign changes: its Gray code with the bits reversed."""
    bits = size.bit_length() - 1
    gray = np.arange(size) ^ (np.arange(size) >> 1)
    return sum((((gray >> k) & 1) << (bits - 1 - k) for k in range(bits)), np.zeros(size, np.int64))


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each part the index of the nearest entry (ties: the lowest) and the squared distance, both (rows, width)."""
    most = max((int(np.abs(x).max()) for x in (parts, entries) if x.size), default=0)
    size = 1 << max(0, parts.shape[1] - 1).bit_length()
    exact = 4 * most * most * size**3 < _SAFE
    left, right = (transform(x if exact else x.astype(object)) for x in (parts, entries))
    found = [_nearest(left[a : a + _ROWS], right) for a in range(0, len(left), _ROWS)]
    index = np.concatenate([np.zeros(0, np.int64), *[i for i, _ in found]])
    return index, np.concatenate([np.zeros(0, np.int64 if exact else object), *[d // size for _, d in found]])


def _nearest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``nearest`` for transformed parts: distances are those of the parts, times their padded width."""
    step = max(1, right.shape[1] // 4)
    sums = np.zeros((len(left), len(right)), left.dtype)
    for k in range(step):
        gap = left[:, k, None] - right[None, :, k]
        sums += gap * gap
    # The whole distance to the best entry so far bounds the others.
    rows = np.arange(len(left))
    bound = ((left - right[sums.argmin(axis=1)]) ** 2).sum(axis=1)
    row, entry = np.nonzero(sums <= bound[:, None])
    total = sums[row, entry]
    for start in range(step, right.shape[1], step):
        for k in range(start, min(start + step, right.shape[1])):
            gap = left[row, k] - right[entry, k]
            total = total + gap * gap
        alive = total <= bound[row]
        row, entry, total = row[alive], entry[alive], total[alive]
    # Rows and entries are in order still: the first of the least ones is the lowest.
    starts = np.searchsorted(row, rows)
    least = np.minimum.reduceat(total, starts) if len(rows) else total
    best = np.flatnonzero(total == least[row])
    first = best[np.searchsorted(row[best], rows)]
    return entry[first], least


def _integers(column: pa.Array, width: int) -> np.ndarray:
    """floor(1024 x) of each vector, with zeros at the end of shorter ones."""
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    values = np.floor(pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
    if values.size and np.abs(values).max() >= _MOST:
        raise ValueError(f"vectors with components of {_MOST // SCALE} or more cannot be coded")
    out = np.zeros((len(column), width), np.int64)
    inside = np.arange(width) < sizes[:, None]
    out[inside] = values.astype(np.int64)
    return out


def _start(kept: DataFrame, row_id: str, vector: str, width: int) -> np.ndarray:
    """The parts of the rows of smallest id: (part, entry, component). A codebook's size bounds what is collected."""
    first = kept.filter(F.col(row_id).isNotNull()).orderBy(row_id, vector).limit(ENTRIES).select(vector).toArrow()
    rows = _integers(first.column(0).combine_chunks(), width)
    return rows.reshape(len(rows), PARTS, width // PARTS).transpose(1, 0, 2)


def _round(kept: DataFrame, vector: str, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: each entry the floor of the mean of its parts."""
    parts, entries, width = books.shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, entries, width), object)
        counts = np.zeros((parts, entries), np.int64)
        for batch in batches:
            rows = _integers(batch.column(0), parts * width)
            for p in range(parts):
                own = rows[:, p * width : (p + 1) * width]
                index, _ = nearest(own, books[p])
                order = np.argsort(index, kind="stable")
                used, starts = np.unique(index[order], return_index=True)
                if len(used):
                    wide = own.dtype if np.abs(own).max() < 1 << 40 else object
                    sums[p, used] += np.add.reduceat(own[order].astype(wide), starts, axis=0).astype(object)
                counts[p] += np.bincount(index, minlength=entries)
        part, entry = np.nonzero(counts)
        total = [[Decimal(int(x)) for x in sums[p, e]] for p, e in zip(part, entry, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(counts[part, entry]), pa.array(total, pa.list_(pa.decimal128(38, 0)))],
            ["part", "entry", "n", "sums"],
        )

    found = kept.select(vector).mapInArrow(run, "part int, entry int, n long, sums array<decimal(38,0)>")
    totals = found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(width)])
    books = books.copy()
    for row in totals.toArrow().to_pylist():
        books[row["part"], row["entry"]] = [int(row[f"s{k}"]) // row["n"] for k in range(width)]
    return books


def compress(
    rows: DataFrame, row_id: str = "vec_id", vector: str = "embedding", carry: list[str] | None = None, rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """(id, code, error, …carry) of each usable vector, as a table, and the codebooks (part, entry, component).

    Rows with a null vector, or with null or non-finite components, are left out. Vectors shorter than the longest, and widths
    that parts do not divide, are filled up with zeros. Codebooks start as the rows of smallest id (ties: least
    vector; null ids do not count); fewer rows make smaller codebooks, and without rows there are none. Rows are coded one by
    one, so null ids, repeated rows and ties are no special case. Other columns play no part.
    """
    carry = [c for c in carry or [] if c not in (row_id, "code", "error")]
    kept = rows.filter(usable(vector)).select(row_id, F.col(vector).cast("array<double>").alias(vector), *[c for c in carry if c != vector])
    width = kept.agg(F.max(F.size(vector))).first()[0] or 0
    width += -width % PARTS
    books = _start(kept, row_id, vector, max(width, PARTS))
    for _ in range(rounds if books.size else 0):
        books = _round(kept, vector, books)
    types = {f.name: f for f in kept.schema.fields}
    fields = [types[row_id], T.StructField("code", T.StringType()), T.StructField("error", T.DecimalType(38, 0)), *[types[c] for c in carry]]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = _integers(batch.column(vector), books.shape[0] * books.shape[2])
            found = [nearest(whole[:, p * books.shape[2] : (p + 1) * books.shape[2]], books[p]) for p in range(PARTS)]
            code = np.stack([index for index, _ in found], axis=1).astype(np.uint8)
            error = sum(distance.astype(object) for _, distance in found)
            names = pa.array([row.tobytes().hex() for row in code], pa.string())
            error = pa.array([Decimal(int(e)) for e in error], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([batch.column(row_id), names, error, *[batch.column(c) for c in carry]], [f.name for f in fields])

    if not books.size:
        empty = kept.filter(F.lit(False)).select(row_id, F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), *carry)
        return materialize(empty, "codes"), books
    coded = kept.mapInArrow(run, T.StructType(fields))
    return materialize(coded.withColumn("error", F.expr("try_cast(error AS long)")), "codes"), books


def book_digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, in decimal, with commas between."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def label_errors(coded: DataFrame, books: np.ndarray, label: str = "label") -> DataFrame:
    """``coded`` with ``label_error``, the errors summed over rows of one label (nulls are one), and the codebooks' digest.

    Labels with a large share of the rows stay where they are: sums come from map-side combined aggregates. A sum beyond 64
    bits is null."""
    keyed = coded.withColumn("_label", F.coalesce(F.concat(F.lit("="), F.col(label).cast("string")), F.lit("")))
    sums = keyed.groupBy("_label").agg(F.expr("try_cast(sum(cast(error AS decimal(38,0))) AS long)").alias("label_error"))
    sums = materialize(sums, "label-errors")
    out = keyed.join(F.broadcast(sums), "_label", "left") if fits_broadcast(sums) else lookup_join(keyed, sums, "_label")
    return out.drop("_label", label).withColumn("codebooks_sha256", F.lit(book_digest(books)))
