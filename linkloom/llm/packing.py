"""Sum-of-squares packing of tokenised documents into sequences of one length.

A document, or the remainder piece of a longer one, goes into the open sequence, or a new one, for which the sum
over all residual gaps of the squared number of open sequences with that gap becomes smallest. Pieces are
placed longest first. The sequences that this leaves open are then taken apart and their pieces placed by
best fit, which the rule is poor at for the last few.

Pieces are dealt to buckets of bounded size by a hash, so packing is parallel and a bucket's loss, part of
one sequence or so, is small against it. Texts are never shuffled: only the numbers of pieces are.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm import arrays, bpe_files
from linkloom.session import materialize

CAPACITY = 1024
# Remainder pieces in a bucket, packed by one task.
BUCKET_PIECES = 32_768
_PIECE = "piece int, start long, length long, ids_crc32 long"


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: of a longer one, all are full but for the first."""
    first = length % capacity or min(length, capacity)
    return [(0, first), *((at, capacity) for at in range(first, length, capacity))]


def tokenize(
    docs: DataFrame, vocabulary: str, pattern: str, end: int, capacity: int = CAPACITY,
    doc_id: str = "doc_id", text: str = "text", ids: bool = False, added: dict[str, int] | None = None,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32), and the token ``ids`` if asked for, of every piece.

    ``vocabulary`` is a rank file that tasks can open, ``added`` has tokens that are their own ids wherever they are in a text. ``end`` is the id put after each document, so that an
    empty or null text is a piece of one token.
    """
    kind = dict(docs.dtypes)[doc_id]
    names = [doc_id, "piece", "start", "length", "ids_crc32", *["ids"] * ids]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = bpe_files.encoding(vocabulary, pattern, added)
        for part in arrays.slices(batches, text):
            rows, found = [], []
            for i, value in enumerate(part.column(text).to_pylist()):
                tokens = np.array([*bpe_files.encode(own, value), end], "<u4")
                for k, (start, length) in enumerate(cut(len(tokens), capacity)):
                    piece = tokens[start : start + length]
                    rows.append((i, k, start, length, zlib.crc32(piece.tobytes())))
                    found.append(piece.astype(np.int32) if ids else None)
            owner, *numbers = np.array(rows, np.int64).T
            columns = [part.column(doc_id).take(pa.array(owner)), pa.array(numbers[0].astype(np.int32)), *map(pa.array, numbers[1:])]
            yield pa.RecordBatch.from_arrays([*columns, *[pa.array(found, pa.list_(pa.int32()))] * ids], names)

    return docs.select(doc_id, text).mapInArrow(run, f"{doc_id} {kind}, {_PIECE}" + ", ids array<int>" * ids)


def _place(lengths: np.ndarray, capacity: int, squares: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sequence and the offset of each piece, in the order given, and the gap left in each sequence."""
    count = np.zeros(capacity + 1, np.int64)
    open_with: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset, gaps = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), []
    for i, size in enumerate(lengths.tolist()):
        there = count[size:capacity]
        usable = np.flatnonzero(there)
        gap = capacity
        if len(usable) and squares:
            # Moving a sequence from gap g to g - size changes the sum by this; a filled one only leaves.
            change = 2 * (count[usable] - there[usable]) + 2
            if usable[0] == 0:
                change[0] = 1 - 2 * there[0]
            best = int(change.argmin())
            if change[best] <= 2 * count[capacity - size] + 1:
                gap = size + int(usable[best])
        elif len(usable):
            gap = size + int(usable[0])
        if gap == capacity:
            sequence[i] = len(gaps)
            gaps.append(capacity)
        else:
            sequence[i] = open_with[gap].pop()
            count[gap] -= 1
        offset[i] = capacity - gap
        gaps[sequence[i]] = gap - size
        if gap > size:
            open_with[gap - size].append(int(sequence[i]))
            count[gap - size] += 1
    return sequence, offset, np.array(gaps, np.int64)


def pack_lengths(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The sequence (numbered from 0) and the offset of each piece of one bucket."""
    order = np.argsort(-lengths, kind="stable")
    sequence, offset, gaps = _place(lengths[order], capacity, squares=True)
    again = gaps[sequence] > 0
    finished, place, _ = _place(lengths[order][again], capacity, squares=False)
    full = np.flatnonzero(gaps == 0)
    out = np.searchsorted(full, sequence)
    out[again], offset[again] = finished + len(full), place
    back = np.argsort(order)
    return out[back], offset[back]


def pack(pieces: DataFrame, capacity: int = CAPACITY, bucket_pieces: int = BUCKET_PIECES) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: each in a sequence of at most ``capacity`` tokens, without gaps.

    ``pieces`` (… length, ids_crc32) should be a table, as it is read twice. Ties in length, repeated rows and null
    ids are packed row by row; an empty table gives none.
    """
    rest = pieces.filter(F.col("length") < capacity).count()
    buckets = max(1, -(-rest // bucket_pieces))
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64("ids_crc32", "piece", F.monotonically_increasing_id()), F.lit(buckets)))

    def run(table: pa.Table) -> pa.Table:
        order = [(name, "ascending") for name in table.column_names if not pa.types.is_nested(table.schema.field(name).type)]
        table = table.sort_by(order)
        sequence, offset = pack_lengths(table.column("length").to_numpy(), capacity)
        ids = table.column("_bucket").to_numpy() * (1 << 32) + sequence
        return table.drop_columns(["_bucket"]).append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offset))

    schema = ", ".join(f"`{name}` {kind}" for name, kind in pieces.dtypes) + ", sequence_id long, offset long"
    return dealt.groupBy("_bucket").applyInArrow(run, schema)


def pack_documents(
    docs: DataFrame, vocabulary: str, pattern: str, end: int, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text",
    added: dict[str, int] | None = None,
) -> DataFrame:
    """The pieces of all documents with their places: tokenised once, written as a table of numbers, packed.

    A null text is an empty document. Rows are packed one by one, so repeated ids and null ids are no special case;
    extra columns play no part. No document is dropped or cut short.
    """
    return pack(materialize(tokenize(docs, vocabulary, pattern, end, capacity, doc_id, text, added=added), "pieces"), capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, tokens): the token ids of each sequence, from placed pieces with ``ids``; a group is at most
    one sequence long."""
    parts = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("_parts"))
    return parts.select("sequence_id", F.flatten("_parts.ids").alias("tokens"))
