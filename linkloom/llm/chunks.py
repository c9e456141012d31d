"""Byte-level BPE encoding of texts of any length in overlapping chunks, and decoding.

A short text is encoded in its row. A longer one is cut into overlapping chunks that are pre-tokenised in parallel.
Where the chunks overlap, the first border that both have is where they resynchronise: the pattern looks at no
earlier text, so from there on they agree. The texts between those borders are encoded in parallel. Borders
after white space are passed over, as what follows decides how white space is split. If an overlap has no common
border, the chunks around it are joined and pre-tokenised again, until all neighbours meet. Decoding concatenates the
bytes of the tokens.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.llm import arrays, bpe_files
from linkloom.session import materialize

CHUNK = 16_384
OVERLAP = 512
# A match ends where it ends whatever comes more than so many characters later.
_LOOK = 4
# Rounds of joining chunks that do not meet. What is left of a text after so many is one piece.
ROUNDS = 8


def spans(length: int, chunk: int, overlap: int) -> list[tuple[int, int]]:
    """Start and end of each chunk; each but the last reaches ``overlap`` characters into the next."""
    count = max(1, -(-(length - overlap) // chunk))
    return [(i * chunk, min((i + 1) * chunk + overlap, length) if i < count - 1 else length) for i in range(count)]


def _cut(long: DataFrame, carry: list[str], text: str, chunk: int, overlap: int) -> DataFrame:
    """(…carry, _row, _no, _count, _start, _text): the chunks of each text."""
    names = [*carry, "_row", "_no", "_count", "_start", "_text"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrays.slices(batches, text):
            owner, rows = [], []
            for i, value in enumerate(part.column(text).to_pylist()):
                cuts = spans(len(value), chunk, overlap)
                owner += [i] * len(cuts)
                rows += [(k, len(cuts), a, value[a:b]) for k, (a, b) in enumerate(cuts)]
            no, count, start, piece = zip(*rows, strict=True)
            held = [part.column(c).take(pa.array(owner)) for c in [*carry, "_row"]]
            yield pa.RecordBatch.from_arrays([*held, pa.array(no, pa.int32()), pa.array(count, pa.int32()), pa.array(start, pa.int64()), pa.array(piece)], names)

    types = dict(zip(long.columns, long.schema.fields, strict=True))
    schema = T.StructType([
        *[types[c] for c in carry], T.StructField("_row", T.LongType()), T.StructField("_no", T.IntegerType()), T.StructField("_count", T.IntegerType()),
        T.StructField("_start", T.LongType()), T.StructField("_text", T.StringType()),
    ])
    return long.withColumn("_row", F.monotonically_increasing_id()).select(*carry, "_row", text).mapInArrow(run, schema)


def _borders(chunks: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """(_row, _no, _head, _tail): ends of pre-tokens in the overlap with the chunk before and after, but for those after white space.

    ``_last`` is where the last of the chunks that ``_text`` was joined from starts.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = regex.compile(pattern)
        for part in arrays.slices(batches, "_text"):
            heads, tails = [], []
            for start, last, value in zip(*[part.column(c).to_pylist() for c in ("_start", "_last", "_text")], strict=True):
                ends = [start + m.end() for m in compiled.finditer(value) if not value[m.end() - 1].isspace()]
                heads.append([e for e in ends if e <= start + overlap - _LOOK])
                tails.append([e for e in ends if last + chunk <= e <= last + chunk + overlap - _LOOK])
            yield pa.RecordBatch.from_arrays(
                [part.column("_row"), part.column("_no"), pa.array(heads, pa.list_(pa.int64())), pa.array(tails, pa.list_(pa.int64()))],
                ["_row", "_no", "_head", "_tail"],
            )

    return chunks.select("_row", "_no", "_start", "_last", "_text").mapInArrow(run, "_row long, _no int, _head array<long>, _tail array<long>")


def _meetings(borders: DataFrame) -> DataFrame:
    """(_row, _no, _sync, _failed): the first border that a chunk has in common with the one before; the first chunk starts at 0."""
    common = F.array_min(F.array_intersect("_head", F.lag("_tail").over(Window.partitionBy("_row").orderBy("_no"))))
    found = borders.select("_row", "_no", F.when(F.col("_no") == 0, F.lit(0).cast("long")).otherwise(common).alias("_sync"))
    return found.withColumn("_failed", F.col("_sync").isNull())


def _synchronised(chunks: DataFrame, pattern: str, chunk: int, overlap: int, rounds: int) -> DataFrame:
    """(_row, _no, _sync): where each chunk resynchronises; null for chunks that belong to the one before.

    If all neighbours meet, all borders are right: the first chunk's are, and right ones are handed on from chunk to chunk. A chunk
    that does not meet the one before is joined to it, and their text is pre-tokenised as one. This may change the
    borders at its end, so the texts concerned (only those) are looked at again.
    """
    order = Window.partitionBy("_row").orderBy("_no")
    state = materialize(_meetings(_borders(chunks.withColumn("_last", F.col("_start")), pattern, chunk, overlap)), "meetings")
    for _ in range(rounds):
        broken = state.filter("_failed").select("_row").distinct()
        if broken.isEmpty():
            break
        runs = state.join(broken, "_row", "left_semi").select("_row", "_no", F.count("_sync").over(order).alias("_run"))
        part = F.struct("_no", "_start", "_text")
        joined = chunks.join(runs, ["_row", "_no"]).groupBy("_row", "_run").agg(F.array_sort(F.collect_list(part)).alias("_parts"))
        before = F.transform(F.slice("_parts", 1, F.size("_parts") - 1), lambda p: F.substring(p._text, 1, chunk))
        last = F.element_at("_parts", -1)
        whole = joined.select(
            "_row", F.col("_parts")[0]._no.alias("_no"), F.col("_parts")[0]._start.alias("_start"), last._start.alias("_last"),
            F.array_join(F.concat(before, F.array(last._text)), "").alias("_text"),
        )
        met = runs.select("_row", "_no").join(_meetings(_borders(whole, pattern, chunk, overlap)), ["_row", "_no"], "left")
        held = state.join(broken, "_row", "left_anti")
        state = materialize(held.unionByName(met.withColumn("_failed", F.coalesce("_failed", F.lit(False)))), "meetings")
    sound = ~F.max("_failed").over(order)
    return state.select("_row", "_no", F.when(sound, F.col("_sync")).alias("_sync"))


def _pieces(chunks: DataFrame, synchronised: DataFrame) -> DataFrame:
    """(_row, _run, _from, _until, _parts): chunks from one synchronised border to the next, usually one."""
    order = Window.partitionBy("_row").orderBy("_no")
    rows = chunks.join(synchronised.withColumn("_run", F.count("_sync").over(order)), ["_row", "_no"])
    runs = rows.groupBy("_row", "_run").agg(
        F.max("_sync").alias("_from"), F.array_sort(F.collect_list(F.struct("_no", "_start", "_text"))).alias("_parts")
    )
    following = F.lead("_from").over(Window.partitionBy("_row").orderBy("_run"))
    starts = runs.select("_row", "_run", "_from").withColumn("_until", following).drop("_from")
    return runs.join(starts, ["_row", "_run"])


def _encode_pieces(pieces: DataFrame, vocabulary: str, pattern: str, chunk: int) -> DataFrame:
    """(_row, _run, _ids): the token ids of each piece."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = bpe_files.encoding(vocabulary, pattern)
        for batch in batches:
            for i in range(batch.num_rows):
                parts = batch.column("_parts")[i].as_py()
                value = "".join([*[p["_text"][:chunk] for p in parts[:-1]], parts[-1]["_text"]])
                base, until = parts[0]["_start"], batch.column("_until")[i].as_py()
                piece = value[batch.column("_from")[i].as_py() - base : None if until is None else until - base]
                ids = pa.array([np.array(bpe_files.encode(own, piece), np.int32)], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("_row").slice(i, 1), batch.column("_run").slice(i, 1), ids], ["_row", "_run", "_ids"])

    return pieces.select("_row", "_run", "_from", "_until", "_parts").mapInArrow(run, "_row long, _run long, _ids array<int>")


def encode(
    docs: DataFrame, vocabulary: str, pattern: str, text: str = "text", carry: list[str] | None = None,
    chunk: int = CHUNK, overlap: int = OVERLAP, rounds: int = ROUNDS, digest: bool = False,
) -> DataFrame:
    """The columns ``carry`` of ``docs`` (all but the text, unless given) and ``ids``, the tokens of the whole text; with
    ``digest``, the columns of ``digests`` instead, which short texts get where they are encoded.

    ``vocabulary`` is a rank file that tasks can open; names of special tokens are ordinary text. A null text is
    empty and has no tokens. Rows are encoded one by one: repeated rows, ties and null in other columns make no
    difference, a column named ``ids`` is replaced, and an empty table gives no rows.
    """
    keep = [c for c in ([c for c in docs.columns if c != text] if carry is None else carry) if c != "ids"]
    types = dict(zip(docs.columns, docs.schema.fields, strict=True))
    if digest:
        keep = [c for c in keep if c not in _DIGESTS.names]
    made = _DIGESTS.fields if digest else [T.StructField("ids", T.ArrayType(T.IntegerType()))]
    schema = T.StructType([*[types[c] for c in keep], *made])
    # More characters than fit one chunk; a null length is short.
    is_long = F.coalesce(F.length(text) > chunk + overlap, F.lit(False))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = bpe_files.encoding(vocabulary, pattern)
        table, decimal = _spellings(vocabulary) if digest else ([], [])
        for part in arrays.slices(batches, text):
            ids = [np.array(bpe_files.encode(own, value), np.int32) for value in part.column(text).to_pylist()]
            columns = _digest(ids, table, decimal) if digest else [pa.array(ids, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], *columns], schema.names)

    columns = list(dict.fromkeys([*keep, text]))
    short = docs.filter(~is_long).select(*columns).mapInArrow(run, schema)
    chunks = materialize(_cut(docs.filter(is_long).select(*columns), keep, text, chunk, overlap), "chunks")
    bare = chunks.drop(*keep)
    pieces = _encode_pieces(_pieces(bare, _synchronised(bare, pattern, chunk, overlap, rounds)), vocabulary, pattern, chunk)
    whole = pieces.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("_run", "_ids"))).alias("_all"))
    held = chunks.filter("_no = 0").select(*keep, "_row")
    joined = held.join(whole, "_row").select(*keep, F.flatten("_all._ids").alias("ids"))
    return short.unionByName(digests(joined, vocabulary) if digest else joined)


def decode(ids: np.ndarray, table: list[bytes]) -> bytes:
    """The bytes of a text's tokens, end to end; ``table`` from ``bpe_files.tokens``."""
    return b"".join([table[i] for i in ids.tolist()])


_DIGESTS = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])
# Ids that are spelled out at a time.
_SPELLED = 1 << 16


def _spellings(vocabulary: str) -> tuple[list[bytes], list[bytes]]:
    """The bytes of each token, and its decimal id led by a comma."""
    table = bpe_files.tokens(vocabulary)
    return table, [b",%d" % i for i in range(len(table))]


def _digest(rows: list[np.ndarray], table: list[bytes], decimal: list[bytes]) -> list[pa.Array]:
    """The columns of ``digests`` for the ids of each row."""
    names, texts = [], []
    for row in rows:
        name, text = hashlib.sha256(), hashlib.sha256()
        for start in range(0, len(row), _SPELLED):
            block = row[start : start + _SPELLED]
            spelled = b"".join([decimal[i] for i in block.tolist()])
            name.update(spelled if start else spelled[1:])
            text.update(decode(block, table))
        names.append(name.hexdigest())
        texts.append(text.hexdigest())
    return [pa.array([len(row) for row in rows], pa.int64()), pa.array(names, pa.string()), pa.array(texts, pa.string())]


def digests(encoded: DataFrame, vocabulary: str, ids: str = "ids") -> DataFrame:
    """``encoded`` without its ids, with ``n_tokens``, ``ids_sha256`` (decimal ids joined by commas) and
    ``decoded_sha256`` (the bytes that the ids decode to)."""
    keep = [c for c in encoded.columns if c not in (ids, *_DIGESTS.names)]
    types = dict(zip(encoded.columns, encoded.schema.fields, strict=True))
    schema = T.StructType([*[types[c] for c in keep], *_DIGESTS.fields])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, decimal = _spellings(vocabulary)
        for batch in batches:
            lists = batch.column(ids)
            flat, borders = lists.flatten().to_numpy(), np.cumsum([0, *pc.list_value_length(lists).to_pylist()])
            rows = [flat[a:b] for a, b in zip(borders[:-1], borders[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *_digest(rows, table, decimal)], schema.names)

    return encoded.select(*keep, ids).mapInArrow(run, schema)
