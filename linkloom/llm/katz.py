"""Katz backoff: Good-Turing discounted bigram counts with exactly normalised backoff weights.

Documents are turned into blocks of a few million tokens, a row each: a dictionary of hashed words and the tokens as
places in it. All further work moves sorted, packed arrays: a block sends its distinct words, then its distinct
bigrams, with their training counts to the buckets of two tables; a bucket adds the counts of all blocks up, keeps its
part of the table, and answers every block with the totals of what that asked for. Blocks then score
their tokens: by the discounted bigram if that was seen, else by the backoff weight of the history times the
discounted unigram.

Bigrams are dealt out by history, so that a bucket has what a backoff weight is made of; a history that would
fill more than a bucket is dealt by its next words as well, and the parts add up. Nothing is collected but
numbers of words with count 1 to 6.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.llm import arrays
from linkloom.session import materialize, new_folder

BLOCK_TOKENS = 1_000_000
# Words or bigrams that blocks send to a bucket, about.
BUCKET_ENTRIES = 1_000_000
# Counts above this are not discounted.
LARGE = 5
# The token after the last word of a document: no word has this hash but by a chance of 1 in 2**64.
_END = np.uint64(0xE7D0F7E4705A11ED)


def pack(values: np.ndarray) -> bytes:
    """64-bit numbers as compressed planes of bytes."""
    planes = np.ascontiguousarray(values.astype(np.int64)).view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(data)
    return np.frombuffer(raw, np.uint8).reshape(8, -1).T.copy().view(np.int64).ravel()


def _steps(ordered: np.ndarray) -> np.ndarray:
    return np.diff(ordered.astype(np.int64), prepend=0)


def _lower_tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts, each closed by the end token, and the number of tokens of each text."""
    data, offsets = arrays.text_bytes(column)
    data = arrays.lower_ascii(data)
    starts, ends, first = arrays.words(data, offsets)
    return np.insert(arrays.word_hashes(data, starts, ends), first[1:], _END), np.diff(first) + 1


def make_blocks(docs: DataFrame, doc_id: str, text: str, held_out: str, block_tokens: int) -> DataFrame:
    """(block, doc_ids, held, sizes, words, tokens, n_words, n_tokens): ``tokens`` are places in the sorted ``words``."""
    kind = dict(zip(docs.columns, docs.schema.fields, strict=True))[doc_id].dataType

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        number = 0
        base = TaskContext.get().partitionId() << 32
        for part in arrays.slices(batches, text):
            found, sizes = _lower_tokens(part.column(text))
            held.append((part.column(doc_id), part.column(held_out), found, sizes))
            if sum(len(h[2]) for h in held) >= block_tokens:
                yield close(base + number, held)
                held, number = [], number + 1
        if held:
            yield close(base + number, held)

    def close(block: int, held: list[tuple]) -> pa.RecordBatch:
        ids, out, found, sizes = zip(*held, strict=True)
        words, tokens = np.unique(np.concatenate(found), return_inverse=True)
        count = np.concatenate(sizes)
        lists = [pa.ListArray.from_arrays(pa.array([0, len(count)], pa.int32()), pa.concat_arrays(c)) for c in (ids, out)]
        return pa.RecordBatch.from_arrays(
            [pa.array([block]), *lists, pa.array([pack(count)]), pa.array([pack(_steps(words.view(np.int64)))]), pa.array([pack(tokens)]),
             pa.array([len(words)]), pa.array([len(tokens)])],
            ["block", "doc_ids", "held", "sizes", "words", "tokens", "n_words", "n_tokens"],
        )

    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("doc_ids", T.ArrayType(kind)), T.StructField("held", T.ArrayType(T.BooleanType())),
        *[T.StructField(c, T.BinaryType()) for c in ("sizes", "words", "tokens")], *[T.StructField(c, T.LongType()) for c in ("n_words", "n_tokens")],
    ])
    return docs.select(doc_id, text, held_out).mapInArrow(run, schema)


@dataclass(frozen=True)
class _Block:
    """A block as arrays; ``train`` tells the tokens to learn from."""

    words: np.ndarray
    tokens: np.ndarray
    sizes: np.ndarray
    train: np.ndarray

    @classmethod
    def read(cls, batch: pa.RecordBatch, i: int) -> _Block:
        sizes = unpack(batch.column("sizes")[i].as_py())
        held = batch.column("held")[i].values.to_numpy(zero_copy_only=False).astype(bool)
        words = np.cumsum(unpack(batch.column("words")[i].as_py())).view(np.uint64)
        return cls(words, unpack(batch.column("tokens")[i].as_py()), sizes, np.repeat(~held, sizes))


def _ask_words(blocks: DataFrame, buckets: int) -> DataFrame:
    """(bucket, block, words, counts): the distinct words of each block with their training counts."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own = _Block.read(batch, i)
                counts = np.bincount(own.tokens[own.train], minlength=len(own.words))
                to = (own.words % np.uint64(buckets)).astype(np.int64)
                rows = [(int(b), pack(_steps(own.words[at].view(np.int64))), pack(counts[at])) for b in np.unique(to) for at in [np.flatnonzero(to == b)]]
                bucket, words, n = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket), pa.array([batch.column("block")[i].as_py()] * len(rows)), pa.array(words), pa.array(n)], ["bucket", "block", "words", "counts"]
                )

    schema = "bucket long, block long, words binary, counts binary"
    return blocks.select("block", "held", "sizes", "words", "tokens").mapInArrow(run, schema)


_TALLY = [f"n_{c}" for c in range(1, LARGE + 2)] + ["distinct", "total"]


def _tally(totals: np.ndarray) -> list[int]:
    seen = totals[totals > 0]
    return [*np.bincount(np.minimum(seen, LARGE + 2), minlength=LARGE + 3)[1 : LARGE + 2].tolist(), len(seen), int(seen.sum())]


def _table_rows(columns: dict[str, list], names: list[str], tallies: list[list[int]]) -> pa.Table:
    kinds = {name: pa.int64() if name in ("bucket", "block") else pa.binary() for name in names}
    data = {name: pa.array(columns[name], kinds[name]) for name in names}
    return pa.table(data | {name: pa.array([t[k] for t in tallies], pa.int64()) for k, name in enumerate(_TALLY)})


def _count_words(asked: DataFrame, buckets: int) -> DataFrame:
    """The unigram table, in rows without ``block`` (words, counts), and the answers to blocks (words: the numbers of the words
    asked for, or -1; counts). A word's number tells its bucket; 0 is left free."""
    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        words = [np.cumsum(unpack(w.as_py())) for w in table.column("words")]
        counts = np.concatenate([unpack(n.as_py()) for n in table.column("counts")])
        distinct, place = np.unique(np.concatenate(words), return_inverse=True)
        totals = np.bincount(place, weights=counts).astype(np.int64)
        seen = totals > 0
        number = np.where(seen, (np.cumsum(seen) - 1) * buckets + bucket + 1, -1)
        out: dict[str, list] = {"bucket": [bucket], "block": [None], "words": [pack(_steps(distinct[seen]))], "counts": [pack(totals[seen])]}
        at = 0
        for block, own in zip(table.column("block").to_pylist(), words, strict=True):
            here = place[at : at + len(own)]
            at += len(own)
            for name, value in (("bucket", bucket), ("block", block), ("words", pack(number[here])), ("counts", pack(totals[here]))):
                out[name].append(value)
        return _table_rows(out, ["bucket", "block", "words", "counts"], [_tally(totals), *[[0] * len(_TALLY)] * (len(out["block"]) - 1)])

    schema = "bucket long, block long, words binary, counts binary, " + ", ".join(f"{c} long" for c in _TALLY)
    return asked.groupBy("bucket").applyInArrow(run, schema)


@dataclass(frozen=True)
class Discounts:
    """``shares[c]``: what is left of a count ``c`` up to ``LARGE`` (1 above); totals of the table."""

    shares: tuple[float, ...]
    distinct: int
    total: int

    def of(self, counts: np.ndarray) -> np.ndarray:
        """Discounted counts."""
        return counts * np.array([*self.shares, 1.0])[np.minimum(counts, LARGE + 1)]

    @property
    def lost(self) -> np.ndarray:
        """What a count from 1 to ``LARGE`` loses."""
        return np.array([c * (1 - self.shares[c]) for c in range(1, LARGE + 1)])


def good_turing(tally: list[int]) -> Discounts:
    """Katz's discounts from the numbers of entries with count 1 to ``LARGE`` + 1, for counts up to the largest bound that
    gives shares between 0 and 1. If none does (few or odd data), the same amount is taken off each small count."""
    n = [0, *tally[: LARGE + 1]]
    for top in range(LARGE, 0, -1):
        if not all(n[1 : top + 2]):
            continue
        rest = (top + 1) * n[top + 1] / n[1]
        shares = [((c + 1) * n[c + 1] / (c * n[c]) - rest) / (1 - rest) for c in range(1, top + 1)] if rest < 1 else [0.0]
        if all(0 < share < 1 for share in shares):
            return Discounts((1.0, *shares, *[1.0] * (LARGE - top)), tally[-2], tally[-1])
    off = min(0.9, max(0.1, n[1] / max(1, n[1] + 2 * n[2])))
    return Discounts((1.0, *[(c - off) / c for c in range(1, LARGE + 1)]), tally[-2], tally[-1])


def tallied(table: DataFrame) -> list[int]:
    """The tally of a whole table: the numbers of entries with count 1 to ``LARGE`` + 1, of all, and their sum."""
    return [v or 0 for v in table.agg(*[F.sum(c).alias(c) for c in _TALLY]).first()]


def unigram(counts: np.ndarray, words: Discounts) -> np.ndarray:
    """The probability of a token by its count; all unknown words are one event, which gets what discounting left."""
    return np.where(counts > 0, words.of(counts) / words.whole, words.unknown)


@dataclass(frozen=True)
class Words(Discounts):
    """Discounts of unigrams: ``whole`` is what counts are divided by, ``unknown`` the probability of an unknown word."""

    whole: float = 1.0
    unknown: float = 1.0


def word_discounts(tally: list[int]) -> Words:
    """If no count is discounted, a pseudo count is left for unknown words."""
    found = good_turing(tally)
    lost = float(np.dot(found.lost, tally[:LARGE]))
    whole = found.total + (lost <= 0)
    return Words(found.shares, found.distinct, found.total, whole, (lost or 1.0) / whole)


@dataclass(frozen=True)
class _Pairs:
    """The distinct bigrams of a block of known words, ordered by bucket, history and next word, and for each bucket the
    histories that the block asks about. ``place``: for each token, its bigram, or -1."""

    place: np.ndarray
    history: np.ndarray
    word: np.ndarray
    train: np.ndarray
    word_count: np.ndarray
    bucket: np.ndarray
    asked: np.ndarray
    asked_bucket: np.ndarray
    before: np.ndarray


def _pairs(own: _Block, number: np.ndarray, count: np.ndarray, starts: int, total: int, buckets: int) -> _Pairs:
    """``number`` and ``count``: of the block's words. ``starts``: training documents. The history of a first token is number 0."""
    first = np.cumsum(own.sizes) - own.sizes
    before = np.empty_like(own.tokens)
    before[1:] = own.tokens[:-1]
    before[first] = len(own.words)
    number, count = np.append(number, 0), np.append(count, starts)
    at = np.flatnonzero((count[before] > 0) & (count[own.tokens] > 0))
    # A history with more than a bucket's share of the tokens has several parts.
    parts = 1 + count * buckets // max(1, total)
    spread, by_word = arrays.mix(number), arrays.mix(arrays.mix(number))

    def dealt(words: np.ndarray, part: np.ndarray) -> np.ndarray:
        return ((by_word[words] + part.astype(np.uint64) * spread[words]) % np.uint64(buckets)).astype(np.int64)

    h, w = before[at], own.tokens[at]
    many = parts[h] > 1
    part = np.zeros(len(at), np.int64)
    part[many] = (spread[w[many]] % parts[h[many]].astype(np.uint64)).astype(np.int64)
    names, to = np.arange(buckets), dealt(h, part)
    bits = len(number).bit_length()
    if buckets.bit_length() + 2 * bits > 63:
        names, to = np.unique(to, return_inverse=True)
    # In the order of bucket, history and next word, by their numbers.
    rank = np.empty(len(number), np.int64)
    by_number = np.argsort(number, kind="stable")
    rank[by_number] = np.arange(len(number))
    distinct, place = np.unique((to << (2 * bits)) | (rank[h] << bits) | rank[w], return_inverse=True)
    train = np.bincount(place[own.train[at]], minlength=len(distinct))
    bucket = names[distinct >> (2 * bits)]
    history, word = by_number[(distinct >> bits) & ((1 << bits) - 1)], by_number[distinct & ((1 << bits) - 1)]
    full = np.full(len(own.tokens), -1)
    full[at] = place
    used = np.flatnonzero(np.bincount(before, minlength=len(number)) * count)
    each = np.repeat(used, parts[used])
    part = np.arange(len(each)) - np.repeat(np.cumsum(parts[used]) - parts[used], parts[used])
    asked, asked_bucket = number[each], dealt(each, part)
    # Two parts of a history may fall into one bucket, which then answers for both at once.
    order = np.lexsort((asked, asked_bucket))
    asked, asked_bucket = asked[order], asked_bucket[order]
    new = np.ones(len(asked), bool)
    new[1:] = (asked[1:] != asked[:-1]) | (asked_bucket[1:] != asked_bucket[:-1])
    return _Pairs(full, number[history], number[word], train, count[word], bucket, asked[new], asked_bucket[new], before)


def _answered(lists: pa.Array, words: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers and counts of the words of a block from the answers of the unigram table."""
    number, count = np.full(len(words), -1), np.zeros(len(words), np.int64)
    to = (words % np.uint64(buckets)).astype(np.int64)
    for answer in lists.as_py():
        at = to == answer["bucket"]
        number[at], count[at] = unpack(answer["words"]), unpack(answer["counts"])
    return number, count


def _ask_pairs(joined: DataFrame, word_buckets: int, starts: int, words: Words, buckets: int) -> DataFrame:
    """(bucket, block, asked, sizes, next, train, word_counts): the histories a block asks about in each bucket, and behind
    each, its distinct next words with their training counts in the block and their counts as words."""
    names = ["bucket", "block", "asked", "sizes", "next", "train", "word_counts"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own = _Block.read(batch, i)
                found = _pairs(own, *_answered(batch.column("unigrams")[i], own.words, word_buckets), starts, words.total, buckets)
                rows = []
                for b in np.unique(found.asked_bucket).tolist():
                    a = slice(*np.searchsorted(found.asked_bucket, [b, b + 1]))
                    p = slice(*np.searchsorted(found.bucket, [b, b + 1]))
                    at = np.searchsorted(found.asked[a], found.history[p])
                    rows.append((
                        b, batch.column("block")[i].as_py(), pack(_steps(found.asked[a])), pack(np.bincount(at, minlength=a.stop - a.start)),
                        pack(_steps(found.word[p])), pack(found.train[p]), pack(found.word_count[p]),
                    ))
                if rows:
                    kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 5]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return joined.select("block", "held", "sizes", "words", "tokens", "unigrams").mapInArrow(
        run, "bucket long, block long, asked binary, sizes binary, next binary, train binary, word_counts binary"
    )


_OUT = ["bucket", "block", "histories", "next", "counts", "few", "mass"]


def _count_pairs(asked: DataFrame, words: Words) -> DataFrame:
    """The bigram table, in rows without ``block`` (histories, next, counts), and the answers to blocks: ``counts`` of the
    bigrams asked for; and for each history ``few``, the numbers of its next words with count 1 to ``LARGE``,
    and ``mass``, the unigram probability of all its next words, over this bucket."""
    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        read = lambda name: [unpack(v.as_py()) for v in table.column(name)]
        histories, sizes, following = [np.cumsum(v) for v in read("asked")], read("sizes"), [np.cumsum(v) for v in read("next")]
        whole = np.concatenate([np.repeat(h, n) for h, n in zip(histories, sizes, strict=True)])
        names, owner = np.unique(whole, return_inverse=True)
        next_names, next_place = np.unique(np.concatenate(following), return_inverse=True)
        key, first, place = np.unique((owner << 32) | next_place, return_index=True, return_inverse=True)
        totals = np.bincount(place, weights=np.concatenate(read("train")), minlength=len(key)).astype(np.int64)
        seen = totals > 0
        key_owner = (key >> 32)[seen]
        chance = unigram(np.concatenate(read("word_counts"))[first][seen], words)
        mass = np.bincount(key_owner, weights=chance, minlength=len(names))
        few = np.stack([np.bincount(key_owner[totals[seen] == c], minlength=len(names)) for c in range(1, LARGE + 1)], axis=1)
        out: dict[str, list] = {name: [] for name in _OUT}

        def add(*values) -> None:
            for name, value in zip(_OUT, values, strict=True):
                out[name].append(value)

        add(bucket, None, pack(_steps(names[key_owner])), pack(_steps(next_names[(key & 0xFFFFFFFF)[seen]])), pack(totals[seen]), None, None)
        at = 0
        for block, own, n in zip(table.column("block").to_pylist(), histories, sizes, strict=True):
            stop = at + int(n.sum())
            where = np.minimum(np.searchsorted(names, own), max(0, len(names) - 1))
            there = names[where] == own if len(names) else np.zeros(len(own), bool)
            own_few = few[where] * there[:, None] if len(names) else np.zeros((len(own), LARGE), np.int64)
            own_mass = np.where(there, mass[where], 0.0) if len(names) else np.zeros(len(own))
            add(bucket, block, None, None, pack(totals[place[at:stop]]), pack(own_few.T.ravel()), pack(own_mass.view(np.int64)))
            at = stop
        return _table_rows(out, _OUT, [_tally(totals), *[[0] * len(_TALLY)] * (len(out["block"]) - 1)])

    schema = "bucket long, block long, histories binary, next binary, counts binary, few binary, mass binary, "
    return asked.groupBy("bucket").applyInArrow(run, schema + ", ".join(f"{c} long" for c in _TALLY))


def chances(counts: np.ndarray, history_counts: np.ndarray, lost: np.ndarray, mass: np.ndarray, lower: np.ndarray, pairs: Discounts) -> np.ndarray:
    """P(word | history) for bigrams with these counts; ``lost`` (what its counts lose) and ``mass`` (the unigram probability of
    what was seen after it) are of the history, ``lower`` is the word's unigram probability. The weights make the probabilities of all words, unknown ones included, add up to 1 exactly: unseen
    words share what the discounts took off the history's counts (a pseudo count, if that is nothing)."""
    pseudo = np.where((history_counts > 0) & (lost <= 0), 1.0, 0.0)
    whole = np.maximum(history_counts + pseudo, 1)
    weight = np.where(history_counts > 0, (lost + pseudo) / whole / np.maximum(1 - mass, 1e-300), 1.0)
    return np.where(counts > 0, pairs.of(counts) / whole, weight * lower)


def _score(joined: DataFrame, doc_kind: T.DataType, word_buckets: int, starts: int, words: Words, pairs: Discounts, buckets: int) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, base_score, score) for each document of each block."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own = _Block.read(batch, i)
                number, count = _answered(batch.column("unigrams")[i], own.words, word_buckets)
                found = _pairs(own, number, count, starts, words.total, buckets)
                totals = np.zeros(len(found.history) + 1, np.int64)
                names, place = np.unique(found.asked, return_inverse=True)
                few, mass = np.zeros((len(names), LARGE)), np.zeros(len(names))
                for answer in batch.column("bigrams")[i].as_py() or []:
                    totals[slice(*np.searchsorted(found.bucket, [answer["bucket"], answer["bucket"] + 1]))] = unpack(answer["counts"])
                    at = place[slice(*np.searchsorted(found.asked_bucket, [answer["bucket"], answer["bucket"] + 1]))]
                    few[at] += unpack(answer["few"]).reshape(LARGE, -1).T
                    mass[at] += unpack(answer["mass"]).view(np.float64)
                # What belongs to a history, by place in the block's words; the last is the start of a document.
                numbers, counts = np.append(number, 0), np.append(count, starts)
                by_word = np.minimum(np.searchsorted(names, numbers), max(0, len(names) - 1))
                hit = (names[by_word] == numbers) & (counts > 0) if len(names) else np.zeros(len(numbers), bool)
                few = few[by_word] * hit[:, None] if len(names) else np.zeros((len(numbers), LARGE))
                mass = np.where(hit, mass[by_word], 0.0) if len(names) else np.zeros(len(numbers))
                lower = unigram(count, words)
                p = chances(totals[found.place], counts[found.before], (few @ pairs.lost)[found.before], mass[found.before], lower[own.tokens], pairs)
                first = np.cumsum(own.sizes) - own.sizes
                base = np.log10((count + 0.5) / (words.total + 0.5 * (words.distinct + 1)))[own.tokens]
                by_doc = lambda v: np.add.reduceat(v, first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_ids")[i].values, batch.column("held")[i].values, pa.array(own.sizes), pa.array(by_doc((count[own.tokens] > 0).astype(np.int64))),
                     pa.array(by_doc(base)), pa.array(by_doc(np.log10(p)))],
                    ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
                )

    schema = T.StructType([
        T.StructField("doc_id", doc_kind), T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
        T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType()),
    ])
    return joined.mapInArrow(run, schema)


def _bucketed(blocks: DataFrame) -> DataFrame:
    """The blocks as a table bucketed by block, in the shared folder: joins on block then only move what joins them."""
    spark = blocks.sparkSession
    path = new_folder(spark, "blocks")
    name = path.rpartition("/")[2].replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks.write.format("parquet").option("path", path).bucketBy(buckets, "block").saveAsTable(name)
    return spark.table(name)


def katz_scores(
    docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text", block_tokens: int = BLOCK_TOKENS, bucket_entries: int = BUCKET_ENTRIES,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row, learned from the rows that are not ``held_out``.

    Words are what ASCII white space separates, A-Z in lower case; each text ends with one more token. ``score`` is the log10
    probability of the text by the bigram model, ``base_score`` that of additive unigrams. A null text is empty: its
    only token is the end. A null ``held_out`` is false. Rows are scored one by one, repeated ones and those of one id
    too; other columns play no part; an empty table gives no rows. With no row to learn from, every token is unknown.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    blocks = _bucketed(make_blocks(rows, "doc_id", "text", "held_out", block_tokens))
    sums = blocks.agg(F.sum("n_words"), F.sum("n_tokens"), F.sum(F.size(F.filter("held", lambda h: ~h)))).first()
    n_words, n_tokens, starts = (int(v or 0) for v in sums)
    word_buckets = max(1, -(-n_words // bucket_entries))
    pair_buckets = max(1, -(-n_tokens // (2 * bucket_entries)))
    unigrams = materialize(_count_words(_ask_words(blocks, word_buckets), word_buckets), "unigrams")
    words = word_discounts(tallied(unigrams.filter("block IS NULL")))
    answers = unigrams.filter("block IS NOT NULL").groupBy("block").agg(F.collect_list(F.struct("bucket", "words", "counts")).alias("unigrams"))
    joined = blocks.join(answers, "block")
    bigrams = materialize(_count_pairs(_ask_pairs(joined, word_buckets, starts, words, pair_buckets), words), "bigrams")
    pairs = good_turing(tallied(bigrams.filter("block IS NULL")))
    more = bigrams.filter("block IS NOT NULL").groupBy("block").agg(F.collect_list(F.struct("bucket", "counts", "few", "mass")).alias("bigrams"))
    scored = _score(joined.join(more, "block", "left"), rows.schema["doc_id"].dataType, word_buckets, starts, words, pairs, pair_buckets)
    return scored.select(
        F.col("doc_id").alias(doc_id), "held_out", "n_tokens", "n_known", F.lit(words.total if n_tokens else 0).cast("long").alias("train_tokens"), "base_score", "score",
    )
