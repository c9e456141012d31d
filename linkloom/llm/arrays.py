"""Texts of an Arrow batch as flat numpy arrays: bytes, words, and hashes of spans."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# A slice of a batch has about so many bytes of text, or one longer text: the arrays made of it stay small.
SLICE_BYTES = 1 << 20

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)


def slices(batches: Iterable[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices of about ``limit`` bytes of ``text``; a longer text is alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in one array (null: empty), and where each begins, with the end."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case; all other bytes, those of longer characters included, stay."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of True that end at the borders of texts: starts, ends, and the number before each text."""
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    full = offsets[1:] > offsets[:-1]
    firsts, lasts = offsets[:-1][full], offsets[1:][full] - 1
    begins[firsts] = inside[firsts]
    stops[lasts] = inside[lasts]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+``: starts, ends, and the number of words before each text."""
    return runs((data != 32) & ((data < 9) | (data > 13)), offsets)


def mix(keys: np.ndarray) -> np.ndarray:
    """Spread 64-bit keys evenly (the finaliser of splitmix64)."""
    keys = keys.astype(np.uint64) + _GOLDEN
    keys = (keys ^ (keys >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    keys = (keys ^ (keys >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return keys ^ (keys >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base`` modulo 2**64."""
    factors = np.full(n, base, np.uint64)
    factors[:1] = 1
    return np.cumprod(factors)


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A rolling 64-bit hash of ``values[start:end]`` for each span, all from one prefix sum.

    Meant for spans of a few hashes: modulo a power of two, long spans of two values can be made to agree."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(_BASE, len(values)), out=sums[1:])
    inverses = _powers(_INVERSE, len(values) + 1)
    lengths = (ends - starts).astype(np.uint64)
    return mix((sums[ends] - sums[starts]) * inverses[starts] + lengths * _GOLDEN)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, of any length: blocks of eight bytes, mixed with their place in the span."""
    lengths = ends - starts
    blocks = (lengths + 7) // 8
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    out = mix(lengths)
    for k in range(int(blocks.max(initial=0))):
        # Spans that reach this block; most end within the first two, and those longer are taken apart below.
        at = np.flatnonzero(blocks > k)
        if k >= 4:
            _long_hashes(words, starts[at], lengths[at], out, at)
            break
        rest = np.minimum(lengths[at] - 8 * k, 8).astype(np.uint64)
        block = words[starts[at] + 8 * k] & (_ALL >> (np.uint64(64) - rest * np.uint64(8)))
        out[at] = mix(out[at] ^ mix(block ^ mix(np.full(1, k + 1))))
    return out


def _long_hashes(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray, out: np.ndarray, at: np.ndarray) -> None:
    """Adds the blocks from the fifth on to the hashes of long spans; some spans at a time, as they may be long."""
    counts = (lengths + 7) // 8 - 4
    ends = np.cumsum(counts)
    a = 0
    while a < len(at):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + (1 << 18), side="right")))
        if counts[a] > 1 << 18:
            total = np.zeros(1, np.uint64)
            for first in range(0, int(counts[a]), 1 << 18):
                place = np.arange(first, min(first + (1 << 18), int(counts[a])))
                total += _blocks(words, np.full(len(place), starts[a]), np.full(len(place), lengths[a]), place + 4).sum(dtype=np.uint64)
            b = a + 1
        else:
            own = np.repeat(np.arange(a, b), counts[a:b])
            begins = np.cumsum(counts[a:b]) - counts[a:b]
            place = np.arange(len(own)) - np.repeat(begins, counts[a:b]) + 4
            total = np.add.reduceat(_blocks(words, starts[own], lengths[own], place), begins)
        out[at[a:b]] = mix(out[at[a:b]] ^ total)
        a = b


def _blocks(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray, place: np.ndarray) -> np.ndarray:
    rest = np.minimum(lengths - 8 * place, 8).astype(np.uint64)
    block = words[starts + 8 * place] & (_ALL >> (np.uint64(64) - rest * np.uint64(8)))
    return mix(mix(place.astype(np.uint64)) ^ mix(block))


def window_starts(first: np.ndarray, n: int) -> np.ndarray:
    """Where windows of ``n`` words begin that stay within one text; ``first`` as ``words`` gives it."""
    fits = np.ones(max(0, int(first[-1]) - n + 1), bool)
    for back in range(1, n):
        late = first[1:] - back
        late = late[(late >= first[:-1]) & (late < len(fits))]
        fits[late] = False
    return np.flatnonzero(fits)


def owners(first: np.ndarray) -> np.ndarray:
    """For each word, the index of its text."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def sums_by_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between the borders ``first``, as whole numbers."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[at] == keys
