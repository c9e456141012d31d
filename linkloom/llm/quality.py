"""Repetition coverage: characters inside repeated word windows and repeated lines of a text.

Windows of several lengths are hashed from one rolling prefix sum, for a slice of documents at a time. A
text is judged in its own row: nothing is shuffled, and a hot source or group of copies is no harder
than other rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from linkloom.llm import arrays

_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_BASE_WINDOW = 8


@dataclass(frozen=True)
class Rules:
    """Largest share of a text's word characters inside repeated windows, by window length, and inside
    lines equal to an earlier one; the base rules are the least number of words, and the largest
    percentage of words in repeated windows of eight."""

    windows: tuple[tuple[int, float], ...] = ((5, 0.5), (8, 0.4), (10, 0.3))
    lines: float = 0.3
    min_words: int = 20
    repeat_percent: int = 30


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _schema(rules: Rules) -> list[T.StructField]:
    shares = [f"repeat_{n}" for n, _ in rules.windows] + ["repeat_lines"]
    return [
        *[T.StructField(name, T.LongType()) for name in _COUNTS],
        *[T.StructField(name, T.DoubleType()) for name in shares],
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("kept", T.BooleanType()),
    ]


def _covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of ``size`` words lie in one of the windows of ``n`` words."""
    change = np.zeros(size + 1, np.int64)
    change[starts] += 1
    change[starts + n] -= 1
    return np.cumsum(change[:-1]) > 0


def _dup_lines(data, offsets, starts, ends, first, chars):
    """Lines with a word that equal an earlier line of their text: their number and word characters, by text."""
    lines, stops, first_line = arrays.runs(data != 10, offsets)
    before = np.searchsorted(starts, lines), np.searchsorted(starts, stops)
    full = before[1] > before[0]
    total = np.zeros(len(chars) + 1, np.int64)
    np.cumsum(chars, out=total[1:])
    line_chars = total[before[1]] - total[before[0]]
    keys = arrays.word_hashes(data, lines, stops)
    text = arrays.owners(first_line)
    keys = arrays.mix(keys ^ arrays.mix(text.astype(np.uint64)))
    at = np.flatnonzero(full)
    _, earliest = np.unique(keys[at], return_index=True)
    again = full
    again[at[earliest]] = False
    return arrays.sums_by_text(again, first_line), arrays.sums_by_text(np.where(again, line_chars, 0), first_line)


def measure(column: pa.Array, rules: Rules) -> dict[str, np.ndarray]:
    """All columns of the operator for the texts of one slice."""
    data, offsets = arrays.text_bytes(column)
    starts, ends, first = arrays.words(data, offsets)
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    chars = points[ends] - points[starts]
    out = {"n_words": np.diff(first), "word_chars": arrays.sums_by_text(chars, first)}
    out["n_symbols"] = arrays.sums_by_text(_SYMBOLS[data], offsets)
    out["n_dup_lines"], dup_chars = _dup_lines(data, offsets, starts, ends, first, chars)
    hashes = arrays.word_hashes(data, starts, ends)
    text = arrays.mix(arrays.owners(first).astype(np.uint64))
    whole = np.maximum(out["word_chars"], 1)
    kept = np.ones(len(column), bool)
    shares = {}
    for n, most in dict([*rules.windows, (_BASE_WINDOW, dict(rules.windows).get(_BASE_WINDOW))]).items():
        at = arrays.window_starts(first, n)
        keys = arrays.mix(arrays.span_hashes(hashes, at, at + n) ^ text[at])
        inside = _covered(at[arrays.repeated(keys)], n, len(starts))
        if n == _BASE_WINDOW:
            out["n_repeat_words"] = arrays.sums_by_text(inside, first)
        if most is not None:
            shares[f"repeat_{n}"] = arrays.sums_by_text(np.where(inside, chars, 0), first) / whole
            kept &= shares[f"repeat_{n}"] <= most
    shares["repeat_lines"] = dup_chars / whole
    kept &= shares["repeat_lines"] <= rules.lines
    failed = (out["n_words"] < rules.min_words) | (100 * out["n_repeat_words"] > rules.repeat_percent * out["n_words"])
    return out | shares | {"base_failed": failed, "kept": kept & ~failed}


def repetition(docs: DataFrame, text: str = "text", rules: Rules = Rules(), carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` of ``docs`` (all, unless given) with counts, shares, ``base_failed`` and ``kept``.

    Null text counts as empty, and empty texts fail the base rules. Equal texts get equal results, repeated
    rows are judged one by one, null in other columns has no effect, columns of ``docs`` that are named like
    a result are replaced by it, and an empty table gives no rows. One text of any length is judged whole.
    """
    fields = _schema(rules)
    new = [f.name for f in fields]
    keep = [name for name in (docs.columns if carry is None else carry) if name not in new]
    types = dict(zip(docs.columns, docs.schema.fields, strict=True))
    schema = T.StructType([*[types[name] for name in keep], *fields])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrays.slices(batches, text):
            found = measure(part.column(text), rules)
            yield pa.RecordBatch.from_arrays([*[part.column(name) for name in keep], *[pa.array(found[n]) for n in new]], [*keep, *new])

    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)
