"""Language identification: averaged hashed subword embeddings with a linear softmax, and rejection.

A text is the mean of the embeddings of its hashed character runs (UTF-8 bytes, within words of letters),
and a linear softmax scores it. Training is stochastic gradient descent in numpy on a bounded sample of
labelled rows; a part of the sample is kept out of it and calibrates the temperature of the scores and the
score below which a text is rejected. Prediction is a pass over the documents without a shuffle: only
a model of fixed size goes to the tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.llm import arrays
from linkloom.operators.sizes import small
from linkloom.session import materialize

UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    """``per_language`` bounds the labelled rows that are fitted on (those of smallest hash per language;
    all rows are predicted). ``keep`` is the share of calibration texts that a rejection may not touch."""

    per_language: int = 400
    buckets: int = 1 << 13
    runs: tuple[int, ...] = (2, 3, 4)
    size: int = 16
    epochs: int = 30
    batch: int = 32
    rate: float = 0.5
    calibration: float = 0.25
    keep: float = 0.999
    seed: int = 7


@dataclass(frozen=True)
class Model:
    """``weights``: buckets x languages, the product of the embeddings and the softmax layer."""

    languages: tuple[str, ...]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    least: float
    runs: tuple[int, ...]


def _hashed(column: pa.Array, lengths: tuple[int, ...], buckets: int) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """For each run length: the bucket of each run, and the borders of texts; and whether texts have letters.

    Everything but letters becomes a blank, so runs see where words begin and end.
    """
    lower = pc.utf8_lower(pc.fill_null(column, ""))
    spaced = pc.replace_substring_regex(lower, r"[^\p{L}\p{M}]+", " ")
    padded = pc.binary_join_element_wise("", pc.utf8_trim(spaced, " "), "", " ")
    data, offsets = arrays.text_bytes(padded)
    some = np.diff(offsets) > 2
    values = arrays.mix(data)
    found, borders = [], []
    for n in lengths:
        fits = max(0, len(data) - n + 1)
        keys = np.full(fits, n, np.uint64)
        for k in range(n):
            keys = keys * np.uint64(0x9E3779B97F4A7C15) + values[k : k + fits]
        keys = (arrays.mix(keys) & np.uint64(buckets - 1)).astype(np.int32)
        # A run that reaches into the next text belongs to none.
        stops = np.maximum(offsets[1:] - n + 1, offsets[:-1])
        inside = np.zeros(fits + 1, np.int64)
        np.add.at(inside, np.minimum(offsets[:-1], fits), 1)
        np.add.at(inside, np.minimum(stops, fits), -1)
        found.append(keys[np.cumsum(inside[:-1]) > 0])
        counts = stops - offsets[:-1]
        borders.append(np.concatenate([[0], np.cumsum(counts)]))
    return found, borders, some


def _features(batches: Iterable[pa.RecordBatch], settings: Settings) -> Iterator[pa.RecordBatch]:
    """Each labelled text as its sorted buckets and their counts."""
    for part in arrays.slices(batches, "text"):
        found, borders, some = _hashed(part.column("text"), settings.runs, settings.buckets)
        keys, counts = [], []
        for i in range(part.num_rows):
            own = np.concatenate([f[b[i] : b[i + 1]] for f, b in zip(found, borders, strict=True)])
            k, c = np.unique(own, return_counts=True)
            keys.append(k if some[i] else k[:0])
            counts.append(c if some[i] else c[:0])
        yield pa.RecordBatch.from_arrays(
            [part.column("lang"), part.column("held"), pa.array(keys, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))],
            ["lang", "held", "keys", "counts"],
        )


def sample(docs: DataFrame, label: str, text: str, train: Column, settings: Settings) -> DataFrame:
    """The labelled rows to fit on: up to ``per_language`` of each language, those of smallest text hash.

    Languages are counted first, and only texts whose hash is within a few times the share asked for are ranked.
    """
    rows = docs.filter(train & F.col(label).isNotNull() & F.col(text).isNotNull()).select(F.col(label).cast("string").alias("lang"), F.col(text).alias("text"))
    shares = materialize(rows.groupBy("lang").agg((F.lit(8.0 * settings.per_language) / F.count("*")).alias("_share")), "shares")
    hashed = rows.withColumn("_hash", F.xxhash64(F.col("text"), F.lit(settings.seed)))
    near = hashed.join(small(shares), "lang").filter(F.shiftrightunsigned("_hash", 11) < F.col("_share") * float(1 << 53))
    order = Window.partitionBy("lang").orderBy("_hash", "text")
    held = F.pmod(F.xxhash64("_hash"), F.lit(1000)) < int(1000 * settings.calibration)
    ranked = near.withColumn("_hash", F.shiftrightunsigned("_hash", 11)).withColumn("_rank", F.row_number().over(order))
    return ranked.filter(F.col("_rank") <= settings.per_language).select("lang", "text", held.alias("held"))


def fit(docs: DataFrame, label: str = "lang", text: str = "text", train: Column | None = None, settings: Settings = Settings()) -> Model:
    """A model of the rows of ``docs`` with a label where ``train`` holds; without any, one that knows nothing."""
    rows = sample(docs, label, text, F.lit(True) if train is None else train, settings)
    schema = "lang string, held boolean, keys array<int>, counts array<int>"
    got = rows.mapInArrow(lambda batches: _features(batches, settings), schema).toArrow().combine_chunks()
    got = got.filter(pc.greater(pc.list_value_length(got.column("keys")), 0)).sort_by("lang")
    languages = tuple(sorted(set(got.column("lang").to_pylist())))
    if not languages:
        return Model((), np.zeros((settings.buckets, 0), np.float32), np.zeros(0), 1.0, 0.0, settings.runs)
    sizes = pc.list_value_length(got.column("keys")).to_numpy()
    x = np.zeros((len(sizes), settings.buckets), np.float32)
    at = np.repeat(np.arange(len(sizes)), sizes)
    x[at, pc.list_flatten(got.column("keys")).to_numpy()] = pc.list_flatten(got.column("counts")).to_numpy()
    x /= x.sum(axis=1, keepdims=True)
    y = np.searchsorted(languages, np.array(got.column("lang").to_pylist()))
    held = got.column("held").to_numpy(zero_copy_only=False).astype(bool)
    if held.all() or not held.any():
        held = np.zeros(len(y), bool)
    weights, bias = _descend(x[~held], y[~held], len(languages), settings)
    calibrate = held if held.any() else ~held
    logits = x[calibrate] @ weights + bias
    temperature = _temperature(logits, y[calibrate])
    best = _softmax(logits / temperature).max(axis=1)
    least = min(0.5, float(np.quantile(best, 1 - settings.keep)))
    return Model(languages, weights.astype(np.float32), bias, temperature, least, settings.runs)


def _descend(x: np.ndarray, y: np.ndarray, n: int, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Embeddings and softmax layer by stochastic gradient descent; languages count alike."""
    rng = np.random.default_rng(settings.seed)
    # Scaled so that one step moves a rare run as a common one: mean frequencies are of the order 1 / buckets.
    scale = np.float32(settings.buckets**0.5)
    embed = rng.normal(0, 0.1, (settings.buckets, settings.size)).astype(np.float32)
    layer = rng.normal(0, 0.1, (settings.size, n)).astype(np.float32)
    bias = np.zeros(n, np.float32)
    balance = (len(y) / (n * np.maximum(np.bincount(y, minlength=n), 1))).astype(np.float32)
    truth = np.eye(n, dtype=np.float32)
    for epoch in range(settings.epochs):
        rate = np.float32(settings.rate * (1 - epoch / settings.epochs))
        order = rng.permutation(len(y))
        for start in range(0, len(order), settings.batch):
            at = order[start : start + settings.batch]
            rows = x[at] * scale
            mean = rows @ embed
            error = (_softmax(mean @ layer + bias) - truth[y[at]]) * balance[y[at], None] / len(at)
            back = rows.T @ (error @ layer.T)
            layer -= rate * (mean.T @ error)
            bias -= rate * error.sum(axis=0)
            embed -= rate * back
    return scale * (embed @ layer), bias


def _softmax(logits: np.ndarray) -> np.ndarray:
    grown = np.exp(logits - logits.max(axis=1, keepdims=True))
    return grown / grown.sum(axis=1, keepdims=True)


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least loss on texts that were not trained on, of a grid."""
    def loss(t: float) -> float:
        return -float(np.log(_softmax(logits / t)[np.arange(len(y)), y] + 1e-12).mean())

    return min(np.geomspace(0.02, 8, 61).tolist(), key=loss)


def predict(docs: DataFrame, model: Model, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` of ``docs`` (all, unless given), ``lang_pred``, ``score`` and ``rejected``.

    Only the text counts. Null texts and texts without a letter are ``und`` with score 0, and rejected; with a
    model that knows no language, so are all. ``rejected`` also holds where the calibrated score is below
    the model's bound. Equal texts get equal results. Columns of ``docs`` that are named like a result are
    replaced by it; null in other columns and empty tables are no special case.
    """
    new = ["lang_pred", "score", "rejected"]
    keep = [name for name in (docs.columns if carry is None else carry) if name not in new]
    types = dict(zip(docs.columns, docs.schema.fields, strict=True))
    schema = T.StructType([
        *[types[name] for name in keep],
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType()),
    ])
    names = np.array([*model.languages, UNKNOWN], object)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrays.slices(batches, text):
            best, score = _judge(part.column(text), model)
            rejected = (best == len(model.languages)) | (score < model.least)
            yield pa.RecordBatch.from_arrays(
                [*[part.column(name) for name in keep], pa.array(names[best], pa.string()), pa.array(score), pa.array(rejected)], [*keep, *new]
            )

    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)


def _judge(column: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """The number of the best language (past the last: none) and its calibrated probability."""
    n = len(model.languages)
    found, borders, some = _hashed(column, model.runs, len(model.weights))
    if not n or not some.any():
        return np.full(len(column), n), np.zeros(len(column))
    total, counts = np.zeros((len(column), n)), np.zeros(len(column))
    for keys, border in zip(found, borders, strict=True):
        full = np.flatnonzero(np.diff(border))
        if len(full):
            for k in range(n):
                total[full, k] += np.add.reduceat(model.weights[:, k][keys], border[full], dtype=np.float64)
        counts += np.diff(border)
    chances = _softmax((total / np.maximum(counts, 1)[:, None] + model.bias) / model.temperature)
    return np.where(some, chances.argmax(axis=1), n), np.where(some, chances.max(axis=1), 0.0)
