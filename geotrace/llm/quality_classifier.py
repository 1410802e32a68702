"""Quality classifier: random Fourier features over document statistics, ridge scores, isotonic calibration.

1. Each whole text becomes ``len(STATS)`` statistics (no labels, language, source or id among them).
2. Random Fourier features of the standardised statistics approximate a Gaussian kernel.
3. Ridge: each partition sums its part of the normal equations, 16 tasks sum those, and the driver solves
   one system of fixed size (``features`` + 1). All labelled rows take part; nothing is sampled.
4. Isotonic calibration (pool adjacent violators) over score bins of fixed width on labelled rows kept out
   of the ridge fit. Scores are interpolated between the pooled blocks.

Null texts count as empty and are scored like any other. Labels repeated for a document are averaged; null
labels are left out. Without any label the score is 0.5 everywhere. An empty table gives an empty one.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geotrace.llm.common import fresh, held_out, stored, without

STATS = ("log_words", "log_chars", "mean_word", "max_word", "distinct_words", "top_word", "repeated_neighbours",
         "distinct_pairs", "upper", "lower", "digits", "symbols", "bangs", "pipes", "stops", "other", "short_words",
         "log_lines", "repeated_lines", "compression", "marked_words")
BINS = 1000  # of width 1/BINS over ridge scores -1 .. 2
_UPPER, _LOWER, _DIGITS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789"
_SYMBOLS, _STOPS, _SPACES = b"#*$%&|<>@^~=+_\\{}[]", b".,;:?", b" \t\n\r\x0b\x0c"


def doc_stats(text: bytes | None) -> list[float]:
    """The statistics of one text (UTF-8 bytes), in the order of ``STATS``."""
    text = text or b""
    words = text.split()
    n, size = len(words), len(text)
    if not n:
        return [0.0] * len(STATS)
    def share(chars: bytes) -> float:
        return (size - len(text.translate(None, chars))) / size
    counts = Counter(words)
    lengths = [len(w) for w in words]
    lines = [x for x in text.split(b"\n") if x.strip()]
    upper, lower, digits, symbols, stops = map(share, (_UPPER, _LOWER, _DIGITS, _SYMBOLS, _STOPS))
    bangs = text.count(b"!") / size
    spaces = share(_SPACES)
    pairs = len(set(zip(words, words[1:], strict=False)))
    return [
        math.log1p(n), math.log1p(size), sum(lengths) / n / 10, math.log1p(max(lengths)), len(counts) / n,
        max(counts.values()) / n, sum(map(bytes.__eq__, words[1:], words)) / n, (pairs + 1) / n, upper, lower, digits,
        symbols, bangs, text.count(b"|") / size, stops, max(0.0, 1 - upper - lower - digits - symbols - stops - bangs - spaces),
        sum(1 for x in lengths if x < 3) / n, math.log1p(len(lines)), 1 - len(set(lines)) / len(lines),
        len(zlib.compress(text, 1)) / size, sum(1 for w in counts if w[-1:] in b"!#*$%&|") / len(counts)]


def with_stats(df: DataFrame, text_col: str, out: str, keep_text: bool = False) -> DataFrame:
    """``df`` (without the text unless ``keep_text``) with the statistics as array<float> in ``out``."""
    at = df.columns.index(text_col)
    kept = [f for f in df.schema.fields if keep_text or f.name != text_col]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).cast(pa.large_binary())
            stats = pa.array([doc_stats(t.as_py()) for t in texts], pa.list_(pa.float32()))
            where = [i for i in range(batch.num_columns) if keep_text or i != at]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in where], stats],
                                             names=[*[batch.schema.names[i] for i in where], out])

    return df.mapInArrow(add, T.StructType([*kept, T.StructField(out, T.ArrayType(T.FloatType()))]))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), len(STATS))


def _summed(df: DataFrame, part, shape: int) -> np.ndarray:
    """Sum of ``part(batch)`` (an array of ``shape`` numbers) over all batches: by partition, by 16 tasks, here."""
    def add(batches: Iterator[pa.RecordBatch], read) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                total += read(batch)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

    def whole(batch: pa.RecordBatch) -> np.ndarray:
        return sum(np.frombuffer(x.as_py()) for x in batch.column(0))

    partial = df.mapInArrow(lambda b: add(b, part), "total binary").repartition(16)
    rows = partial.mapInArrow(lambda b: add(b, whole), "total binary").collect()
    return sum((np.frombuffer(r.total) for r in rows), np.zeros(shape))


@dataclass
class Model:
    """A fitted classifier; a few hundred kB at most, whatever the input."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # statistics x features
    phase: np.ndarray
    coef: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -6, 6)
        z = math.sqrt(2 / len(self.phase)) * np.cos(x @ self.weights + self.phase)
        return np.hstack([z, np.ones((len(x), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.coef

    def score(self, stats: np.ndarray) -> np.ndarray:
        if not len(self.knots):
            return np.full(len(stats), 0.5)
        return np.clip(np.interp(self.raw(stats), self.knots, self.values), 0, 1)


def isotonic(x: np.ndarray, good: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over ascending bins; (mean x, good / n) of each block."""
    blocks: list[list[float]] = []
    for a, g, c in zip(x, good, n, strict=True):
        blocks.append([a * c, g, c])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last, strict=True)]
    b = np.array(blocks).reshape(-1, 3)
    return b[:, 0] / b[:, 2], b[:, 1] / b[:, 2]


def fit(rows: DataFrame, stats_col: str, label_col: str, calibrate_col: str, features: int = 384, bandwidth: float = 1.0,
        ridge: float = 1e-4, seed: int = 17) -> Model:
    """Fit on labelled rows (label 0/1 or a mean of such); ``calibrate_col`` marks the rows kept for calibration.

    ``bandwidth`` is the kernel's width in units of sqrt(number of statistics). If either part has no rows, all
    rows serve both.
    """
    rows = rows.select(F.col(stats_col).alias("s"), F.col(label_col).cast("double").alias("y"), F.col(calibrate_col).alias("c"))
    d, rng = len(STATS), np.random.default_rng(seed)
    weights = rng.normal(size=(d, features)) / (bandwidth * math.sqrt(d))
    model = Model(np.zeros(d), np.ones(d), weights, rng.uniform(0, 2 * math.pi, features), np.zeros(features + 1),
                  np.zeros(0), np.zeros(0))
    n_calibrate, n = rows.agg(F.sum(F.col("c").cast("long")), F.count("*")).first()
    if not n:
        return model
    both = not n_calibrate or n_calibrate == n
    train, calibrate = (rows, rows) if both else (rows.where("NOT c"), rows.where("c"))

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        x = _matrix(batch.column(0))
        return np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)])
    m = _summed(train, moments, 2 * d + 1)
    model.mean = m[1 : d + 1] / m[0]
    model.scale = np.sqrt(np.maximum(m[d + 1 :] / m[0] - model.mean**2, 0))
    model.scale[model.scale < 1e-6] = 1.0

    def normal(batch: pa.RecordBatch) -> np.ndarray:
        z, y = model.features(_matrix(batch.column(0))), batch.column(1).to_numpy(zero_copy_only=False)
        return np.concatenate([(z.T @ z).ravel(), z.T @ y])
    k = features + 1
    sums = _summed(train, normal, k * k + k)
    model.coef = np.linalg.solve(sums[: k * k].reshape(k, k) + ridge * m[0] * np.eye(k), sums[k * k :])

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = model.raw(_matrix(batch.column(0)))
            bin_ = np.clip(np.floor(raw * BINS), -BINS, 2 * BINS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bin_), batch.column(1)], names=["bin", "y"])
    binned = calibrate.mapInArrow(bins, "bin long, y double").groupBy("bin").agg(F.sum("y").alias("good"), F.count("*").alias("n"))
    found = sorted(binned.collect())  # at most 3 * BINS + 1 rows
    x, good, n = np.array([tuple(r) for r in found]).T
    model.knots, model.values = isotonic((x + 0.5) / BINS, good, n)
    return model


def apply(df: DataFrame, model: Model, stats_col: str, out: str) -> DataFrame:
    """``df`` with the calibrated score in ``out`` in place of the statistics."""
    at = df.columns.index(stats_col)
    kept = [f for f in df.schema.fields if f.name != stats_col]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(_matrix(batch.column(at)))
            where = [i for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in where], pa.array(score)],
                                             names=[*[batch.schema.names[i] for i in where], out])

    return df.mapInArrow(add, T.StructType([*kept, T.StructField(out, T.DoubleType())]))


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
           keep_text: bool = False, score: str = "score", **params) -> tuple[DataFrame, bool]:
    """(``docs`` with ``score``, whether there were labels). Labels are learnt from ids with crc32 mod 4 in 0, 1, 3;
    remainder 3 calibrates. Texts are read once, into a table with the statistics."""
    docs = without(docs, score)
    stats = fresh(docs, "stats")
    rows = stored(with_stats(docs, text_col, stats, keep_text), "statistics")
    known = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.avg(label_col).alias("label"))
    light = rows.select(F.col(id_col).alias("id"), F.col(stats).alias("stats")).where(~held_out(F.col("id"), 4, 2))
    told = stored(light.join(known, "id").select("stats", "label", held_out(F.col("id"), 4, 3).alias("calibrate")), "labelled")
    model = fit(told, "stats", "label", "calibrate", **params)
    return apply(rows, model, stats, score), bool(len(model.knots))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **params) -> DataFrame:
    """Documents with a score of at least ``threshold``, with their columns as they came; all of them without labels."""
    name = fresh(docs, "quality_score")
    out, told = scored(docs, labels, keep_text=True, score=name, **params)
    return (out.where(F.col(name) >= threshold) if told else out).select(*[F.col(f"`{c}`") for c in docs.columns])
