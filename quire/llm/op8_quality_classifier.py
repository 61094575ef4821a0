"""Quality classifier: ridge regression on random Fourier features of document
statistics, calibrated by isotonic regression.

1. A scan turns each whole text into some twenty statistics.
2. The statistics of labelled rows are standardised and mapped to cosines of
   random projections, which approximate a Gaussian kernel. Tasks sum the
   normal equations of their rows; sums are summed again on a few tasks, and
   the driver solves one small system.
3. Scores of the training rows, in fixed bins with label counts, are pooled
   into a non-decreasing function (adjacent violators); it maps every score
   to a probability.

Nulls and edge cases: a null text counts as empty (all statistics 0). Labels
with a null id or value are ignored; several labels of an id all count. A row
with a null id is scored and never learnt from. Without labels all scores are
0.5. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc32_mod, scratch, table, text_slices
from .stats import text_counts

FEATURES, GAMMA, RIDGE, SEED, BINS = 128, 0.02, 0.1, 8, 2000
CUT = 0.3
#: tasks of the second summation
SUM_TASKS = 8

_CLASSES = {"upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "high": range(128, 256),
            "end": b".!?", "bang": b"!", "bar": b"|", "comma": b",;:", "quote": b"\"'", "bracket": b"()[]{}<>",
            "mark": b"#*$%&@=+/\\_~^", "space": b" ", "line": b"\n"}
_MATRIX = np.array([[float(c in set(v)) for v in _CLASSES.values()] for c in range(256)])


def statistics(raw: bytes) -> np.ndarray:
    """Statistics of a whole text; lengths as logarithms, the rest as shares."""
    n_words, chars, symbols, dup_lines, repeated = text_counts(raw)
    out = np.zeros(len(_CLASSES) + 8)
    if not raw:
        return out
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size = len(raw)
    out[:len(_CLASSES)] = hist @ _MATRIX / size
    p = hist[hist > 0] / size
    lines = raw.count(b"\n") + 1
    words = max(1, n_words)
    out[len(_CLASSES):] = (np.log1p(n_words), chars / words, symbols / words, dup_lines / lines, repeated / words,
                           -(p * np.log(p)).sum(), p.max(), np.log1p(size / lines))
    return out


N_STATS = len(_CLASSES) + 8


def describe(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, stats`` of each row."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, 1):
            stats = [statistics(t or b"").astype(np.float32) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([s.tobytes() for s in stats], pa.binary())],
                                             names=["doc_id", "stats"])
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, stats binary")


def _stats_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, N_STATS).astype(float)


def projections() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return rng.normal(0, np.sqrt(2 * GAMMA), (N_STATS, FEATURES)), rng.uniform(0, 2 * np.pi, FEATURES)


class Model:
    """Standardisation, ridge weights and the calibration's steps."""

    def __init__(self, mean: np.ndarray, std: np.ndarray):
        self.mean, self.std = mean, std
        self.weights: np.ndarray | None = None
        self.x, self.y = np.array([0.0]), np.array([0.5])

    def features(self, stats: np.ndarray) -> np.ndarray:
        w, b = projections()
        z = np.clip((stats - self.mean) / self.std, -8, 8)
        f = np.sqrt(2 / FEATURES) * np.cos(z @ w + b)
        return np.hstack([f, np.ones((len(f), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return np.zeros(len(stats)) if self.weights is None else self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.x, self.y)


def _sums(rows_of):
    """mapInArrow function that adds up the arrays ``rows_of`` makes of
    batches and yields one row."""
    def run(batches):
        total = None
        for b in batches:
            if b.num_rows:
                part = rows_of(b)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["s"])
    return run


def summed(df: DataFrame, rows_of) -> np.ndarray | None:
    """Sum over all rows: per task, then on a few tasks, then here."""
    def again(b):
        return np.sum([np.frombuffer(x) for x in b.column(0).to_pylist()], axis=0)
    parts = (df.mapInArrow(_sums(rows_of), "s binary").repartition(SUM_TASKS)
             .mapInArrow(_sums(again), "s binary").collect())
    return np.sum([np.frombuffer(r[0]) for r in parts], axis=0) if parts else None


def isotonic(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted non-decreasing least squares fit (pool adjacent violators)."""
    blocks: list[list[float]] = []
    for v, w in zip(value, weight):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks.pop()
            blocks.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks])


def fit(labelled: DataFrame) -> Model:
    """Fit on ``stats, label`` (0 or 1)."""
    def moments(b):
        x = _stats_of(b.column(0))
        return np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)])
    m = summed(labelled, moments)
    if m is None:
        return Model(np.zeros(N_STATS), np.ones(N_STATS))
    n, mean = m[0], m[1:1 + N_STATS] / m[0]
    std = np.sqrt(np.maximum(m[1 + N_STATS:] / n - mean ** 2, 0))
    model = Model(mean, np.where(std > 1e-9, std, 1.0))

    def normal(b):
        f = model.features(_stats_of(b.column(0)))
        y = b.column(1).to_numpy(zero_copy_only=False).astype(float)
        return np.concatenate([(f.T @ f).ravel(), f.T @ y])
    s = summed(labelled, normal)
    d = FEATURES + 1
    ridge = RIDGE * np.eye(d)
    ridge[-1, -1] = 0
    model.weights = np.linalg.solve(s[:d * d].reshape(d, d) + ridge, s[d * d:])

    def binned(b):
        k = np.clip((model.raw(_stats_of(b.column(0))) + 0.5) / 2 * BINS, 0, BINS - 1).astype(int)
        y = b.column(1).to_numpy(zero_copy_only=False).astype(float)
        return np.concatenate([np.bincount(k, minlength=BINS), np.bincount(k, y, BINS)]).astype(float)
    s = summed(labelled, binned)
    count, good = s[:BINS], s[BINS:]
    have = count > 0
    model.x = ((np.arange(BINS) + 0.5) / BINS * 2 - 0.5)[have]
    # a half label of either kind a pooled block keeps scores off 0 and 1
    model.y = np.clip(isotonic(good[have] / count[have], count[have]), 0.5 / (n + 1), 1 - 0.5 / (n + 1))
    return model


def score(described: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of ``doc_id, stats``."""
    def run(batches):
        for b in batches:
            s = model.score(_stats_of(b.column(1))) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], names=["doc_id", "score"])
    return described.mapInArrow(run, f"doc_id {described.schema['doc_id'].dataType.simpleString()}, score double")


def classify(docs: DataFrame, labels: DataFrame, label_col: str = "quality", cut: float = CUT) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each row of ``docs``. Rows of
    fold 0 of five (crc32 of the id) are not learnt from."""
    described = scratch(describe(docs))
    known = labels.select(F.col("doc_id").alias("_id"), F.col(label_col).cast("double").alias("label")).where(
        "_id is not null and label is not null")
    known = known.where(crc32_mod("_id", 5) != 0)
    labelled = scratch(described.join(known, F.col("doc_id") == F.col("_id")).select("stats", "label"))
    out = score(described, fit(labelled))
    return out.select("doc_id", F.coalesce(crc32_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= cut).cast("int").alias("predicted"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from ``labels.quality``."""
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
