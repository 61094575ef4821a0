"""Quality rules: a hashed n-gram log-likelihood ratio between the multinomial
of trusted documents and that of the whole corpus, besides fixed base rules.

* Features: byte 3-grams, hashed into 2^14 slots.
* Raw counts come from every document, target counts from the trusted ones
  that the caller flags; both are smoothed by one pseudo-count a slot. Only
  the summed slots (a fixed number) reach the driver.
* Score of a document: mean of log p_target - log p_raw over its 3-grams, so
  it does not depend on length.
* ``kept`` is false if the base rules fail (under ``min_words`` words, or over
  ``max_repeat_pct`` per cent of the words in a repeated 3-word window), else
  score >= ``threshold``. The same rows always give the same verdict.

Nulls and edge cases: a null text counts as empty; an empty or too short text
has score 0 and fails the base rules. Rows with a null id are scored like
others (and are never trusted). Repeated rows count as often as they occur.
An empty table gives an empty result; without trusted documents all scores
are 0 and only the base rules decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import broadcast_if_small, table, text_slices
from .stats import text_counts

SLOTS_LOG2 = 14
THRESHOLD = -0.5
MIN_WORDS, MAX_REPEAT_PCT = 50, 50


def slots(raw: bytes) -> np.ndarray:
    """Hashed slot of each byte 3-gram."""
    a = np.frombuffer(raw, np.uint8).astype(np.uint32)
    if len(a) < 3:
        return np.zeros(0, np.uint32)
    x = a[:-2] * np.uint32(65536) + a[1:-1] * np.uint32(256) + a[2:]
    return (x * np.uint32(2654435761)) >> np.uint32(32 - SLOTS_LOG2)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = 1 << SLOTS_LOG2
    raw_counts, target = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for batch in text_slices(batches, 0):
        for text, trusted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            c = np.bincount(slots(text or b""), minlength=n)
            raw_counts += c
            if trusted:
                target += c
    at = np.flatnonzero(raw_counts)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw_counts[at]), pa.array(target[at])],
                                     names=["slot", "raw", "target"])


def ratio_weights(docs: DataFrame, text_col: str, trusted_col: str) -> np.ndarray:
    """log p_target - log p_raw of each slot."""
    per_task = docs.select(F.col(text_col).cast("binary"), F.col(trusted_col).cast("boolean")).mapInArrow(
        _count, "slot long, raw long, target long")
    counts = np.zeros((1 << SLOTS_LOG2, 2))
    for r in per_task.groupBy("slot").agg(F.sum("raw"), F.sum("target")).collect():  # 2^14 rows at most
        counts[r[0]] = r[1], r[2]
    if not counts[:, 1].any():
        return np.zeros(len(counts))
    p = np.log((counts + 1) / (counts.sum(0) + len(counts)))
    return p[:, 1] - p[:, 0]


def trusted_flag(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``text, trusted`` of all documents: trusted if labelled quality 1."""
    good = labels.where(F.col("quality") == 1).select(F.col("doc_id").alias("_label")).where("_label is not null").distinct()
    good = good.withColumn("_trusted", F.lit(True))
    src = docs.select(F.col(id_col).alias("_id"), F.col("text").alias("_text"))
    return src.join(broadcast_if_small(good), F.col("_id") == F.col("_label"), "left").select(
        F.col("_text").alias("text"), F.coalesce("_trusted", F.lit(False)).alias("trusted"))


def judge(raw: bytes | None, weights: np.ndarray, threshold: float) -> tuple:
    """The five counts, base_failed, score and kept of one text."""
    raw = raw or b""
    counts = text_counts(raw)
    failed = counts[0] < MIN_WORDS or 100 * counts[4] > MAX_REPEAT_PCT * counts[0]
    s = slots(raw)
    score = float(weights[s].mean()) if len(s) else 0.0
    return (*counts, failed, score, not failed and score >= threshold)


def quality_rules(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
                  threshold: float = THRESHOLD) -> DataFrame:
    """One row for each input row: id, counts, ``base_failed``, ``score`` and
    ``kept``."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    types = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"]

    def run(batches):
        for batch in text_slices(batches, 1):
            rows = [judge(t, weights, threshold) for t in batch.column(1).to_pylist()]
            cols = list(zip(*rows)) if rows else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(cols, types)]],
                                             names=["doc_id", *names])
    kinds = ["long"] * 5 + ["boolean", "double", "boolean"]
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, "
                          + ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))


def keep_good(docs: DataFrame, weights: np.ndarray, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that the rules keep."""
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in text_slices(batches, at):
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            yield batch.filter(pa.array([judge(t, weights, threshold)[-1] for t in texts], pa.bool_()))
    # columns by place: names may hold dots or repeat
    plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document; trusted are those labelled of
    quality 1."""
    docs = table(spark, sf_dir, "documents")
    weights = ratio_weights(trusted_flag(docs, table(spark, sf_dir, "labels")), "text", "trusted")
    return quality_rules(docs, weights)
