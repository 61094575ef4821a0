"""Language identification with string kernels.

A text is the set of its byte n-grams, n = 1 to 4 (blended spectrum), of the
lower-cased text, hashed into 2^16 places; the kernel of two texts is the
number of shared places over the geometric mean of their numbers (presence,
not counts). Nyström landmarks span the kernel's feature space, and kernel
ridge regression fits one score per language against the rest there.

Scoring folds landmarks and ridge weights into one matrix (places x
languages); a batch of presence vectors is multiplied by it. Every whole text
is scored; only learning is bounded: about ``per_language`` labelled rows of
each language, chosen by the hash of their id, of which 200 in all, or 20 a
language if that is more, are landmarks. The sample reaches the driver as packed
bits (8 KB a row), and only the landmarks are made dense together. There is no
bound on the number of languages.

Nulls and edge cases: a text that is null or has no letter (of any script;
numerals such as a half are none) is ``und`` with
score 0. A null language is not learnt from. Without anything to learn from
all texts are ``und``. Ties go to the language first in order. Rows with equal
or null ids are predicted like others; null ids are not learnt from. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import crc32_mod, table, text_slices

PLACES_LOG2, MAX_N = 16, 4
PER_LANGUAGE, LANDMARKS, RIDGE, EPSILON = 300, 200, 0.1, 1e-6
#: Landmarks of a language, if that makes more; rows made dense at a time.
PER_LANGUAGE_LANDMARKS, DENSE_ROWS = 20, 256
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


def places(text: str) -> np.ndarray:
    """Sorted hashed places of the n-grams of a text."""
    a = np.frombuffer(text.lower().encode("utf-8", "ignore"), np.uint8).astype(np.uint32)
    flags = np.zeros(1 << PLACES_LOG2, bool)
    gram = np.zeros(len(a) + 1, np.uint32)
    for n in range(1, min(MAX_N, len(a)) + 1):
        gram = gram[:-1] * np.uint32(256) + a[n - 1:]
        key = (gram ^ np.uint32(n * 0x3C6EF372 & 0xFFFFFFFF)) * np.uint32(2654435761)
        flags[key >> np.uint32(32 - PLACES_LOG2)] = True
    return np.flatnonzero(flags)


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


class Model:
    """Languages, and the matrix that turns presence vectors into scores."""

    def __init__(self, langs: list[str], matrix: np.ndarray):
        self.langs, self.matrix = langs, matrix

    def scores(self, texts: list[str]) -> np.ndarray:
        """Batched product of normalised presence vectors and the matrix."""
        rows = [places(t) for t in texts]
        sizes = np.array([len(r) for r in rows])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        product = np.add.reduceat(self.matrix[np.concatenate(rows)], starts, axis=0)
        return product / np.sqrt(sizes)[:, None]


def fit(bits: list[bytes], langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Kernel ridge on Nyström features of rows given as presence bits, in
    order of rank inside their languages, so that the first ones, which are the
    landmarks, are spread over the languages. Rows are made dense a few at a
    time: the driver holds the landmarks, and 8 KB for any other row."""
    names = sorted(set(langs))

    def dense(at: int, end: int) -> np.ndarray:
        x = np.unpackbits(np.frombuffer(b"".join(bits[at:end]), np.uint8)).reshape(-1, 1 << PLACES_LOG2).astype(np.float32)
        return x / np.sqrt(np.maximum(x.sum(1), 1))[:, None]
    z = dense(0, landmarks)
    values, vectors = np.linalg.eigh((z @ z.T).astype(float))
    keep = values > EPSILON * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])           # Nyström map of the landmarks
    phi = np.vstack([(dense(k, k + DENSE_ROWS) @ z.T).astype(float) for k in range(0, len(bits), DENSE_ROWS)]) @ root
    y = np.where(np.array(langs)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    # languages weigh alike however many rows they have
    count = Counter(langs)
    weight = np.array([1 / count[v] for v in langs]) * len(langs) / len(names)
    bias = np.hstack([phi, np.ones((len(phi), 1))])
    reg = ridge * np.eye(bias.shape[1])
    reg[-1, -1] = 1e-9
    w = np.linalg.solve(bias.T @ (bias * weight[:, None]) + reg, bias.T @ (y * weight[:, None]))
    model = Model(names, (z.T.astype(float) @ (root @ w[:-1])).astype(np.float32))
    model.bias = w[-1]
    return model


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """``lang, r, bits``: presence bits of a bounded sample of ``id, text,
    lang``; ``r`` orders the rows of a language by the hash of their id."""
    known = docs.where("id is not null and lang is not null and text is not null")
    sizes = known.groupBy("lang").count().collect()
    # twice the share that is needed on average, then the first of each language
    rate = {r[0]: min(1.0, 2 * per_language / r[1]) for r in sizes}
    if not rate:
        return None
    share = F.create_map(*[F.lit(x) for kv in rate.items() for x in kv])[F.col("lang")]
    h = F.xxhash64(F.lit(4), "id")
    chosen = known.where(F.pmod(h, F.lit(1_000_000)) < share * 1_000_000).select("lang", h.alias("h"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, 2):
            ok = [k for k, t in enumerate(b.column(2).to_pylist()) if has_letter(t)]
            b = b.take(pa.array(ok, pa.int64()))
            bits = []
            for t in b.column(2).to_pylist():
                flags = np.zeros(1 << PLACES_LOG2, bool)
                flags[places(t)] = True
                bits.append(np.packbits(flags).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(bits, pa.binary())], names=["lang", "h", "bits"])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "bits"))
    return chosen.mapInArrow(run, "lang string, h long, bits binary").withColumn("r", rank).where(F.col("r") <= per_language)


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          folds: int = 5, held: int = 0) -> Model | None:
    """Fit on the rows whose fold is not ``held``."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    chosen = sample(src.where(crc32_mod("id", folds) != held))
    rows = sorted(chosen.collect(), key=lambda r: (r["r"], r["lang"])) if chosen is not None else []
    if not rows:
        return None
    langs = [r["lang"] for r in rows]
    return fit([r["bits"] for r in rows], langs, max(LANDMARKS, PER_LANGUAGE_LANDMARKS * len(set(langs))))


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", batch_rows: int = 64) -> DataFrame:
    """``doc_id, lang_pred, score`` of each row."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def predict(texts):
        out = [(UNKNOWN, 0.0)] * len(texts)
        todo = [k for k, t in enumerate(texts) if has_letter(t)] if model is not None else []
        for at in range(0, len(todo), batch_rows):
            part = todo[at:at + batch_rows]
            s = model.scores([texts[k] for k in part]) + model.bias
            best = s.argmax(1)
            for k, b, v in zip(part, best, s.max(1)):
                out[k] = model.langs[b], float(min(1.0, max(0.0, (v + 1) / 2)))
        return out

    def run(batches):
        for b in text_slices(batches, 1):
            got = predict(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([g[0] for g in got], pa.string()),
                                              pa.array([g[1] for g in got], pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; fold 0 of five is held out."""
    docs = table(spark, sf_dir, "documents")
    return identify(docs, learn(docs)).select(
        "doc_id", F.coalesce(crc32_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")
