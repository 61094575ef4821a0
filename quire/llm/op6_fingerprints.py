"""Document fingerprints: the bottom-k sketch of five-word shingle hashes.

A fingerprint keeps the k smallest distinct 48-bit hashes of a text's
shingles. The k smallest of the union of two fingerprints are the fingerprint
of the union of the texts' shingles, so fingerprints of parts merge; the share
of them that both hold estimates the resemblance, and with the estimated
sizes follow containment and intersection.

As a string a fingerprint is the base64 of its sorted hashes, six big-endian
bytes each; a text without words has the empty string.

Nulls and edge cases: a null text counts as empty. A text of one to four words
has one shingle. Two empty fingerprints have likeness 1, an empty and another
one 0. Rows with equal ids are ordered by their texts; a row with a null id
has no place in the order and is its own next document, as is the only row of
a table. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shingle_hashes, shuffle_partitions, table, text_slices, word_hashes

K, WIDTH, BITS = 128, 5, 48


# --------------------------------------------------------------- the sketch

def sketch(raw: bytes, k: int = K, width: int = WIDTH) -> np.ndarray:
    """The k smallest distinct shingle hashes of a UTF-8 text, sorted."""
    return bottom(shingle_hashes(word_hashes(raw), width) >> np.uint64(64 - BITS), k)


def bottom(hashes: np.ndarray, k: int) -> np.ndarray:
    """The k smallest distinct values, sorted."""
    take = 2 * k
    while len(hashes) > take:                   # repeats can hide behind the cut
        part = np.unique(np.partition(hashes, take)[:take])
        if len(part) >= k:
            return part[:k]
        take *= 4
    return np.unique(hashes)[:k]


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """Fingerprint of the union of what a and b were made from."""
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard similarity of the shingle sets."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = merge(a, b, k)
    return len(np.intersect1d(np.intersect1d(both, a, True), b, True)) / len(both)


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles (exact below k)."""
    return float(len(a)) if len(a) < k else (k - 1) * float(1 << BITS) / (float(a[k - 1]) + 1)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has."""
    if not len(a):
        return 1.0
    return min(1.0, resemblance(a, b, k) * distinct(merge(a, b, k), k) / distinct(a, k))


def to_text(a: np.ndarray) -> str:
    return base64.b64encode(a.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()


def from_text(s: str | None) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(s or ""), np.uint8).reshape(-1, 6)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, 2:] = raw
    return wide.view(">u8").ravel().astype(np.uint64)


# ---------------------------------------------------------------- operators

def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """``id, fingerprint, n_shingles`` (estimated) of each row."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))

    def run(batches):
        for b in text_slices(batches, 1):
            s = [sketch(t or b"", k) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(map(to_text, s), pa.string()),
                                              pa.array([distinct(x, k) for x in s], pa.float64())],
                                             names=["id", "fingerprint", "n_shingles"])
    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, fingerprint string, n_shingles double")


def merge_fingerprints(prints: DataFrame, key_col: str, fingerprint_col: str = "fingerprint", k: int = K) -> DataFrame:
    """``key, fingerprint``: the fingerprint of all rows of a key. Rows of a
    key are merged inside each task before the shuffle, so a hot key costs one
    row a task."""
    kind = prints.schema[key_col].dataType.simpleString()

    def run(batches):
        held: dict = {}
        schema = None
        for b in batches:
            schema = b.schema
            for key, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                a = from_text(s)
                held[key] = merge(held[key], a, k) if key in held else a
            if len(held) > 50_000:
                yield rows(held, schema)
                held = {}
        if held:
            yield rows(held, schema)

    def rows(held, schema):
        return pa.RecordBatch.from_arrays([pa.array(list(held), schema.field(0).type),
                                           pa.array([to_text(v) for v in held.values()], pa.string())],
                                          names=["key", "fingerprint"])
    step = f"key {kind}, fingerprint string"
    first = prints.select(F.col(key_col).alias("key"), F.col(fingerprint_col).alias("fingerprint")).mapInArrow(run, step)
    n = shuffle_partitions(prints.sparkSession)
    return first.repartition(n, "key").sortWithinPartitions("key").mapInArrow(_merge_sorted(k), step)


def _merge_sorted(k: int):
    def run(batches):
        last, acc, keys, out, kind = None, None, [], [], None
        for b in batches:
            kind = b.schema.field(0).type
            for key, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if acc is None or key != last:
                    if acc is not None:
                        keys.append(last), out.append(to_text(acc))
                    last, acc = key, from_text(s)
                else:
                    acc = merge(acc, from_text(s), k)
        if acc is not None:
            keys.append(last), out.append(to_text(acc))
            yield pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array(out, pa.string())], names=["key", "fingerprint"])
    return run


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``bucket, role, id, text``: documents in buckets of descending ids; a
    row of role 1 closes a bucket with the next bucket's first document. One
    shuffle of the texts; the driver holds bounds and first ids of buckets."""
    n = 4 * shuffle_partitions(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = src.agg(F.percentile_approx("id", [k / n for k in range(1, n)], 100 * n)).first()[0]
    bounds = sorted(set(found or []), reverse=True)
    ids = src.select("id")
    # bucket 0: ids over the first bound; each bound closes its bucket from below
    bucket = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]).cast("array<bigint>"), lambda b: F.col("id") < b)) \
        if bounds else F.lit(0)
    first = {r[0]: r[1] for r in ids.where("id is not null").groupBy(bucket.alias("b")).agg(F.max("id")).collect()}
    used = sorted(first)
    # the bucket that a bucket's first document closes: the one before, in a ring
    closes = {first[b]: used[k - 1] for k, b in enumerate(used)}
    flat = [F.lit(x) for pair in closes.items() for x in pair]
    also = F.create_map(*flat)[F.col("id")] if flat else F.lit(None).cast("int")
    none = F.col("id").isNull()
    places = F.when(none, F.array(F.struct((F.lit(-1) - F.pmod(F.xxhash64("text"), F.lit(n))).cast("int").alias("bucket"), F.lit(0).alias("role")))) \
        .when(also.isNull(), F.array(F.struct(bucket.cast("int").alias("bucket"), F.lit(0).alias("role")))) \
        .otherwise(F.array(F.struct(bucket.cast("int").alias("bucket"), F.lit(0).alias("role")),
                           F.struct(also.cast("int").alias("bucket"), F.lit(1).alias("role"))))
    return src.select(F.inline(places), "id", "text")


def _edit(k: int):
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, cols = None, [[] for _ in names]

        def result(key, text, own, after, after_print):
            half = len(text) // 2
            raw = (text[:len(text) - half] + after[:half]).encode()
            edited = sketch(raw, k)
            for c, v in zip(cols, (key, len(text), hashlib.sha256(raw).hexdigest(), to_text(own), to_text(edited),
                                   resemblance(own, edited, k), resemblance(own, after_print, k))):
                c.append(v)

        held = None                              # bucket, id, text, fingerprint
        for b in text_slices(batches, 3):
            kind = b.schema.field("id").type
            for bucket, role, key, text in zip(*[b.column(i).to_pylist() for i in range(4)]):
                text = text or ""
                if held and held[0] != bucket:
                    held = None                  # its bucket is closed
                if bucket < 0:
                    own = sketch(text.encode(), k)
                    result(key, text, own, text, own)
                    continue
                if held is None or held[2] != text:
                    own = sketch(text.encode(), k)
                else:
                    own = held[3]
                if held:
                    result(*held[1:], text, own)
                held = None if role else (bucket, key, text, own)
            if len(cols[0]) >= 2000:
                yield batch(kind, cols)
                cols = [[] for _ in names]
        if cols[0]:
            yield batch(kind, cols)

    def batch(kind, cols):
        types = [kind, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)
    return run


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """Each document's fingerprint, that of its text with the second half
    replaced by the start of the next document (descending ids, in a ring),
    and the likeness of its fingerprint to the edited and the next one's."""
    placed = with_next(docs, id_col, text_col)
    n = shuffle_partitions(docs.sparkSession)
    kind = placed.schema["id"].dataType.simpleString()
    return (placed.repartition(n, "bucket").sortWithinPartitions("bucket", "role", F.desc("id"), "text")
            .mapInArrow(_edit(k), f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
                        "edited_fingerprint string, near_edited double, near_next double"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return edited_fingerprints(table(spark, sf_dir, "documents"))
