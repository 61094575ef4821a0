"""What the operators of this subpackage share: reading tables, scratch
tables on shared storage, size-checked broadcasts, word hashes, streaming of
sorted groups, and connected components.

Column names: operators select the columns they are told to use under names
of their own before anything else, so extra columns of the input, whatever
they are called, neither clash nor travel.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_on_exit, ensure_checkpoint_dir

#: Rows of a side that may be broadcast after it was counted (ids, weights,
#: vocabularies: under 100 bytes each).
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def scratch(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` below the session's shared checkpoint folder and read it
    back: cuts lineage, survives lost executors, several readers share it.
    Removed when the driver ends."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}"
    (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
    delete_on_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a scratch table that nothing reads any more."""
    sc = df.sparkSession.sparkContext
    for f in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/llm-" in f:
            path = sc._jvm.org.apache.hadoop.fs.Path(f)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def broadcast_if_small(df: DataFrame, bound: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if a count finds at most ``bound`` rows,
    else as it is (the join then shuffles)."""
    return F.broadcast(df) if df.limit(bound + 1).count() <= bound else df


def column(name: str):
    """The column of this very name, dots and back-ticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def crc32_mod(col, mod: int):
    """crc32 of the id as decimal text, modulo ``mod`` (a fold number)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % mod


# ------------------------------------------------------------- word hashes

_SEGMENT = 1 << 20
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_tables: dict[str, np.ndarray] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising permutation of 64-bit integers (xor-shift, multiply)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the (odd, so invertible) base and of its inverse modulo 2^64."""
    n = max(n, _SEGMENT) + 1
    if "pow" not in _tables or len(_tables["pow"]) < n:
        for name, base in (("pow", _BASE), ("inv", pow(_BASE, -1, 1 << 64))):
            out = np.ones(n, np.uint64)
            out[1:] = np.uint64(base)
            _tables[name] = np.multiply.accumulate(out)
    return _tables["pow"], _tables["inv"]


def byte_values(seed: int = 0) -> np.ndarray:
    """A random 64-bit value for each byte value."""
    return mix64(np.arange(1, 257, dtype=np.uint64) + np.uint64((seed * 1000003 + 77) * 0x9E3779B97F4A7C15 & _MASK))


_VALUES = byte_values()
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def prefix_sums(a: np.ndarray, values: np.ndarray = _VALUES) -> np.ndarray:
    """S with S[j] - S[i] = weighted sum of the bytes i..j-1."""
    power, _ = _powers(len(a))
    out = np.zeros(len(a) + 1, np.uint64)
    np.cumsum(values[a] * power[:len(a)], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the byte strings start..end of what ``sums`` was made
    from; equal strings have equal hashes wherever they stand."""
    _, inverse = _powers(len(sums))
    return mix64((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))


def word_spans(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word (a run without ASCII white space)."""
    space = np.ones(len(a) + 2, bool)
    space[1:-1] = _SPACE[a]
    edges = np.flatnonzero(space[1:] != space[:-1])
    return edges[::2], edges[1::2]


def word_hashes(raw: bytes) -> np.ndarray:
    """64-bit hashes of the words of a UTF-8 text, in order. Long texts are
    hashed in segments cut at white space, so memory stays bounded."""
    parts, at = [], 0
    while at < len(raw):
        end = min(len(raw), at + _SEGMENT)
        while end < len(raw) and raw[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        a = np.frombuffer(raw, np.uint8, end - at, at)
        s, e = word_spans(a)
        if len(s):
            parts.append(span_hashes(prefix_sums(a), s, e))
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def shingle_hashes(words: np.ndarray, n: int = 5) -> np.ndarray:
    """Hash of each run of ``n`` words; a text of fewer words (but one at
    least) has one shingle, all its words."""
    if not len(words):
        return words
    n = min(n, len(words))
    out = np.full(len(words) - n + 1, n, np.uint64)
    for k in range(n):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[k:len(words) - n + 1 + k]
    return mix64(out)


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


# ------------------------------------------------------------ record batches

def text_slices(batches: Iterator[pa.RecordBatch], column: int, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``limit`` bytes of text, so that what a
    task holds as Python values does not depend on the batch size."""
    for batch in batches:
        size = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.diff(np.cumsum(size, dtype=np.int64) // limit)) + 1
        for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            yield batch.slice(s, e - s)
        del batch
        release_memory()


def release_memory() -> None:
    """Give freed memory back to the system: Spark keeps Python workers for
    the next stages, whose needs would come on top."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:                     # another C library
        pass


# ---------------------------------------------------- groups from sorted rows

def row_slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        del batch
        release_memory()


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[dict[str, list]]:
    """Groups of consecutive rows with equal keys, as columns of Python
    values, from batches sorted by the keys. One group is held at a time."""
    held: dict[str, list] | None = None
    last = None
    for batch in row_slices(batches):
        cols = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}
        ids = list(zip(*[cols[k] for k in keys]))
        at = 0
        while at < len(ids):
            end = at + 1
            while end < len(ids) and ids[end] == ids[at]:
                end += 1
            part = {n: v[at:end] for n, v in cols.items()}
            if held is not None and ids[at] == last:
                for n, v in part.items():
                    held[n].extend(v)
            else:
                if held is not None:
                    yield held
                held, last = part, ids[at]
            at = end
    if held is not None:
        yield held


def by_sorted_keys(df: DataFrame, keys: list[str], func, schema: str) -> DataFrame:
    """Apply ``func(batches)`` to partitions that hold whole groups, sorted."""
    n = shuffle_partitions(df.sparkSession)
    return df.repartition(n, *keys).sortWithinPartitions(*keys).mapInArrow(func, schema)


# ------------------------------------------------------- connected components

def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node of each node's component, for the
    nodes of ``edges(a, b)``.

    Alternates the large-star and small-star steps until no edge changes.
    Each step is one aggregation and one join; the edges of every round go to
    a scratch table, so a lost executor costs one round. Hubs are aggregated
    map-side and their join is split by the adaptive skew join.
    """
    spark = edges.sparkSession

    def mark(e: DataFrame):
        r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first()
        return tuple(r)

    cur = scratch(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = mark(cur)
    while seen[0]:
        both = cur.union(cur.select("b", "a"))
        low = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        large = (both.join(low, both["a"] == low["u"]).where("b > u")
                 .select(F.col("b").alias("a"), F.least("u", "m").alias("b")).distinct())
        low2 = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        joined = large.join(low2, large["a"] == low2["u"])
        small = (joined.select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
                 .union(low2.select("u", "m")).where("a <> b").distinct())
        new = scratch(small)
        now = mark(new)
        discard(cur)
        cur = new
        if now == seen:
            break
        seen = now
    return cur.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        cur.select("b", "b").distinct())
