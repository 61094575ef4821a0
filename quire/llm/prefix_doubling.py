"""Suffix-array deduplication by plain distributed prefix doubling.

The same rows as ``op1_suffix_dedup``, by the textbook method: every byte
position gets the rank of its first 13 bytes among all positions; Spark then
sorts pairs (rank, rank at an offset) at growing offsets (12, 25), and the
place of a pair in that order is the rank of the next round, of 25 and of 50
bytes. A position whose rank is its own alone is dropped in each round: no
longer string that starts there can repeat.

Only distinct pairs that occur twice or more are sorted and numbered; they are
counted with map-side aggregation, so a string that stands in a third of all
documents is one row there. Ranks are exact, no hash stands for a string.

Position and rank rows of all positions are many times the text, which is why
the registered query does not run this way (README: figures).

Nulls and edge cases, as in ``op1_suffix_dedup``: a null text counts as empty,
an empty or short one is kept as it is. A row with a null id counts as larger
than every id. Rows with equal ids do not remove each other's bytes. Long
texts are cut into overlapping segments of 2^17 bytes where positions are
made; results do not depend on it. Extra columns are not read. An empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import column, discard, scratch, table, text_slices

LENGTH, FIRST_AT_MOST, SEGMENT = 50, 16, 1 << 17
NO_ID = (1 << 63) - 1


def sizes(length: int) -> list[int]:
    """Prefix lengths of the rounds: halves of ``length`` rounded up, from the
    first that is at most ``FIRST_AT_MOST`` (50: 13, 25, 50)."""
    out = [length]
    while out[0] > FIRST_AT_MOST:
        out.insert(0, (out[0] + 1) // 2)
    return out


def numbered(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, next``: the distinct keys that occur twice or more, numbered in
    their order (numbers grow with the keys, with gaps between partitions)."""
    twice = pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*keys)
    return scratch(twice.repartitionByRange(*keys).sortWithinPartitions(*keys)
                   .withColumn("next", F.monotonically_increasing_id()))


def reranked(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """``row, id, pos, rank`` of the positions whose keys are not unique."""
    numbers = numbered(pairs, keys)
    return scratch(pairs.join(numbers, keys).select("row", "id", "pos", F.col("next").alias("rank")))


def repeated_starts(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """``row, pos``: starts of strings of ``length`` bytes that also start in a
    row with a smaller id. ``rows``: ``row, id, text`` (binary, not null)."""
    first, *later = sizes(length)
    long_enough = rows.where(F.length("text") >= length).select("row", "id", "text", F.length("text").alias("n"))
    pieces = long_enough.select("row", "id", "n", "text", F.explode(F.sequence(
        F.lit(0), F.col("n") - first, F.lit(SEGMENT))).alias("begin"))
    pieces = pieces.select("row", "id", "begin", F.least(F.lit(SEGMENT - 1), F.col("n") - first - F.col("begin")).alias("last"),
                           F.expr(f"substring(text, begin + 1, {SEGMENT + first - 1})").alias("piece"))
    at = pieces.select("row", "id", "begin", "piece", F.explode(F.sequence(F.lit(0), "last")).alias("at"))
    prefixes = at.select("row", "id", (F.col("begin") + F.col("at")).alias("pos"),
                         F.expr(f"substring(piece, at + 1, {first})").alias("prefix"))
    ranks, size = reranked(prefixes, ["prefix"]), first
    for longer in later:
        ahead = ranks.select("row", (F.col("pos") - (longer - size)).alias("pos"), F.col("rank").alias("ahead"))
        pairs = scratch(ranks.join(ahead, ["row", "pos"]))
        discard(ranks)
        ranks, size = reranked(pairs, ["rank", "ahead"]), longer
        discard(pairs)
    least = ranks.groupBy("rank").agg(F.min("id").alias("least"))
    return ranks.join(least, "rank").where("id > least").select("row", "pos")


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in text_slices(batches, 1):
        ids, texts, spans = b.column(0), b.column(1).to_pylist(), b.column(2).to_pylist()
        size, gone, runs, sha = [], [], [], []
        for raw, cut in zip(texts, spans):
            digest, at, removed = hashlib.sha256(), 0, 0
            for s in sorted(cut or [], key=lambda s: s["lo"]):
                digest.update(raw[at:s["lo"]])
                at, removed = s["hi"], removed + s["hi"] - s["lo"]
            digest.update(raw[at:])
            size.append(len(raw)), gone.append(removed), runs.append(len(cut or [])), sha.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([ids, *[pa.array(v, pa.int64()) for v in (size, gone, runs)], pa.array(sha, pa.string())],
                                         names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def suffix_dedup_by_doubling(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``id, n_bytes, n_removed, n_spans, kept_sha256``: one row for each input row."""
    rows = scratch(docs.select(
        F.monotonically_increasing_id().alias("row"), F.coalesce(column(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
        F.coalesce(column(text_col).cast("binary"), F.lit(b"")).alias("text")))
    in_text = Window.partitionBy("row").orderBy("pos")
    starts = repeated_starts(rows, length).withColumn("before", F.lag("pos").over(in_text))
    opens = (F.col("before").isNull() | (F.col("pos") > F.col("before") + length)).cast("int")
    spans = (starts.withColumn("run", F.sum(opens).over(in_text)).groupBy("row", "run")
             .agg(F.min("pos").cast("long").alias("lo"), (F.max("pos") + length).cast("long").alias("hi"))
             .groupBy(F.col("row").alias("r")).agg(F.collect_list(F.struct("lo", "hi")).alias("spans")))
    joined = rows.join(spans, rows["row"] == spans["r"], "left").select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias("id"), "text", "spans")
    return joined.mapInArrow(_remove, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``op1_suffix_dedup`` by prefix doubling (not registered)."""
    return suffix_dedup_by_doubling(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
