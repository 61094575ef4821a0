"""Readers of the index side files in their text formats: lexicon
(``term offset length docFreq``), page table (``docID length``) and block
metadata (``size lastDocID``, in block order, no term key).

Bad lines are returned as rejects ``(line, reason)``. Where the same key
occurs twice the later line wins; "later" is the position in the input
(file, split start, row), recorded as ``_line_order`` while reading.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.prefix import global_running_sum
from .collection import Parsed

_CHUNK_BLOCKS = 1 << 16


def _lines_in_order(spark: SparkSession, path: str) -> DataFrame:
    """``value`` plus ``_line_order``, a key that sorts lines in input order:
    file path, start of the file split, then row position inside the split."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        "value",
        F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("s"),
                 F.monotonically_increasing_id().alias("r")).alias("_line_order"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``line_no, value``: the lines of the files in input order, from 0."""
    lines = _lines_in_order(spark, path).withColumn("_one", F.lit(1))
    return global_running_sum(lines, ["_line_order"], "_one", "line_no").select("line_no", "value")


def _fields(n: int) -> tuple[Column, list[Column]]:
    words = F.split(F.trim(F.col("value")), r"\s+")
    return words, [F.get(words, i) for i in range(n)]


def _numbers_ok(cols: list[Column]) -> Column:
    ok = F.lit(True)
    for c in cols:
        ok = ok & c.try_cast("bigint").isNotNull() & (c.try_cast("bigint") >= 0)
    return ok


def read_lexicon(spark: SparkSession, path: str) -> Parsed:
    """``term, offset, length, doc_freq`` (BIGINT); the last line of a term wins."""
    words, (term, off, length, df) = _fields(4)
    staged = _lines_in_order(spark, path).select(
        "value", "_line_order", term.alias("term"), off.try_cast("bigint").alias("offset"),
        length.try_cast("bigint").alias("length"), df.try_cast("bigint").alias("doc_freq"),
        (F.size(words) >= 4).alias("_n_ok"), _numbers_ok([off, length, df]).alias("_num_ok"))
    good_rows = staged.where(F.col("_n_ok") & F.col("_num_ok") & (F.col("term") != ""))
    good = good_rows.groupBy("term").agg(
        F.max_by(F.struct("offset", "length", "doc_freq"), "_line_order").alias("e")).select(
        "term", "e.offset", "e.length", "e.doc_freq")
    rejects = staged.where(~(F.col("_n_ok") & F.col("_num_ok") & (F.col("term") != ""))).select(
        F.col("value").alias("line"), F.lit("bad lexicon line").alias("reason"))
    return Parsed(good, rejects)


def read_doc_lengths(spark: SparkSession, path: str) -> Parsed:
    """Page table ``doc_id, n_tokens`` (BIGINT); the last line of a doc wins."""
    words, (doc, n) = _fields(2)
    staged = _lines_in_order(spark, path).select(
        "value", "_line_order", doc.try_cast("bigint").alias("doc_id"), n.try_cast("bigint").alias("n_tokens"),
        ((F.size(words) >= 2) & _numbers_ok([doc, n])).alias("_ok"))
    good = staged.where("_ok").groupBy("doc_id").agg(
        F.max_by("n_tokens", "_line_order").alias("n_tokens"))
    rejects = staged.where(~F.col("_ok")).select(
        F.col("value").alias("line"), F.lit("bad page table line").alias("reason"))
    return Parsed(good, rejects)


def read_block_meta(spark: SparkSession, path: str) -> Parsed:
    """Block metadata lines in index order: ``block_index, n_bytes,
    last_doc_id, offset``. ``block_index`` counts good lines from 0 and
    ``offset`` is the running byte sum (a distributed prefix sum), so a bad
    line is rejected without shifting the blocks after it."""
    words, (size, last) = _fields(2)
    staged = _lines_in_order(spark, path).select(
        "value", "_line_order", size.try_cast("bigint").alias("n_bytes"),
        last.try_cast("bigint").alias("last_doc_id"),
        ((F.size(words) >= 2) & _numbers_ok([size, last])).alias("_ok"))
    good = staged.where("_ok").select("_line_order", "n_bytes", "last_doc_id", F.lit(1).alias("_one"))
    ordered = global_running_sum(good, ["_line_order"], ["_one", "n_bytes"], ["block_index", "offset"])
    rejects = staged.where(~F.col("_ok")).select(
        F.col("value").alias("line"), F.lit("bad block metadata line").alias("reason"))
    return Parsed(ordered.select("block_index", "n_bytes", "last_doc_id", "offset"), rejects)


def attach_block_terms(block_meta: DataFrame, lexicon: DataFrame, block_size: int = 64) -> DataFrame:
    """Key positional block metadata by ``(term, block_no)`` with the
    lexicon: a term owns ``ceil(doc_freq / block_size)`` consecutive blocks,
    terms in offset order. Each lexicon entry is expanded into its block
    numbers in two steps (chunks of 65,536 blocks, spread over tasks, then
    the blocks of a chunk), so a very long list never expands in one task;
    the result meets the metadata in an equi-join on the block index."""
    per_term = lexicon.select("term", "offset", F.ceil(F.col("doc_freq") / F.lit(block_size))
                              .cast("bigint").alias("_nb"))
    firsts = global_running_sum(per_term, ["offset", "term"], "_nb", "_first")
    chunks = firsts.select(
        "term", "_first", "_nb",
        F.explode(F.sequence(F.lit(0).cast("bigint"),
                             F.call_function("div", F.col("_nb") - 1, F.lit(_CHUNK_BLOCKS).cast("bigint"))))
        .alias("_chunk"))
    chunks = chunks.repartition("term", "_chunk")
    start = F.col("_chunk") * F.lit(_CHUNK_BLOCKS)
    end = F.least(start + F.lit(_CHUNK_BLOCKS), F.col("_nb")) - 1
    owned = chunks.select("term", "_first", F.explode(F.sequence(start, end)).alias("block_no")).select(
        "term", "block_no", (F.col("_first") + F.col("block_no")).alias("block_index"))
    return owned.join(block_meta, "block_index").select(
        "term", "block_no", "n_bytes", "last_doc_id", "offset", "block_index")
