"""Writers: posting text, page table, lexicon, block metadata, index table.

Text outputs are globally ordered (range partitioning + sort within each
partition), so the part files read in name order give the sorted file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import FIELD_SEP, LINE_POSTINGS, POSTING_SEP
from ..functions.batches import joined_lines
from ..operators.layout import posting_gaps
from ..operators.ranges import Ranges
from ..session import pin


def posting_lines(postings: DataFrame, chunk_size: int = LINE_POSTINGS) -> DataFrame:
    """``term, chunk, line``: ``term d:tf d:tf ...`` with doc ids ascending.

    A list of more than ``chunk_size`` postings becomes several lines with
    the same term, cut by position in the list (``chunk`` = position div
    ``chunk_size``), so the lines depend on the list alone; readers (ours,
    and a k-way merge of posting files) concatenate lines of equal terms, and
    no line ever has to hold a whole hot list. Each ``d:tf`` is formatted per
    posting in a codegen'd projection and joined where the postings lie after
    their scan; only pieces of lists that span runs move once more.
    """
    placed = postings if "pos" in postings.columns else posting_gaps(postings)
    entries = placed.select(
        "term", "run", "spans", F.call_function("div", F.col("pos"), F.lit(chunk_size).cast("bigint")).alias("chunk"),
        "doc_id", F.concat(F.col("doc_id").cast("string"), F.lit(POSTING_SEP), F.col("tf").cast("string")).alias("p"))

    def pieces(rows: DataFrame) -> DataFrame:
        return rows.select("term", "run", "chunk", "doc_id", "p").mapInArrow(
            lambda batches: joined_lines(batches, FIELD_SEP), "term string, chunk bigint, _first bigint, _text string")

    joined = pieces(entries.where("spans")).groupBy("term", "chunk").agg(
        F.sort_array(F.collect_list(F.struct("_first", "_text"))).alias("_l")).select(
        "term", "chunk", F.array_join(F.col("_l")["_text"], FIELD_SEP).alias("_text"))
    lines = pieces(entries.where("not spans")).select("term", "chunk", "_text").unionByName(joined)
    return lines.select("term", "chunk", F.concat_ws(FIELD_SEP, "term", "_text").alias("line"))


def _even_files(df: DataFrame, keys: list[str], weight: Column, num_files: int | None) -> DataFrame:
    """``df`` in order of a term and a number, in partitions that are even by
    ``weight``: rows differ too much in size (a line holds 1 to 65,536
    postings) for even numbers of rows. The rows are written once first, so
    that sampling them does not compute them twice."""
    n = num_files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pinned = pin(df.withColumn("_weight", weight.cast("bigint")))
    ranges = Ranges.of(pinned, *keys, n, "_weight")
    placed = pinned.withColumn("_run", ranges.run(*keys)).repartitionById(n, F.col("_run"))
    return placed.sortWithinPartitions(*keys).drop("_weight", "_run")


def ordered(df: DataFrame, keys: list[str], num_files: int | None) -> DataFrame:
    """``df`` in the order of ``keys``, written once first: a range exchange
    samples its input, and would compute it twice."""
    n = num_files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pin(df).repartitionByRange(n, *keys).sortWithinPartitions(*keys)


def write_postings_text(postings: DataFrame, path: str, num_files: int | None = None,
                        chunk_size: int = LINE_POSTINGS, mode: str = "overwrite",
                        global_order: bool = True) -> None:
    """Posting text files, terms ascending across and within files.

    ``global_order=False`` writes runs: every file sorted by term (what a
    k-way merge of runs needs), without the sampling pass of a range
    partitioning."""
    lines = posting_lines(postings, chunk_size)
    if global_order:
        lines = _even_files(lines, ["term", "chunk"], F.length("line"), num_files)
    else:
        lines = lines.sortWithinPartitions("term", "chunk")
    lines.select("line").write.mode(mode).option("lineSep", "\n").text(path)


def write_doc_lengths(lengths: DataFrame, path: str, num_files: int | None = None,
                      mode: str = "overwrite") -> None:
    """Page table text: ``docID<TAB>count`` per document, by doc id."""
    rows = ordered(lengths, ["doc_id"], num_files)
    rows.select(F.concat_ws("\t", F.col("doc_id").cast("string"), F.col("n_tokens").cast("string"))
                .alias("value")).write.mode(mode).option("lineSep", "\n").text(path)


def write_lexicon(lex: DataFrame, path: str, num_files: int | None = None,
                  mode: str = "overwrite") -> None:
    """Lexicon text: ``term offset length docFreq``, terms ascending."""
    rows = ordered(lex, ["term"], num_files)
    rows.select(F.concat_ws(FIELD_SEP, "term", F.col("offset").cast("string"),
                            F.col("length").cast("string"), F.col("doc_freq").cast("string"))
                .alias("value")).write.mode(mode).option("lineSep", "\n").text(path)


def write_block_meta(blocks: DataFrame, path: str, num_files: int | None = None,
                     mode: str = "overwrite") -> None:
    """Block metadata text: ``size lastDocID`` in (term, block_no) order."""
    rows = ordered(blocks, ["term", "block_no"], num_files)
    rows.select(F.concat_ws(FIELD_SEP, F.col("n_bytes").cast("string"),
                            F.col("last_doc_id").cast("string")).alias("value")) \
        .write.mode(mode).option("lineSep", "\n").text(path)


def write_index(blocks: DataFrame, path: str, num_files: int | None = None,
                mode: str = "overwrite", global_order: bool = True) -> None:
    """The compressed index as a Parquet block table sorted by
    ``(term, block_no)``: row-group min/max on ``term`` lets a lookup read
    only the row groups that can hold its terms.

    ``global_order=False`` only sorts inside each file — enough for the
    row-group statistics, and no second shuffle of the block table when it
    already arrives in key ranges (as after the offset pass)."""
    if global_order:
        rows = _even_files(blocks, ["term", "block_no"], F.col("n_bytes") + 64, num_files)
    else:
        rows = blocks.sortWithinPartitions("term", "block_no")
    rows.write.mode(mode).parquet(path)
