"""Physical layout of posting lists: gaps, blocks of 64, varbyte payloads.

Positions inside a posting list are a segmented scan (see ``ranges``): postings
cross the network once, by runs of the (term, doc id) order, to tasks of a
bounded number of rows; places and doc ids before are found inside a run, and what crosses a border of runs - the number of
postings before it and the last doc id - is carried in a table of one row for
each run that a list spans. A list is never put into one window, however long
it is and whatever the ids look like.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import POSTINGS_PER_BLOCK
from ..functions.arrays import slice0
from ..functions.batches import blocks as block_pieces
from ..functions.batches import decoded, positions
from ..functions.varbyte import varbyte_decode
from ..session import pin
from .ranges import Ranges, tasks


def posting_gaps(postings: DataFrame, block_size: int = POSTINGS_PER_BLOCK, runs: int | None = None, nested: bool = False) -> DataFrame:
    """``term, doc_id, tf, gap, pos, block_no`` for every posting, and where
    it was worked out: ``run``, and ``spans`` if its list has several runs.

    ``gap`` = doc_id minus the previous doc id of the term (the first gap is
    the doc id itself); it runs on across block borders. ``pos`` is the
    0-based position in the list and ``block_no = pos div block_size``.
    Postings are written once and cross the network once. They are rows
    ``term, doc_id, tf`` or the stretches of lists of ``term_frequencies``.

    ``nested``: the same postings with the rows of a block and run in one,
    ``term, block_no, doc_ids, gaps, tfs`` (arrays of at most ``block_size``),
    ``run, spans``: what is built block by block takes far fewer rows.
    """
    lists = "doc_ids" in postings.columns
    given = ["n", "doc_ids", "tfs"] if lists else ["doc_id", "tf"]
    pinned = pin(postings.select("term", *given))
    ranges = Ranges.of(pinned, "term", "doc_ids" if lists else "doc_id", runs, per_partition=1, many="n" if lists else None)
    n = tasks(ranges.rows, postings.sparkSession)
    if nested:
        local = "term string, run int, block_no bigint, doc_ids array<bigint>, gaps array<bigint>, tfs array<bigint>"
    else:
        kind = "bigint" if lists else pinned.schema["tf"].dataType.simpleString()
        local = f"term string, run int, doc_id bigint, tf {kind}, gap bigint, pos bigint"

    def placed_by(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return positions(batches, block_size, nested)

    # Lists that no border lies in are one run each: dealt by term.
    whole = ranges.of_others(pinned).select("term", *given)
    whole = whole.repartitionById(n, F.pmod(F.xxhash64("term"), F.lit(n)).cast("int")).mapInArrow(placed_by, local)
    # Carries: only lists that hold a border have several runs.
    if lists:
        spanning = ranges.spanning_lists(pinned)
        per_run = spanning.groupBy("term", "run").agg(F.sum("n").alias("_n"), F.max("last").alias("_last"))
    else:
        spanning = ranges.spanning_runs(pinned, "term", "doc_id").select("term", "run", "doc_id", "tf")
        per_run = spanning.groupBy("term", "run").agg(F.count(F.lit(1)).alias("_n"), F.max("doc_id").alias("_last"))
    before = Window.partitionBy("term").orderBy("run")
    carried = per_run.select(
        "term", "run", (F.sum("_n").over(before.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n")).alias("_base"),
        F.lag("_last", 1, 0).over(before).alias("_last"))
    zero = F.lit(0).cast("bigint")
    parts = ranges.with_carries(spanning, carried).select(
        "term", "run", *given, F.coalesce("_base", zero).alias("_base"), F.coalesce("_last", zero).alias("_last"))
    parts = parts.repartition(n, "term", "run").mapInArrow(placed_by, local)
    both = whole.withColumn("spans", F.lit(False)).unionByName(parts.withColumn("spans", F.lit(True)))
    if nested:
        return both
    return both.select("term", "doc_id", "tf", "gap", "pos", "run", "spans",
                       F.call_function("div", F.col("pos"), F.lit(block_size).cast("bigint")).alias("block_no"))


def posting_blocks(gaps: DataFrame, with_payload: bool = True, layout: str = "split") -> DataFrame:
    """Block table, one row per ``(term, block_no)``:
    ``n_postings, first_doc_id, last_doc_id, n_bytes`` and, if asked,
    ``payload`` BINARY.

    ``layout='split'``: varbyte of all gaps of the block, then of all tfs.
    ``layout='interleaved'``: doc id, tf alternating, absolute doc ids.

    ``gaps`` are rows of :func:`posting_gaps`, nested or not. They do not cross
    the network again: blocks are assembled per ``(term, run, block_no)`` where
    the postings already lie, in the order that ``posting_gaps`` gave them. Only blocks of lists that span runs may have
    several (binary) pieces, which are joined by ``(term, block_no)``; all
    others are done. Codes are made for the postings of a batch at once;
    metadata-only requests never build payloads.
    """
    if layout not in ("split", "interleaved"):
        raise ValueError(f"unknown layout {layout!r}")
    schema = "term string, block_no bigint, n_postings bigint, first_doc_id bigint, last_doc_id bigint, n_bytes bigint"
    schema += ", _p1 binary, _p2 binary" if with_payload else ""

    nested = "doc_ids" in gaps.columns
    given = ["doc_ids", "gaps", "tfs"] if nested else ["doc_id", "gap", F.col("tf").cast("bigint").alias("tf")]

    def pieces(rows: DataFrame) -> DataFrame:
        return rows.select("term", "run", "block_no", *given).mapInArrow(
            lambda batches: block_pieces(batches, layout, with_payload, nested), schema)
    block_aggs = [
        F.sum("n_postings").cast("bigint").alias("n_postings"),
        F.min("first_doc_id").alias("first_doc_id"),
        F.max("last_doc_id").alias("last_doc_id"),
        F.sum("n_bytes").cast("bigint").alias("n_bytes"),
    ]
    if with_payload:
        block_aggs.append(F.sort_array(F.collect_list(F.struct("first_doc_id", "_p1", "_p2"))).alias("_pieces"))
    whole, parts = pieces(gaps.where("not spans")), pieces(gaps.where("spans"))
    columns = ["term", "block_no", "n_postings", "first_doc_id", "last_doc_id", F.col("n_bytes").cast("bigint").alias("n_bytes")]
    joined = parts.groupBy("term", "block_no").agg(*block_aggs)
    if not with_payload:
        return whole.select(*columns).unionByName(joined)
    empty = F.unhex(F.lit(""))

    def folded(field: str) -> Column:
        # at most 64 pieces (a block has 64 postings), in doc order
        return F.aggregate(F.col("_pieces"), empty, lambda acc, p: F.concat(acc, p[field]))

    joined = joined.withColumn("payload", F.concat(folded("_p1"), folded("_p2"))).drop("_pieces")
    return whole.select(*columns, F.concat("_p1", "_p2").alias("payload")).unionByName(joined)


def block_postings(blocks: DataFrame, layout: str = "split") -> DataFrame:
    """Decode every block back into ``term, block_no, postings``
    (ARRAY<STRUCT<doc_id, tf>>, ascending). Map-only: each block is decoded
    by itself; the first doc id of the block anchors the gap sums."""
    ints = varbyte_decode("payload")
    if layout == "split":
        half = (F.size("_ints") / 2).cast("int")
        gaps = slice0(F.col("_ints"), F.lit(0), half)
        tfs = slice0(F.col("_ints"), half, half)
        base = F.col("first_doc_id") - F.get(gaps, 0)
        docs = F.aggregate(
            gaps,
            F.struct(F.array().cast("array<bigint>").alias("out"), base.alias("cur")),
            lambda acc, g: F.struct(F.array_append(acc["out"], acc["cur"] + g).alias("out"),
                                    (acc["cur"] + g).alias("cur")),
            lambda acc: acc["out"],
        )
        postings = F.zip_with(docs, tfs, lambda d, t: F.struct(d.alias("doc_id"), t.alias("tf")))
    elif layout == "interleaved":
        n = (F.size("_ints") / 2).cast("int")
        postings = F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda i: F.struct(F.get(F.col("_ints"), i * 2).alias("doc_id"),
                               F.get(F.col("_ints"), i * 2 + 1).alias("tf")))
    else:
        raise ValueError(f"unknown layout {layout!r}")
    return (blocks.select("term", "block_no", "first_doc_id", ints.alias("_ints"))
            .select("term", "block_no", postings.alias("postings")))


def decode_blocks(blocks: DataFrame, layout: str = "split") -> DataFrame:
    """Posting rows ``term, doc_id, tf`` from a block table."""
    if layout not in ("split", "interleaved"):
        raise ValueError(f"unknown layout {layout!r}")
    return blocks.select("term", "first_doc_id", "payload").mapInArrow(
        lambda batches: decoded(batches, layout), "term string, doc_id bigint, tf bigint")
