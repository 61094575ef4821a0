"""Global running sums (byte offsets) over a total order, and the lexicon.

``sum(x) OVER (ORDER BY k)`` without PARTITION BY would move every row into
one task. Instead, two phases:

1. range-partition on the order keys, sort each partition and tag each row
   with its partition number and the running sum inside it; write it, so that
   the numbers are pinned (a retried or re-planned range exchange could sample
   other bounds and renumber rows);
2. total per partition (one row per partition, so broadcasting it is safe
   by construction), cumulate the totals, and add each partition's base.

The keyed rows move once (range exchange) and are written twice, so callers
pass keys and values only, never payloads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.batches import running_sums
from ..session import pin


def global_running_sum(df: DataFrame, order_cols: list[str], value_col: str | list[str],
                       out_col: str | list[str], num_partitions: int | None = None,
                       exclusive: bool = True) -> DataFrame:
    """Add ``out_col`` = sum of ``value_col`` over all rows ordered before
    this one by ``order_cols`` (``exclusive=True``), or up to and including
    it. Several value/out column pairs may be given as lists. Order keys
    must be unique."""
    values = [value_col] if isinstance(value_col, str) else list(value_col)
    outs = [out_col] if isinstance(out_col, str) else list(out_col)
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Written first: a range exchange samples its input, and would compute it twice.
    ranged = (pin(df).repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
              .withColumn("_part", F.spark_partition_id()))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema)
    running = ", ".join(f"_up_to{i} bigint" for i in range(len(values)))
    ranged = pin(ranged.mapInArrow(lambda batches: running_sums(batches, values), f"{kinds}, {running}"))
    totals = ranged.groupBy("_part").agg(*[F.sum(v).alias(f"_total{i}") for i, v in enumerate(values)])
    # One row per range partition: the window below is tiny by construction,
    # and so is the broadcast of its result.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("_part", *[F.sum(f"_total{i}").over(before).alias(f"_base{i}")
                                     for i in range(len(values))])
    out = ranged.join(F.broadcast(bases), "_part")
    for i, (v, o) in enumerate(zip(values, outs)):
        inside = F.col(f"_up_to{i}")
        if exclusive:
            inside = inside - F.coalesce(F.col(v), F.lit(0))
        out = out.withColumn(o, (F.coalesce(F.col(f"_base{i}"), F.lit(0)) + inside).cast("bigint"))
    return out.drop("_part", *[f"{c}{i}" for c in ("_base", "_up_to") for i in range(len(values))])


def block_offsets(blocks: DataFrame) -> DataFrame:
    """``term, block_no, n_postings, n_bytes, last_doc_id, offset``: byte
    offset of every block in one concatenated index, blocks in (term,
    block_no) order. Metadata only: payloads stay where they are."""
    meta = blocks.select("term", "block_no", "n_postings", "n_bytes", "last_doc_id")
    return global_running_sum(meta, ["term", "block_no"], "n_bytes", "offset")


def lexicon(blocks: DataFrame) -> DataFrame:
    """``term, offset, length, doc_freq``: where each list starts in the
    concatenated index, its byte length and its number of postings. The
    running sum runs over the per-term totals, one row per term."""
    per_term = blocks.groupBy("term").agg(
        F.sum("n_bytes").cast("bigint").alias("length"),
        F.sum("n_postings").cast("bigint").alias("doc_freq"))
    return global_running_sum(per_term, ["term"], "length", "offset").select(
        "term", "offset", "length", "doc_freq")
