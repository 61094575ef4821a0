"""Lookups: query terms against the lexicon, and ``next_geq`` probes.

``next_geq(term, d)`` = the posting of ``term`` with the smallest doc id
>= d, or (-1, -1). It is a forward as-of join by term, built from a union
and a running ``last(..., ignorenulls)`` window, never from a join that
pairs every probe with every posting of its term.

Skew: probes and postings are dealt together by runs of their (term, id)
order (see ``ranges``), with borders sampled from both sides, so neither a term
present in every document nor a heap of probes on one stretch of a list (past
its end, say) makes a large group. A probe with no answer in its run takes the
first posting of a later run of its term, from a table of one row a run.
Duplicate probes are answered once and joined back (AQE splits a hot key in
that join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import MAX_BROADCAST_ROWS
from ..functions.arrays import first_geq
from ..session import pin
from .bloom import cut_to
from .index import doc_freq
from .layout import block_postings
from .prefix import global_running_sum
from .ranges import Ranges


def _asof_forward(probes: DataFrame, targets: DataFrame, key: str, value_cols: list[str],
                  runs: int | None) -> DataFrame:
    """For distinct probes ``(term, lookup_doc_id)``, the target row of the
    same term with the smallest ``key`` >= lookup_doc_id.

    Returns ``term, lookup_doc_id, hit`` where ``hit`` is a struct of
    ``key`` and ``value_cols`` (NULL when there is none). ``probes`` and the
    result are read several times, so callers pin them.
    """
    hit_struct = F.struct(F.col(key).alias(key), *[F.col(c) for c in value_cols])
    # Only lists some probe asks for take part: cut down before anything is
    # written or ordered. Both sides are written once, for borders and window.
    lists = targets.join(small(probes.select("term").distinct()), "term", "left_semi").select(
        "term", F.col(key).alias("_k"), F.lit(1).alias("_side"), hit_struct.alias("_hit"))
    asked = probes.select("term", F.col("lookup_doc_id").alias("_k"), F.lit(0).alias("_side"),
                          F.lit(None).cast(lists.schema["_hit"].dataType).alias("_hit"))
    both = pin(lists.unionByName(asked))
    ranges = Ranges.of(both, "term", "_k", runs)
    placed = both.withColumn("run", ranges.run("term", "_k"))

    # Inside the probe's own run. Rows go from the largest key down; at an
    # equal key the target comes first, so an exact match counts.
    w = (Window.partitionBy("term", "run").orderBy(F.col("_k").desc(), F.col("_side").desc())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    near = (placed.select("term", "_k", "run", "_side", F.last("_hit", ignorenulls=True).over(w).alias("_hit"))
            .where(F.col("_side") == 0).drop("_side"))

    # Across runs: the first target of the next run of the term that has one.
    firsts = ranges.of_spanning(placed).groupBy("term", "run").agg(F.min("_hit").alias("_first"))
    later = Window.partitionBy("term").orderBy(F.col("run").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = firsts.select("term", "run", F.last("_first", ignorenulls=True).over(later).alias("_later"))
    return ranges.with_carries(near, carried).select(
        "term", F.col("_k").alias("lookup_doc_id"), F.coalesce("_hit", "_later").alias("hit"))


def _with_answers(probes: DataFrame, answers: DataFrame) -> DataFrame:
    """Attach answers of the distinct probes to every probe row."""
    return probes.join(answers, ["term", "lookup_doc_id"], "left")


def next_geq(postings: DataFrame, probes: DataFrame,
             runs: int | None = None) -> DataFrame:
    """``term, lookup_doc_id, doc_id, tf`` for every probe row (repeats and
    extra probe columns kept), (-1, -1) when the term has no posting >= d."""
    distinct = pin(probes.select("term", "lookup_doc_id").distinct())
    ans = _asof_forward(distinct, postings, "doc_id", ["tf"], runs)
    out = _with_answers(probes, ans)
    return out.select(
        *[c for c in probes.columns],
        F.coalesce(F.col("hit.doc_id"), F.lit(-1)).cast("bigint").alias("doc_id"),
        F.coalesce(F.col("hit.tf"), F.lit(-1)).cast("bigint").alias("tf"))


def locate_block(blocks: DataFrame, probes: DataFrame,
                 runs: int | None = None) -> DataFrame:
    """``term, lookup_doc_id, block_no``: the first block of the term whose
    last doc id is >= d (-1 when there is none): the block to decode."""
    distinct = pin(probes.select("term", "lookup_doc_id").distinct())
    ans = _asof_forward(distinct, blocks, "last_doc_id", ["block_no"], runs)
    return _with_answers(probes, ans).select(
        *[c for c in probes.columns],
        F.coalesce(F.col("hit.block_no"), F.lit(-1)).cast("bigint").alias("block_no"))


def next_geq_blocks(blocks: DataFrame, probes: DataFrame, layout: str = "split",
                    runs: int | None = None) -> DataFrame:
    """``next_geq`` on a stored block index: find the one block per probe by
    its last doc id (block metadata only), then decode just that block and
    take its first posting >= d. Blocks no probe needs are never decoded."""
    distinct = pin(probes.select("term", "lookup_doc_id").distinct())
    ans = _asof_forward(distinct, blocks.select("term", "block_no", "last_doc_id"),
                        "last_doc_id", ["block_no"], runs)
    located = pin(ans.select("term", "lookup_doc_id", F.col("hit.block_no").alias("block_no")))
    # Probes past the end of a list have no block: they keep out of the join.
    hits = located.where(F.col("block_no").isNotNull())
    needed = hits.select("term", "block_no").distinct()
    decoded = block_postings(blocks.join(needed, ["term", "block_no"], "left_semi"), layout)
    picked = hits.join(decoded, ["term", "block_no"]).select(
        "term", "lookup_doc_id",
        first_geq(F.col("postings"), F.col("lookup_doc_id")).alias("hit"))
    return _with_answers(probes, picked).select(
        *[c for c in probes.columns],
        F.coalesce(F.col("hit.doc_id"), F.lit(-1)).cast("bigint").alias("doc_id"),
        F.coalesce(F.col("hit.tf"), F.lit(-1)).cast("bigint").alias("tf"))


def query_frame(spark: SparkSession, terms: list[str]) -> DataFrame:
    """``query_pos, term`` from a Python list: taken verbatim (no lower-
    casing), repeats kept."""
    return spark.createDataFrame([(i, t) for i, t in enumerate(terms)],
                                 "query_pos BIGINT, term STRING")


def small(df: DataFrame) -> DataFrame:
    """``df``, to be broadcast if a count finds few rows; else the join
    shuffles."""
    return F.broadcast(df) if _is_small(df) else df


def _is_small(df: DataFrame, bound: int = MAX_BROADCAST_ROWS) -> bool:
    return df.limit(bound + 1).count() <= bound


def lookup_terms(query: DataFrame, lexicon: DataFrame, broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Query terms found in the lexicon, with their lexicon entry. Up to
    ``broadcast_rows`` query rows are broadcast; for more the lexicon goes
    through a Bloom filter of their terms and only what passes is shuffled."""
    if _is_small(query, broadcast_rows):
        return F.broadcast(query).join(lexicon, "term", "inner")
    return query.join(cut_to(lexicon, query, "term"), "term", "inner")


def missing_terms(query: DataFrame, lexicon: DataFrame, broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Query terms absent from the lexicon (reported, then left out).

    The lexicon is first cut down to the query's terms, by a semi join with
    a short query or the Bloom filter of a long one, so the anti join never
    shuffles the whole lexicon."""
    terms = query.select("term").distinct()
    if _is_small(terms, broadcast_rows):
        present = lexicon.select("term").join(F.broadcast(terms), "term", "left_semi")
    else:
        present = cut_to(lexicon.select("term"), terms, "term")
    return query.join(present, "term", "left_anti")


def lists_by_doc_freq(found: DataFrame) -> DataFrame:
    """Rarest list first: ``list_rank`` (from 1) by (doc_freq, term,
    query_pos), by a distributed running count."""
    one = found.withColumn("_one", F.lit(1))
    return global_running_sum(one, ["doc_freq", "term", "query_pos"], "_one", "list_rank", exclusive=False).drop("_one")


def ranked_probes(query: DataFrame, lexicon: DataFrame, doc_id: int) -> DataFrame:
    """``list_rank, query_pos, term, doc_freq, lookup_doc_id`` of the query
    terms that the lexicon has, written once."""
    found = lists_by_doc_freq(lookup_terms(query, lexicon.select("term", "doc_freq")))
    return pin(found.select("list_rank", "query_pos", "term", "doc_freq",
                            F.lit(doc_id).cast("bigint").alias("lookup_doc_id")))


def query_terms(spark: SparkSession, terms: list[str], postings: DataFrame, doc_id: int,
                runs: int | None = None) -> DataFrame:
    """End to end: look the terms up, order the lists rarest first, and
    probe every list at ``doc_id``: ``list_rank, query_pos, term, doc_freq,
    lookup_doc_id, doc_id, tf``. Any number of terms."""
    query = query_frame(spark, terms)
    # Only the query's lists go past this filter, and they are written once:
    # document frequencies and probes both read them.
    lists = pin(postings.join(small(query.select("term").distinct()), "term", "left_semi")
                .select("term", "doc_id", "tf"))
    probes = ranked_probes(query, doc_freq(lists), doc_id)
    return next_geq(lists, probes, runs)
