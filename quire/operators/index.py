"""Building postings: term frequencies, document lengths, merge, stats.

Stored form of an index = flat posting rows ``(term, doc_id, tf)``, never one
array per term: a term found in every document would otherwise become a single
row the size of the corpus.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import POSTINGS_PER_BLOCK
from ..functions.batches import count_lists, count_tokens
from ..functions.text import token_count, token_text, tokenize
from .ranges import tasks


def with_tokens(docs: DataFrame) -> DataFrame:
    """``doc_id, tokens`` (ARRAY<STRING>), and other columns than the text."""
    return docs.select(*[c for c in docs.columns if c != "text"], tokenize("text").alias("tokens"))


def invalid_documents(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split documents into ``(good, rejects)``: a NULL or negative id cannot
    be indexed and is rejected as ``(doc_id, reason)``. A NULL text is a
    document without tokens, not a reject."""
    reason = (F.when(F.col("doc_id").isNull(), F.lit("doc id is null"))
              .when(F.col("doc_id") < 0, F.lit("negative doc id")))
    return (docs.where("doc_id >= 0"),
            docs.where("doc_id is null or doc_id < 0").select("doc_id", reason.alias("reason")))


def term_frequencies(docs: DataFrame, partitions: int | None = None, lists: bool = False) -> DataFrame:
    """One posting per (term, doc): ``term, doc_id, tf`` (BIGINT), and any
    other column of the documents (a shard).

    ``lists``: the same postings as stretches of lists, ``term, n, doc_ids,
    tfs`` (BINARY, ``n`` numbers of 8 bytes, doc ids ascending; a term has some
    rows for each task). Far fewer rows are written and cross the network, which
    ``layout.posting_gaps`` reads.

    Rows with a NULL or negative id have no postings
    (:func:`invalid_documents` lists them).
    Documents are hash-partitioned and ordered by doc_id, so the count needs
    no posting shuffle and no table of a task's postings: a task counts
    document after document. ``partitions`` sets the number of tasks.
    """
    # Spread the documents by doc_id: the text is about a third of the bytes
    # of the postings it yields, and once every task holds whole documents
    # the count finishes map-side, so postings cross the network only where
    # a consumer groups them by term. (Back-to-back repartitions on the same
    # key collapse into one.) Rows of equal doc ids count as one document.
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    dealt = docs.where("doc_id >= 0").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", *others)
    dealt = dealt.repartition(partitions, "doc_id") if partitions else dealt.repartition("doc_id")
    ordered = dealt.sortWithinPartitions("doc_id", *others)
    if lists:
        if others:
            raise ValueError(f"lists keep no other columns: {others}")
        return ordered.mapInArrow(count_lists, "term string, n int, doc_ids binary, tfs binary")
    tokens = ordered.select("doc_id", token_text("text").alias("tokens"), *others)
    kinds = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in others)
    return tokens.mapInArrow(count_tokens, f"term string, doc_id bigint, tf bigint{kinds}")


def doc_lengths(docs: DataFrame) -> DataFrame:
    """Page table ``doc_id, n_tokens``: every document, zero-token ones too."""
    return docs.select("doc_id", token_count("text").alias("n_tokens"))


def doc_freq(postings: DataFrame) -> DataFrame:
    """``term, doc_freq``: number of postings per term (partial aggregation
    first, so a hot term costs one row per task before the shuffle)."""
    return postings.groupBy("term").agg(F.count(F.lit(1)).alias("doc_freq"))


def merge_indexes(*partials: DataFrame) -> DataFrame:
    """Merge partial indexes given as posting rows: the bag union is the
    merge; order comes from the consumers (blocks, export) sorting by doc id,
    so the order of the partial indexes never matters."""
    cols = ["term", "doc_id", "tf"]
    return reduce(lambda a, b: a.unionByName(b), [p.select(*cols) for p in partials])


def validate_postings(postings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split posting rows into ``(good, rejects)``.

    Copies of a (term, doc_id) pair that agree (a run merged twice) are
    reported and one of them is kept; copies with different tfs cannot be
    told apart and are all rejected, as are NULL terms and NULL or negative
    doc ids and tfs.
    The check is one aggregation on (term, doc_id), whose groups hold at most
    a handful of rows. ``postings`` should be written already: they are counted
    and dealt to tasks of a bounded number of rows first, since the tables of
    an aggregation hold every pair of a task.
    """
    dealt = postings.select("term", "doc_id", "tf").repartition(tasks(postings.count(), postings.sparkSession), "term", "doc_id")
    counted = dealt.groupBy("term", "doc_id").agg(
        F.count(F.lit(1)).alias("_n"), F.max("tf").alias("tf"), F.min("tf").alias("_min_tf"),
        F.count("tf").alias("_tfs"))
    bad = (F.when(F.col("term").isNull() | F.col("doc_id").isNull() | (F.col("_tfs") < F.col("_n")),
                  F.lit("no term, doc id or tf"))
           .when((F.col("doc_id") < 0) | (F.col("_min_tf") < 0), F.lit("negative doc id or tf"))
           .when(F.col("tf") != F.col("_min_tf"),
                 F.concat(F.lit("copies with tf "), F.col("_min_tf").cast("string"), F.lit(" to "), F.col("tf").cast("string"))))
    copies = F.when(F.col("_n") > 1, F.concat(F.lit("duplicate posting x"), F.col("_n").cast("string")))
    staged = counted.withColumn("_bad", bad).withColumn("reason", F.coalesce("_bad", copies))
    good = staged.where(F.col("_bad").isNull()).select("term", "doc_id", "tf")
    rejects = staged.where(F.col("reason").isNotNull()).select("term", "doc_id", "reason")
    return good, rejects


def index_stats(docs: DataFrame, postings: DataFrame, block_size: int = POSTINGS_PER_BLOCK) -> DataFrame:
    """One row: documents, tokens, postings, terms, blocks.

    All from the document frequencies (one row a term): a list of n postings
    has ceil(n / block_size) blocks, so no block is built to be counted.
    ``n_terms`` is an exact distinct count, not an approximation.
    """
    per_doc = docs.agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.coalesce(F.sum(token_count("text")), F.lit(0)).cast("bigint").alias("n_tokens"))
    per_term = doc_freq(postings).agg(
        F.coalesce(F.sum("doc_freq"), F.lit(0)).cast("bigint").alias("n_postings"),
        F.count(F.lit(1)).alias("n_terms"),
        F.coalesce(F.sum(F.ceil(F.col("doc_freq") / block_size)), F.lit(0)).cast("bigint").alias("n_blocks"))
    # Each part is one row; stack them and fold into one row (no join).
    names = ["n_docs", "n_tokens", "n_postings", "n_terms", "n_blocks"]
    return per_doc.unionByName(per_term, allowMissingColumns=True).agg(*[F.max(n).alias(n) for n in names])
