"""Preparation of a training corpus: quality rules, near-duplicate removal,
removal of repeated passages, source mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes what a stage returns and reads it again as the next one's ``docs``. All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import (op1_suffix_dedup, op3_quality_rules, op5_source_mixing, op9_jaccard_join,
                       op10_best_fit_packing)
from quire.llm.common import broadcast_if_small, scratch, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    flagged = op3_quality_rules.trusted_flag(docs, table(spark, sf_dir, "labels"))
    return op3_quality_rules.keep_good(docs, op3_quality_rules.ratio_weights(flagged, "text", "trusted"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each class of
    near-duplicates. Rows with a null id stay. Rows with one id are decided
    apart, by the digests of their texts: of those of one class one stays."""
    found = scratch(op9_jaccard_join.jaccard_join(docs, digests=True).select(
        F.col("doc_id").alias("_id"), F.col("class_id").alias("_class"), (F.col("n_links") > 0).alias("_linked"),
        F.col("rid").alias("_rid"), F.col("root").alias("_root")))
    repeated = scratch(found.where("_id is not null").groupBy("_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("_linked").alias("l")).where("n > 1 and l").select("_id"))
    losers = found.where("_id <> _class").select("_id").union(repeated).distinct()
    kept = docs.join(broadcast_if_small(losers), docs["doc_id"] == losers["_id"], "left_anti")
    if repeated.isEmpty():
        return kept
    small = broadcast_if_small(repeated)
    rows = docs.select(F.col("doc_id").alias("_i"), F.col("text").cast("binary").alias("text"), F.struct("*").alias("_row"))
    rows = op9_jaccard_join.with_digests(rows.join(small, F.col("_i") == F.col("_id"), "left_semi")).drop("text")
    first = found.where("_id = _class").join(small, "_id", "left_semi").select("_id", "_rid", "_root").distinct()
    rows = rows.join(first, (F.col("_i") == F.col("_id")) & F.col("rid").eqNullSafe(F.col("_rid")))
    once = rows.where("_root is not null").dropDuplicates(["_i", "_root"]).unionByName(rows.where("_root is null"))
    return kept.unionByName(once.select("_row.*"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 50-byte strings that a document with a smaller
    id has. A character cut in two goes with its removed part; ``n_chars`` is
    counted anew."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    out = op1_suffix_dedup.suffix_dedup(docs, rest=rest, as_string=True)
    parts = {"doc_id": F.col("id").cast(docs.schema["doc_id"].dataType), "text": F.col("text")}
    out = out.select(*[(parts[c] if c in parts else F.col("rest")[c]).alias(c) for c in docs.columns])
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that the tokens of sources have their weights."""
    return op5_source_mixing.mix(docs).select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences."""
    return op10_best_fit_packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("source_mixing", mixture),
    ("best_fit_packing", packing),
]

#: SQL has no suffix removal, tokenizer or packing; tests/llm compares the
#: stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = scratch(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
