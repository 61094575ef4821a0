"""Document sources: the ``docID<TAB>passage`` collection and corpus tables.

Every reader returns the contract ``doc_id BIGINT, text STRING``; the line
readers also return the rejected lines as ``(line, reason)`` so nothing is
dropped silently.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import COLLECTION_SEP
from ..functions.text import parse_doc_id
from ..operators.index import invalid_documents


class Parsed(NamedTuple):
    good: DataFrame
    rejects: DataFrame


def _reason(conditions: list[tuple[Column, str]]) -> Column:
    expr = None
    for cond, text in conditions:
        expr = F.when(cond, F.lit(text)) if expr is None else expr.when(cond, F.lit(text))
    return expr


def parse_collection_lines(lines: DataFrame, line_col: str = "value",
                           on_error: str = "reject") -> Parsed:
    """Split collection lines at the FIRST tab into (doc_id, text).

    Later tabs stay in the passage. A line without a tab, without a leading
    number, or with a negative doc id is a reject; ``on_error='fail'`` raises
    instead.
    """
    # One split per line: [id part, passage] or [line] when there is no tab.
    parts = lines.select(F.col(line_col).alias("line"),
                         F.split(F.col(line_col), COLLECTION_SEP, 2).alias("_parts"))
    has_tab = F.size("_parts") == 2
    doc_id = parse_doc_id(F.get("_parts", 0))
    staged = parts.select(
        "line",
        F.when(has_tab, doc_id).alias("doc_id"),
        F.when(has_tab, F.get("_parts", 1)).alias("text"),
        _reason([
            (~has_tab, "no tab"),
            (doc_id.isNull(), "doc id not a number"),
            (doc_id < 0, "negative doc id"),
        ]).alias("reason"),
    )
    if on_error == "fail":
        staged = staged.withColumn(
            "reason",
            F.when(F.col("reason").isNull(), F.col("reason")).otherwise(
                F.raise_error(F.concat(F.lit("bad collection line: "), F.col("reason"))).cast("string")),
        )
    good = staged.where(F.col("reason").isNull()).select("doc_id", "text")
    rejects = staged.where(F.col("reason").isNotNull()).select("line", "reason")
    return Parsed(good, rejects)


def read_collection(spark: SparkSession, path: str, on_error: str = "reject") -> Parsed:
    """Read a ``docID<TAB>passage`` text collection (file, glob or folder).

    Lines end at ``\\n`` only: a lone ``\\r`` stays inside the passage, where
    the tokenizer treats it as a separator. Text files split across tasks by
    ``spark.sql.files.maxPartitionBytes``.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    return parse_collection_lines(lines, "value", on_error)


def ensure_parallel(df: DataFrame, key: str = "doc_id", min_partitions: int | None = None) -> DataFrame:
    """Hash-spread ``df`` by ``key`` when its scan yields fewer partitions
    than the cluster has cores (a single-row-group file is one task).

    Large inputs already split into many scan tasks and are left alone, so
    this never shuffles a big corpus. Hashing on the key (not round robin)
    keeps the spread deterministic when a task is retried.
    """
    spark = df.sparkSession
    target = min_partitions or spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target, key)
    return df


def read_corpus(spark: SparkSession, path: str, id_col: str = "doc_id",
                text_col: str = "text") -> Parsed:
    """Read a document table (Parquet) into the collection contract; rows
    with a NULL or negative id are the rejects, ``(doc_id, reason)``.

    Only the two needed columns reach the scan (column pruning).
    """
    df = spark.read.parquet(path).select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    good, rejects = invalid_documents(df)
    return Parsed(ensure_parallel(good), rejects)


def to_collection_lines(docs: DataFrame) -> DataFrame:
    """Render documents as collection lines (``value``): doc id, a tab, and the
    passage with line breaks and tabs replaced by blanks (both separate
    tokens anyway, so the index is unchanged). A NULL text is an empty
    passage, so its document stays."""
    return docs.select(F.concat(
        F.col("doc_id").cast("string"), F.lit(COLLECTION_SEP),
        F.coalesce(F.translate("text", "\t\n", "  "), F.lit(""))).alias("value"))
