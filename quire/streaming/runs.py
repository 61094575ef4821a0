"""Incremental indexing with Structured Streaming: index a growing
collection in runs, merge the runs later.

Each micro-batch of new documents becomes one partial index (a *run*): its
posting rows and its page-table rows, written under ``batch_id=<n>``. A
run's postings need no state across batches (each document lies in one
batch), so the query is stateless and restarts from its checkpoint; a
re-run batch overwrites its own folder, so every run is written exactly
once. The merge of all runs is the ordinary posting-row union plus the
duplicate check (a document indexed in two runs is reported and counted
once; if its copies differ in a tf, those postings are rejected).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.index import invalid_documents, merge_indexes, validate_postings, with_tokens
from ..session import ensure_checkpoint_dir
from ..sources.collection import ensure_parallel, parse_collection_lines

DOC_SCHEMA = "doc_id BIGINT, text STRING"


def _write_run(runs_path: str, from_lines: bool):
    def write(batch: DataFrame, batch_id: int) -> None:
        if from_lines:
            good, rejects = parse_collection_lines(batch)
        else:
            good, bad = invalid_documents(batch)
            rejects = bad.select(F.col("doc_id").cast("string").alias("line"), "reason")
        # A micro-batch of few files is few scan tasks: spread it first.
        tokens = with_tokens(ensure_parallel(good)).persist()
        try:
            postings = (tokens.select("doc_id", F.explode_outer("tokens").alias("term"))
                        .where(F.col("term").isNotNull())
                        .groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf"))
                        .select("term", "doc_id", "tf"))
            postings.write.mode("overwrite").parquet(f"{runs_path}/postings/batch_id={batch_id}")
            (tokens.select("doc_id", F.greatest(F.size("tokens"), F.lit(0)).cast("bigint").alias("n_tokens"))
             .write.mode("overwrite").parquet(f"{runs_path}/doc_lengths/batch_id={batch_id}"))
            rejects.write.mode("overwrite").parquet(f"{runs_path}/rejects/batch_id={batch_id}")
        finally:
            tokens.unpersist()
    return write


def stream_collection_runs(spark: SparkSession, source: str, runs_path: str,
                           checkpoint_location: str | None = None, source_format: str = "collection",
                           max_files_per_trigger: int | None = None,
                           available_now: bool = True,
                           file_filter: str | None = None) -> StreamingQuery:
    """Start a stream that indexes every new file under ``source`` into runs.

    ``source_format='collection'``: text files of ``docID<TAB>passage``
    lines. ``source_format='parquet'``: document tables with ``doc_id`` and
    ``text``. What cannot be indexed (bad lines, NULL or negative ids) is
    written under ``rejects/``. ``available_now`` processes what is there and stops; otherwise
    the query keeps running on the default trigger. ``file_filter`` keeps
    only the files of ``source`` whose name matches that glob.
    """
    if checkpoint_location is None:
        checkpoint_location = f"{ensure_checkpoint_dir(spark)}/streams/{uuid.uuid4().hex}"
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if file_filter:
        reader = reader.option("pathGlobFilter", file_filter)
    if source_format == "collection":
        docs = reader.option("lineSep", "\n").text(source)
    elif source_format == "parquet":
        docs = reader.schema(DOC_SCHEMA).parquet(source).select("doc_id", "text")
    else:
        raise ValueError(f"unknown source format {source_format!r}")
    writer = (docs.writeStream.foreachBatch(_write_run(runs_path, source_format == "collection"))
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def read_runs(spark: SparkSession, runs_path: str) -> tuple[DataFrame, DataFrame]:
    """All runs merged: ``(postings, rejects)`` over every batch so far."""
    runs = spark.read.parquet(f"{runs_path}/postings").select("term", "doc_id", "tf")
    return validate_postings(merge_indexes(runs))


def read_run_doc_lengths(spark: SparkSession, runs_path: str) -> DataFrame:
    """Page table of all runs; a document in several runs has one row."""
    return spark.read.parquet(f"{runs_path}/doc_lengths").groupBy("doc_id").agg(F.max("n_tokens").alias("n_tokens"))


def read_run_rejects(spark: SparkSession, runs_path: str) -> DataFrame:
    """``line, reason`` of everything the runs could not index."""
    return spark.read.parquet(f"{runs_path}/rejects").select("line", "reason")
