import tempfile

from pyspark.sql import functions as F

from quire.operators.index import term_frequencies
from quire.sources.collection import to_collection_lines
from quire.streaming.runs import read_run_doc_lengths, read_run_rejects, read_runs, stream_collection_runs

from conftest import rows


def test_runs_from_collection_files_merge_to_full_index(spark, docs_small):
    src = tempfile.mkdtemp(prefix="quire-src-")
    out = tempfile.mkdtemp(prefix="quire-runs-")
    ckpt = tempfile.mkdtemp(prefix="quire-stream-")
    lines = to_collection_lines(docs_small)
    # three collection files (doc ids ending in 0, 1, 2) arrive first, the
    # rest of the collection later
    for i in range(3):
        (lines.where(F.col("value").rlike(f"^[0-9]*{i}\t"))
         .coalesce(1).write.mode("overwrite").text(f"{src}/part{i}"))
    q = stream_collection_runs(spark, f"{src}/*", f"{out}", ckpt, max_files_per_trigger=1)
    q.awaitTermination(300)
    n_runs_before = len(spark.read.parquet(f"{out}/postings").select("batch_id").distinct().collect())
    assert n_runs_before >= 3
    (lines.where(~F.col("value").rlike(r"^[0-9]*[012]\t")).coalesce(1)
     .write.mode("overwrite").text(f"{src}/part3"))
    q = stream_collection_runs(spark, f"{src}/*", f"{out}", ckpt, max_files_per_trigger=1)
    q.awaitTermination(300)
    postings, rejects = read_runs(spark, out)
    assert rejects.count() == 0
    full = term_frequencies(docs_small)
    assert postings.exceptAll(full).count() == 0 and full.exceptAll(postings).count() == 0
    assert read_run_doc_lengths(spark, out).count() == docs_small.count()


def test_document_in_two_runs_is_reported_and_kept(spark):
    src = tempfile.mkdtemp(prefix="quire-src-")
    out = tempfile.mkdtemp(prefix="quire-runs-")
    ckpt = tempfile.mkdtemp(prefix="quire-stream-")
    for i, text in enumerate(["1\tred fox\n-4\tx\n", "1\tred fox\n2\tblue\nno tab\n3\tone\n", "3\tone one\n"]):
        with open(f"{src}/c{i}.tsv", "w") as f:
            f.write(text)
    q = stream_collection_runs(spark, src, out, ckpt, max_files_per_trigger=1)
    q.awaitTermination(300)
    postings, rejects = read_runs(spark, out)
    assert rows(postings) == [("blue", 2, 1), ("fox", 1, 1), ("red", 1, 1)]
    assert sorted((r["term"], r["reason"]) for r in rejects.collect()) == [
        ("fox", "duplicate posting x2"), ("one", "copies with tf 1 to 2"), ("red", "duplicate posting x2")]
    assert rows(read_run_rejects(spark, out)) == [("-4\tx", "negative doc id"), ("no tab", "no tab")]
    assert rows(read_run_doc_lengths(spark, out)) == [(1, 2), (2, 1), (3, 2)]


def test_a_folder_of_part_files_is_a_table(spark, docs_small):
    from quire.plans.catalog import QUERIES
    d = tempfile.mkdtemp(prefix="quire-src-")
    docs_small.withColumn("lang", F.lit("en")).repartition(3).write.parquet(f"{d}/documents.parquet")
    full = term_frequencies(docs_small)
    got = QUERIES["stream_runs"](spark, d)
    assert got.exceptAll(full).count() == 0 and full.exceptAll(got).count() == 0
