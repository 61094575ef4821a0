import pytest
from pyspark.sql import functions as F

from quire.operators.index import term_frequencies
from quire.plans import incremental as inc

from conftest import rows


def _modified(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def test_three_runs_give_the_whole_index(spark, docs_small, tmp_path):
    tf = term_frequencies(docs_small)
    path = str(tmp_path / "i")
    assert inc.create(tf.where("doc_id < 100"), path, ranges=10).count() == 0
    for low, high in ((100, 150), (150, 10 ** 9)):
        assert inc.merge_run(spark, path, tf.where(f"doc_id >= {low} and doc_id < {high}")).count() == 0
    assert rows(inc.open_postings(spark, path)) == rows(tf)
    last, current = inc.manifest(spark, path)
    assert last == 2 and set(current.values()) <= {0, 1, 2} and len(current) == 10
    with pytest.raises(ValueError):
        inc.create(tf, path)


def test_untouched_ranges_are_not_rewritten(spark, docs_small, tmp_path):
    tf = term_frequencies(docs_small)
    path = tmp_path / "i"
    inc.create(tf, str(path), ranges=12)
    before, (_, old) = _modified(path), inc.manifest(spark, str(path))
    run = spark.createDataFrame([("zzzz", 10 ** 6 + k, 1) for k in range(50)], "term STRING, doc_id BIGINT, tf BIGINT")
    inc.merge_run(spark, str(path), run)
    after, (last, new) = _modified(path), inc.manifest(spark, str(path))
    assert all(after[f] == t for f, t in before.items())
    assert [r for r in new if new[r] != old[r]] == [11] and new[11] == last == 1
    written = [f for f in after if f not in before and f.startswith("postings")]
    assert written and all("rng=11" in f for f in written)
    assert inc.unused(spark, str(path)) == [(0, 11)]
    assert inc.open_postings(spark, str(path)).count() == tf.count() + 50


def test_a_hot_term_grows_at_its_end(spark, tmp_path):
    """A term of every document has several ranges; a run of later documents
    rewrites the last of them."""
    tf = spark.range(5000).select(F.lit("the").alias("term"), F.col("id").alias("doc_id"), F.lit(1).cast("bigint").alias("tf"))
    inc.create(tf, str(tmp_path / "i"), ranges=8)
    inc.merge_run(spark, str(tmp_path / "i"), tf.withColumn("doc_id", F.col("doc_id") + 5000))
    _, current = inc.manifest(spark, str(tmp_path / "i"))
    assert [g for _, g in sorted(current.items())] == [0] * 7 + [1]


def test_overlapping_runs_are_checked(spark, tmp_path):
    kind = "term STRING, doc_id BIGINT, tf BIGINT"
    path = str(tmp_path / "i")
    inc.create(spark.createDataFrame([("a", 1, 1), ("a", 2, 5), ("b", 1, 1)], kind), path, ranges=2)
    rejects = inc.merge_run(spark, path, spark.createDataFrame([("a", 1, 1), ("a", 2, 6), ("c", -1, 1), ("c", 4, 2)], kind))
    assert sorted((r["term"], r["doc_id"], r["reason"]) for r in rejects.collect()) == [
        ("a", 1, "duplicate posting x2"), ("a", 2, "copies with tf 5 to 6"), ("c", -1, "negative doc id or tf")]
    assert rows(inc.open_postings(spark, path)) == [("a", 1, 1), ("b", 1, 1), ("c", 4, 2)]
    inc.merge_run(spark, path, spark.createDataFrame([("b", 1, 9), ("c", 4, 3)], kind))      # nothing is left of a range
    assert rows(inc.open_postings(spark, path)) == [("a", 1, 1)]
    inc.merge_run(spark, path, spark.createDataFrame([("b", 1, 1), ("c", 4, 2)], kind))
    inc.merge_run(spark, path, spark.createDataFrame([], kind))
    assert inc.open_postings(spark, path).count() == 3


def test_only_documents_of_the_run_are_checked_again(spark, tmp_path, monkeypatch):
    """F8: every run checked all postings of its ranges again."""
    kind, path, seen, real = "term STRING, doc_id BIGINT, tf BIGINT", str(tmp_path / "i"), [], inc.idx.validate_postings
    monkeypatch.setattr(inc.idx, "validate_postings", lambda p: (seen.append(p.count()), real(p))[1])
    inc.create(spark.createDataFrame([(t, d, 1) for t in "abcd" for d in range(50)], kind), path, ranges=4)
    inc.merge_run(spark, path, spark.createDataFrame([(t, d, 1) for t in "abcd" for d in range(50, 60)], kind))
    again = inc.merge_run(spark, path, spark.createDataFrame([(t, d, 2) for t in "abcde" for d in (3, 70)], kind))
    assert seen == [200, 40, 14]
    assert sorted(tuple(r) for r in again.collect()) == [(t, 3, "copies with tf 1 to 2") for t in "abcd"]
    assert inc.open_postings(spark, path).count() == 200 + 40 - 4 + 6
    assert [r[0] for r in inc.open_postings(spark, path).where("doc_id = 3").collect()] == ["e"]


def test_few_borders_are_compared_without_python(spark):
    from quire.operators.ranges import Ranges
    words = ["a", "b", "é", "\U0001f600", "\uffee"]
    borders = [("b", 3), ("b", 7), ("é", 0), ("\uffee", 2)]
    table = spark.createDataFrame([(t, k) for t in words for k in (0, 2, 3, 7, 9)], "t STRING, k BIGINT")
    run = Ranges(borders).run("t", "k")
    assert "Arrow" not in table.select(run.alias("r"))._jdf.queryExecution().executedPlan().toString()
    for row in table.select("t", "k", run.alias("r")).collect():
        assert row["r"] == sum((t.encode(), k) <= (row["t"].encode(), row["k"]) for t, k in borders)
