from collections import Counter

import pytest
from pyspark.sql import types as T

import corpus_pipeline as cp
from quire.llm import op10_best_fit_packing as pack
from test_op1 import brute as brute_suffix
from test_op3 import brute_counts
from test_op5 import brute as brute_mix
from test_op5 import hash_table
from test_op9 import brute as brute_join
from test_op10 import check as check_packing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """Rows that each stage was given and returned."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, out = docs.columns, []
    for name, stage in cp.STAGES[:-1]:
        got = cp.scratch(stage(spark, docs, SF))
        assert got.columns == columns
        out.append((docs.collect(), got.collect()))
        docs = got
    out.append((docs.collect(), cp.STAGES[-1][1](spark, docs, SF).collect()))
    return out


def test_quality_keeps_clean_documents(spark, steps):
    before, after = steps[0]
    kept = {r["doc_id"] for r in after}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for r in before:
        failed = brute_counts(r["text"])[-1]
        if failed or labels.get(r["doc_id"]) == 0:
            assert r["doc_id"] not in kept
        elif labels.get(r["doc_id"]) == 1:
            assert r["doc_id"] in kept


def test_one_document_of_each_class_stays(steps):
    before, after = steps[1]
    want = {c for _, c, _ in brute_join([(r["doc_id"], r["text"]) for r in before])}
    assert sorted(r["doc_id"] for r in after) == sorted(want)


def test_repeated_passages_go(steps):
    before, after = steps[2]
    want = {r[0]: (r[1], r[2]) for r in brute_suffix([(r["doc_id"], r["text"]) for r in before])}
    for r in after:
        n, gone = want[r["doc_id"]]
        assert n - gone - 6 <= len(r["text"].encode()) <= n - gone and r["n_chars"] == len(r["text"])
    assert len(after) == len(before)
    # what is left holds no 50-byte string twice, but for strings that removal has joined
    rows = {r["doc_id"]: r for r in before}
    assert all(r["source"] == rows[r["doc_id"]]["source"] and r["lang"] == rows[r["doc_id"]]["lang"] for r in after)


def test_mixing(spark, steps):
    before, after = steps[3]
    rows = [(r["doc_id"], r["text"], r["source"]) for r in before]
    times, _ = brute_mix(rows, hash_table(spark, [r[0] for r in rows]))
    seen = Counter(r["doc_id"] for r in after)
    assert sum(abs(seen[i] - t) for (i, _, _), t in zip(rows, times)) <= 1


def test_packing(steps):
    before, after = steps[4]
    check_packing([(r["doc_id"], r["text"]) for r in before], after)


def test_run(spark, steps):
    got = cp.run(spark, SF)
    assert got.count() == len(steps[4][1])


def test_stages_on_odd_rows(spark):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                           T.StructField("n_chars", T.LongType()), T.StructField("place", T.IntegerType()),
                           T.StructField("_id", T.StringType())])
    text = " ".join(f"word{k}" for k in range(80))
    rows = [(1, text, "en", "a", 5, 1, None), (1, text, "en", "a", 5, 1, None), (2, text, None, None, None, None, "x"),
            (None, text, "en", "a", 5, 1, None), (3, None, "en", "a", 0, 1, None), (4, "", "en", "b", 0, 1, None),
            (5, text + " é" * 60, "en", "b", 0, 1, None)]
    for empty in (False, True):
        docs = spark.createDataFrame(rows, schema)
        docs = docs.limit(0) if empty else docs
        for name, stage in cp.STAGES:
            out = cp.scratch(stage(spark, docs, SF))
            if name != "best_fit_packing":
                assert out.columns == docs.columns
            docs = out
        assert (docs.count() == 0) == empty
    assert pack.CAPACITY == 4096


def test_rows_of_one_id_are_decided_apart(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(80)) for x in "abc")
    rows = [(1, a), (2, a), (2, b), (3, c), (3, c + " more"), (3, b + " end"), (4, ""), (4, c), (4, ""), (5, b), (None, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in cp.near_duplicates(spark, docs, SF).collect()]
    assert len(got) == 6 and [r for r in got if r[0] == 3] in ([(3, c)], [(3, c + " more")])
    assert sorted(map(str, got)) == sorted(map(str, [(1, a), (2, b), (4, ""), (4, ""), (None, a)] + [r for r in got if r[0] == 3]))
