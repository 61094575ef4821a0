import random

import pytest

from quire.llm import op1_suffix_dedup, prefix_doubling
from quire.llm.prefix_doubling import numbered, sizes, suffix_dedup_by_doubling
from test_op1 import SCHEMA, brute


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_lengths_of_the_rounds():
    assert sizes(50) == [13, 25, 50] and sizes(16) == [16] and sizes(100) == [13, 25, 50, 100]


def test_ranks_follow_the_order_of_strings(spark):
    words = [b"b", b"a", b"c", b"b", b"a", b"d", b"d", b"d"]
    got = numbered(spark.createDataFrame([(w,) for w in words], "prefix binary"), ["prefix"]).orderBy("next").collect()
    assert [bytes(r["prefix"]) for r in got] == [b"a", b"b", b"d"]


def test_equals_the_registered_query(spark):
    d = "/root/testdata/sf0.001"
    got = prefix_doubling.query(spark, d)
    want = op1_suffix_dedup.query(spark, d)
    assert got.columns == want.columns
    assert rows_of(got) == rows_of(want)


@pytest.mark.parametrize("segment", [64, 1 << 17])
def test_equals_brute_force(spark, monkeypatch, segment):
    monkeypatch.setattr(prefix_doubling, "SEGMENT", segment)
    rng = random.Random(11)
    pool = ["".join(rng.choice("ab") for _ in range(rng.randint(10, 90))) for _ in range(20)]
    rows = [(k, " ".join(rng.choice(pool) for _ in range(rng.randint(0, 15)))) for k in range(30)]
    rows += [(40, "a" * 400), (41, "a" * 49), (42, "a" * 50), (4, "é" * 30), (4, "é" * 30), (43, None), (44, ""),
             (None, "é" * 30), (None, "x" * 60), (None, "x" * 60), (45, pool[0] * 3)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as id", "2 as row", "3 as pos", "4 as `a.b`")
    assert rows_of(suffix_dedup_by_doubling(df)) == brute(rows)
    assert suffix_dedup_by_doubling(df.limit(0)).collect() == []
