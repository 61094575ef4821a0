import math
import re
from collections import Counter

import pytest
from pyspark.sql import types as T

from quire.llm import op3_quality_rules as op

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    hit = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i:i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit),
            n < 50 or 100 * len(hit) > 50 * n)


def grams(text):
    raw = (text or "").encode()
    return [(int.from_bytes(raw[i:i + 3], "big") * 2654435761 % (1 << 32)) >> (32 - op.SLOTS_LOG2)
            for i in range(len(raw) - 2)]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_brute_force(spark, sf):
    d = f"/root/testdata/{sf}"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    good = {r[0] for r in spark.read.parquet(f"{d}/labels.parquet").where("quality = 1").select("doc_id").collect()}
    raw, target = Counter(), Counter()
    for i, t in rows:
        raw.update(grams(t))
        if i in good:
            target.update(grams(t))
    n, nr, nt = 1 << op.SLOTS_LOG2, sum(raw.values()), sum(target.values())
    got = {r["doc_id"]: r for r in op.query(spark, d).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        r = got[i]
        base = brute_counts(t)
        assert tuple(r[1:7]) == base
        g = grams(t)
        score = sum(math.log((target[x] + 1) / (nt + n)) - math.log((raw[x] + 1) / (nr + n)) for x in g) / max(1, len(g))
        assert r["score"] == pytest.approx(score, abs=1e-9)
        assert r["kept"] == (not base[-1] and score >= op.THRESHOLD)


def test_labels_agree(spark):
    d = "/root/testdata/sf0.01"
    got = op.query(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("not base_failed")
    assert got.where("quality = 1 and not kept").count() == 0
    assert got.where("quality = 0 and kept").count() == 0


def test_edge_cases(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(1, None), (2, ""), (3, text), (3, text), (None, text), (4, "a b\n\na b\n \n \na b"), (5, "x y z " * 5000),
            (6, "é|<> " * 60), (7, "w w " * 60)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as score", "2 as slot", "3 as _label")
    labels = spark.createDataFrame([(3, 1), (3, 1), (None, 1), (9, 0)], "doc_id long, quality int")
    weights = op.ratio_weights(op.trusted_flag(df, labels), "text", "trusted")
    got = op.quality_rules(df, weights).collect()
    assert len(got) == len(rows)
    for r, (i, t) in zip(sorted(got, key=lambda r: str(r["doc_id"])), sorted(rows, key=lambda r: str(r[0]))):
        assert tuple(r[1:7]) == brute_counts(t)
    assert {r["doc_id"] for r in op.keep_good(df, weights).collect()} == {r["doc_id"] for r in got if r["kept"]}
    assert op.keep_good(df, weights).columns == df.columns
    assert op.quality_rules(df.limit(0), weights).collect() == []
    none = op.ratio_weights(op.trusted_flag(df.limit(0), labels.limit(0)), "text", "trusted")
    assert not none.any()


def test_all_good_labels_are_trusted(spark):
    for n in (60_000, 210_000):                # under and over the rows that are broadcast
        docs = spark.range(n + 5).selectExpr("id as doc_id", "'abc' as text")
        labels = spark.range(n).selectExpr("id as doc_id", "1 as quality")
        flagged = op.trusted_flag(docs, labels)
        assert flagged.count() == n + 5 and flagged.where("trusted").count() == n
