import hashlib

import numpy as np
import pytest
from pyspark.sql import types as T

from quire.llm import op6_fingerprints as op

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


def shingles(text):
    w = text.encode().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(rows):
    """(id, text, edited text, next text) by the definition."""
    order = sorted([(i, t or "") for i, t in rows if i is not None], key=lambda r: (-r[0], r[1]))
    out = [(i, t, t, t) for i, t in ((None, t or "") for i, t in rows if i is None)]
    out += [(i, t, None, order[(k + 1) % len(order)][1]) for k, (i, t) in enumerate(order)]
    return [(i, t, t[:len(t) - len(t) // 2] + n[:len(t) // 2], n) for i, t, _, n in out]


def check(rows, got, exact=False):
    want = edited(rows)
    assert len(got) == len(want)
    key = lambda r: (str(r[0]), r[1], str(r[2]))
    have = sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"], r) for r in got), key=key)
    need = sorted(((i, len(t), hashlib.sha256(e.encode()).hexdigest(), t, e, n) for i, t, e, n in want), key=key)
    errors = []
    for h, w in zip(have, need):
        assert h[:3] == w[:3]
        r, t, e, n = h[3], *w[3:]
        a, b, c = (op.sketch(x.encode()) for x in (t, e, n))
        assert r["fingerprint"] == op.to_text(a) and r["edited_fingerprint"] == op.to_text(b)
        assert r["near_edited"] == op.resemblance(a, b) and r["near_next"] == op.resemblance(a, c)
        errors.append(r["near_edited"] - jaccard(t, e))
    return errors


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_brute_force(spark, sf):
    d = f"/root/testdata/{sf}"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    errors = np.abs(check(rows, op.query(spark, d).collect()))
    assert errors.mean() < 0.03 and errors.max() < 0.25


def test_sketch_is_the_smallest_hashes_and_merges():
    text = " ".join(f"w{k % 700}" for k in range(3000))
    all_hashes = np.unique(op.shingle_hashes(op.word_hashes(text.encode())) >> np.uint64(16))
    a = op.sketch(text.encode())
    assert (a == all_hashes[:op.K]).all()
    assert (op.from_text(op.to_text(a)) == a).all()
    words = text.split()
    left, right = " ".join(words[:1500]), " ".join(words[1496:])
    assert (op.merge(op.sketch(left.encode()), op.sketch(right.encode())) == a).all()
    assert abs(op.distinct(a) / len(all_hashes) - 1) < 0.3
    short = op.sketch(b"a b c d e f")
    assert op.containment(short, op.sketch(b"x a b c d e f")) == 1.0
    assert op.bottom(np.array([5] * 1000 + [7, 1], np.uint64), 2).tolist() == [1, 5]


def test_merge_operator(spark):
    rows = [(k, f"common words of all the documents and number {k}") for k in range(40)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    prints = op.fingerprints(df).selectExpr("id % 2 as part", "fingerprint")
    got = {r["key"]: r["fingerprint"] for r in op.merge_fingerprints(prints, "part").collect()}
    for part in (0, 1):
        want = np.zeros(0, np.uint64)
        for k, t in rows:
            if k % 2 == part:
                want = op.merge(want, op.sketch(t.encode()))
        assert got[part] == op.to_text(want)


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "é"), (3, "a b"), (3, "a b"), (None, "x y z"), (None, None), (9, "long " * 40000), (-4, "tail text")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as bucket", "2 as role", "3 as id")
    check(rows, op.edited_fingerprints(df).collect())
    assert op.edited_fingerprints(df.limit(0)).collect() == []
    check(rows[:1], op.edited_fingerprints(spark.createDataFrame(rows[:1], SCHEMA)).collect())
