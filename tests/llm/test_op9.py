from collections import defaultdict

import pytest
from pyspark.sql import types as T

from quire.llm.op9_jaccard_join import jaccard_join, needed_matches, query

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


def shingles(text):
    w = (text or "").encode().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """(class, links) of each row by comparing all pairs that share a shingle."""
    sets = [shingles(t) for _, t in rows]
    where = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            where[x].append(k)
    links = [0] * len(rows)
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k
    for k, s in enumerate(sets):
        near = {m for x in s for m in where[x] if m > k}
        for m in near:
            inter = len(s & sets[m])
            if 5 * inter >= 4 * (len(s) + len(sets[m]) - inter):
                links[k] += 1
                links[m] += 1
                root[find(k)] = find(m)
    least = {}
    for k, (i, _) in enumerate(rows):
        r = find(k)
        least[r] = i if r not in least else min(least[r], i)
    return sorted((i, least[find(k)], links[k]) for k, (i, _) in enumerate(rows))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_brute_force(spark, sf):
    d = f"/root/testdata/{sf}"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in query(spark, d).collect())
    assert got == brute(rows)


def test_blocks_do_not_change_the_result(spark):
    words = [f"w{k}" for k in range(120)]
    rows = [(k, " ".join(words[:k] + ["x"] + words[k + 1:])) for k in range(60)]
    rows += [(100 + k, "lonely text of its own with number %d in it" % k) for k in range(5)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(tuple(r)[:3] for r in jaccard_join(df, bucket_block=7, verify_block=5).collect())
    assert got == brute(rows)


def test_edge_cases(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(1, None), (2, ""), (3, " \n"), (4, text), (4, text), (5, text + " "), (6, "two words"),
            (7, "two words"), (None, text), (8, " ".join(f"v{k}" for k in range(30000)))]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as rid", "2 as comp", "3 as id", "4 as key")
    got = sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in jaccard_join(df).collect()),
                 key=lambda r: (r[0] is None, r[0] or 0))
    assert got == [(1, 1, 0), (2, 2, 0), (3, 3, 0), (4, 4, 3), (4, 4, 3), (5, 4, 3), (6, 6, 1), (7, 6, 1),
                   (8, 8, 0), (None, 4, 3)]
    assert jaccard_join(df.limit(0)).collect() == []


def test_pruning_bound_is_monotonic():
    need = needed_matches(0.8, 1e-6)
    assert list(need.values()) == sorted(need.values()) and 25 <= need[64] <= 45
