import zlib

import numpy as np
import pytest
from pyspark.sql import types as T

from quire.llm import op8_quality_classifier as op

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_held_out_accuracy(spark, sf):
    d = f"/root/testdata/{sf}"
    got = {r["doc_id"]: r for r in op.query(spark, d).collect()}
    assert len(got) == spark.read.parquet(f"{d}/documents.parquet").count()
    right = total = low = low_right = 0
    for i, q in spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "quality").collect():
        r = got[i]
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        if r["held_out"]:
            total += 1
            right += r["predicted"] == q
            if q == 0:
                low += 1
                low_right += r["predicted"] == 0
    assert right / total > 0.95 and low_right / low > 0.85


def test_equal_to_one_task_fit(spark):
    """The summed normal equations give the least squares solution."""
    d = "/root/testdata/sf0.01"
    described = op.describe(spark.read.parquet(f"{d}/documents.parquet"))
    labels = spark.read.parquet(f"{d}/labels.parquet")
    df = described.join(labels, "doc_id").selectExpr("stats", "cast(quality as double) label")
    model = op.fit(df.repartition(5))
    rows = df.collect()
    f = model.features(np.array([np.frombuffer(r[0], np.float32) for r in rows], float))
    y = np.array([r[1] for r in rows])
    ridge = np.eye(f.shape[1]) * op.RIDGE
    ridge[-1, -1] = 0
    assert np.allclose(model.weights, np.linalg.solve(f.T @ f + ridge, f.T @ y), atol=1e-6)
    assert (np.diff(model.y) >= 0).all()


def test_isotonic():
    assert op.isotonic(np.array([3.0, 1.0, 2.0, 5.0]), np.ones(4)).tolist() == [2, 2, 2, 5]
    assert op.isotonic(np.array([1.0, 0.0]), np.array([1.0, 3.0])).tolist() == [0.25, 0.25]


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "a b " * 50000), (3, "x"), (None, "null id"), (4, "TEXT!! " * 40)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as stats", "2 as label", "3 as _id", "1 as score")
    labels = spark.createDataFrame([(3, 1), (3, 1), (1, None), (None, 1), (4, 0), (99, 1)], "doc_id long, quality int")
    got = op.classify(df, labels).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in op.classify(df, labels.limit(0)).collect()} == {0.5}
    assert op.classify(df.limit(0), labels).collect() == []
