import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from quire.llm import op4_language_id as op

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType())])


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_held_out_accuracy(spark, sf):
    d = f"/root/testdata/{sf}"
    got = {r["doc_id"]: r for r in op.query(spark, d).collect()}
    rows = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang").collect()
    assert len(got) == len(rows)
    right = [got[i]["lang_pred"] == v for i, v in rows if got[i]["held_out"]]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _ in rows)
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert np.mean(right) > 0.97


def test_folded_matrix_is_the_kernel_machine():
    rng = np.random.default_rng(1)
    texts = ["".join(rng.choice(list(a), 80)) for a in ("abc ", "bcd ", "xyz ") for _ in range(10)]
    langs = ["p"] * 10 + ["q"] * 10 + ["r"] * 10
    presence = np.zeros((30, 1 << op.PLACES_LOG2), np.uint8)
    for k, t in enumerate(texts):
        presence[k, op.places(t)] = 1
    order = np.argsort(np.tile(np.arange(10), 3), kind="stable")
    m = op.fit([np.packbits(presence[k]).tobytes() for k in order], [langs[k] for k in order], landmarks=12)
    new = ["abcabcab a", "xyz zyx", "ddbbcc dd"]
    # the same through explicit kernel values against the landmarks
    sets = [set(op.places(t)) for t in texts]
    k = np.array([[len(set(op.places(n)) & sets[j]) / np.sqrt(len(set(op.places(n))) * len(sets[j])) for j in order[:12]] for n in new])
    z = presence[order[:12]].astype(float)
    z /= np.sqrt(z.sum(1))[:, None]
    w, *_ = np.linalg.lstsq(z.T, m.matrix.astype(float), rcond=None)   # matrix = z.T @ w
    assert np.allclose(k @ w, m.scores(new), atol=1e-4)
    assert [m.langs[i] for i in (m.scores(new) + m.bias).argmax(1)] == ["p", "r", "q"]


def test_places_are_the_ngrams():
    text = "AbÉ1"
    raw = text.lower().encode()
    want = set()
    for n in range(1, 5):
        for i in range(len(raw) - n + 1):
            key = (int.from_bytes(raw[i:i + n], "big") ^ (n * 0x3C6EF372 & 0xFFFFFFFF)) * 2654435761 % (1 << 32)
            want.add(key >> 16)
    assert set(op.places(text).tolist()) == want


def test_edge_cases(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "12 !?", "en"), (4, "hello there the world", "en"), (4, "hello there the world", "en"),
            (None, "le monde est grand", "fr"), (6, "le monde est grand", "fr"), (7, "la vie est belle", "fr"), (8, "x", None),
            (9, "the long story " * 30000, "en"), (10, "½ ² ③ 7", None), (11, "日", None)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as id", "2 as h", "3 as r", "4 as score", "5 as `a.b`")
    got = op.identify(df, op.learn(df)).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r["lang_pred"] for r in got}
    assert by[1] == by[2] == by[3] == by[10] == "und" != by[11] and by[4] == by[9] == "en" and by[7] == by[None] == "fr"
    assert Counter(r["lang_pred"] for r in op.identify(df, op.learn(df.limit(0))).collect()) == {"und": len(rows)}
    assert op.identify(df.limit(0), op.learn(df)).collect() == []


def test_any_number_of_languages(spark):
    """250 languages of their own letters are all learnt and told apart."""
    rows = [(k, " ".join([chr(0x4E00 + lang) * (2 + (k + j) % 3) for j in range(6)]), f"l{lang:03d}") for lang in range(250) for k in
            range(lang * 8, lang * 8 + 8)]
    df = spark.createDataFrame(rows, SCHEMA)
    model = op.learn(df)
    assert len(model.langs) == 250
    got = {r["doc_id"]: r["lang_pred"] for r in op.identify(df, model).collect()}
    assert np.mean([got[i] == v for i, _, v in rows]) > 0.95
