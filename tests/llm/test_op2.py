import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from quire.llm import op2_lm_scoring as op
from quire.llm.gru import Gru

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def brute(rows):
    docs = [(i, [*(t or "").encode().lower().split(), None]) for i, t in rows]
    c = Counter(w for i, d in docs if not held(i) for w in d)
    n, v = sum(c.values()), len(c)
    return sorted(((i, held(i), len(d), sum(c[w] > 0 for w in d), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in d))
                   for i, d in docs), key=str)


def check(rows, got):
    want = brute(rows)
    got = sorted((tuple(r) for r in got), key=str)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9) and g[6] < 0


@pytest.mark.parametrize("sf,head", [("sf0.001", 200), ("sf0.01", 20000), ("sf0.1", 200000)])
def test_base_equals_brute_force_and_model_beats_it(spark, sf, head):
    d = f"/root/testdata/{sf}"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    got = op.lm_score(docs, head=head).collect()
    check([tuple(r) for r in docs.select("doc_id", "text").collect()], got)
    out = got if sf != "sf0.1" else [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_query(spark):
    got = op.query(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    assert got.count() == 200


def test_gradients():
    rng = np.random.default_rng(0)
    net = Gru(11, hidden=3, width=4)
    net.p = {k: v.astype(float) for k, v in net.p.items()}
    for k in ("u", "c", "x", "w"):
        net.p[k] = rng.normal(0, 0.5, net.p[k].shape)
    ids, fresh = rng.integers(0, 11, (4, 2)), np.zeros((4, 2), bool)
    fresh[0, 0] = fresh[2, 1] = True
    before, h = rng.integers(0, 12, (4, 2)), rng.normal(0, 1, (2, 3))
    _, grad, _ = net.loss(ids, before, fresh, h)
    for k, v in net.p.items():
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in v.shape)
            if k == "wb" and v[at] < -1e8:
                continue
            old, e = v[at], 1e-5
            v[at] = old + e
            up = net.loss(ids, before, fresh, h)[0]
            v[at] = old - e
            down = net.loss(ids, before, fresh, h)[0]
            v[at] = old
            assert grad[k][at] == pytest.approx((up - down) / (2 * e), abs=1e-7)


def test_probabilities_sum_to_one_and_state_is_carried():
    net = Gru(10, hidden=4, width=3)
    assert np.exp([net.score([np.array([k])])[0] for k in range(10)]).sum() == pytest.approx(1, abs=1e-5)
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, 10, n) for n in (0, 1, 5, 40, 100, 7)]
    a = net.score(texts, window=1000)
    assert np.allclose(a, net.score(texts, window=3, group=2), atol=1e-3)
    assert a[4] == pytest.approx(sum(net.score([texts[4][:k + 1]])[0] - net.score([texts[4][:k]])[0] for k in range(100)), abs=1e-2)


def test_training_learns_a_cycle():
    net = Gru(6, hidden=8, width=4)
    losses = net.train([np.arange(3000) % 6], streams=8, steps=300)
    assert losses[-1] < 0.2 < losses[0]


def test_spelling_is_a_distribution(spark):
    counts = spark.createDataFrame([(b"the", 3), (b"then", 1), ("é".encode(), 2), (b"", 9)], "word binary, c long")
    p = 10.0 ** op.spelling(counts).astype(float)
    assert np.allclose(p.sum(1), 1, atol=1e-4)


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "The the THE end"), (3, "The the THE end"), (None, "null id É é"), (4, "w " * 30000),
            (5, "\x00a \x1cb \xa0"), (7, "only here")]
    rows += [(k, f"more text number {k}") for k in range(10, 40)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as row", "2 as word", "3 as c", "4 as rest", "5 as id")
    check(rows, op.lm_score(df, head=5, steps=5).collect())
    check(rows, op.lm_score(df, head=100, steps=5).collect())
    assert op.lm_score(df.limit(0), steps=5).collect() == []
    alone = [(i, t) for i, t in rows if held(i)]
    check(alone, op.lm_score(spark.createDataFrame(alone, SCHEMA), steps=5).collect())


def test_all_training_documents_are_trained_on(spark):
    # the start sees 5 documents and 5 steps; only the rounds can learn the order of the words
    words = [f"w{k}" for k in range(20)]
    rows = [(k, " ".join(words[(k + j) % 20] for j in range(1500))) for k in range(700)]
    train = spark.createDataFrame([r for r in rows if not held(r[0])], "id long, text string").repartition(2)
    counts = op.word_counts(train.selectExpr("cast(text as binary) as text")).cache()
    model = op.learn(train.selectExpr("id", "cast(text as binary) as text"), counts, sample_docs=5, steps=5)
    assert model.trained == model.n == 1501 * train.count()
    ids = [op.network_ids(t.encode(), model.id, model.end) for i, t in rows if held(i)]
    assert model.net.score(ids).sum() / sum(map(len, ids)) > 0.9 * math.log(1 / 20)   # better than by word counts


def test_every_token_is_read_once():
    net, seen = Gru(50, hidden=3, width=8), []
    loss = net.loss
    net.loss = lambda ids, before, fresh, h: (seen.extend(ids.ravel().tolist()), loss(ids, before, fresh, h))[1]
    rng = np.random.default_rng(1)
    slices = [[rng.integers(0, 50, n) for n in sizes] for sizes in ((3, 0, 700), (), (5,), (2000, 1, 77), (9,))]
    want = np.concatenate([t for s in slices for t in s])
    assert net.read(slices, 0.01, streams=8, window=6) == len(want) and sorted(seen) == sorted(want.tolist())


def test_rounds_are_averaged_by_tokens(spark):
    docs = spark.createDataFrame([(k, bytearray(b"a b c " * n)) for k, n in enumerate((5, 40, 900, 7, 7, 300))], "id long, text binary")
    counts = op.word_counts(docs.repartition(3)).cache()
    model = op.learn(docs, counts, steps=2, rounds=0)
    start, steps = model.net.state(), model.net.t
    rows = op.encoded(docs, model, 1).cache()
    copies = rows.selectExpr("h", "ids", "explode(sequence(1L, n)) copy").selectExpr(
        "pmod(xxhash64(4, h, ids, copy), 3) shard", "xxhash64(5, h, copy) at", "ids").orderBy("shard", "at", "ids").collect()
    want, total = 0.0, 0
    for shard in {r[0] for r in copies}:
        net = Gru(model.end + 1, op.HIDDEN, op.WIDTH)
        net.set_state(start)
        net.t = steps
        n = net.read([[np.frombuffer(bytes(r[2]), np.int16) for r in copies if r[0] == shard]], 0.01)
        want, total = want + net.state().astype(float) * n, total + n
    assert len({r[0] for r in copies}) > 1
    assert op.train_round(rows.repartition(4), model, 0.01, 3) == total == model.n
    assert np.allclose(model.net.state(), want / total, atol=1e-6)


def test_scores_do_not_depend_on_partitions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = docs.union(docs.limit(3)).union(docs.limit(1))            # repeated rows
    a, b = [sorted((r["doc_id"], r["score"]) for r in op.lm_score(docs.repartition(n), head=100, sample_docs=60, steps=60).collect())
            for n in (1, 5)]
    assert [r[0] for r in a] == [r[0] for r in b]
    assert max(abs(x[1] - y[1]) for x, y in zip(a, b)) < 0.01


def test_slices_are_whole_texts_of_one_shard():
    rows = [(0, 5), (0, 5), (0, 1), (2, 30), (2, 1), (5, 4)]
    batch = op.pa.RecordBatch.from_arrays([op.pa.array([k for k, _ in rows]), op.pa.array([np.zeros(n, np.int16).tobytes() for _, n in rows])],
                                          names=["shard", "ids"])
    want = [(0, [5, 5]), (0, [1]), (2, [30]), (2, [1]), (5, [4])]
    for cut in (1, 2, 6):
        parts = [batch.slice(at, cut) for at in range(0, 6, cut)]
        assert [(k, [len(t) for t in texts]) for k, texts in op.shard_slices(iter(parts), 8)] == want
    assert list(op.shard_slices(iter([]))) == []


def test_words_of_a_group_have_at_most_its_probability(spark):
    rng = np.random.default_rng(4)
    words = sorted({bytes(rng.integers(97, 123, n)) + end for n in (1, 2, 2, 3, 5, 8) * 200 for end in (b"", b".", b",")})
    counts = spark.createDataFrame([(w, int(c)) for w, c in zip(words, rng.integers(1, 9, len(words)))], "word binary, c long")
    train = spark.createDataFrame([(1, bytearray(b" ".join(words)))], "id long, text binary")
    model = op.learn(train, counts, head=len(words), steps=2, rounds=0, sample_docs=1)
    assert len(words) > 2 * len(model.id)
    # every word of one and two bytes, and every known one; the rest only adds what is left of the spelling
    short = {bytes([a]) for a in range(256)} | {bytes([a, b]) for a in range(256) for b in range(256)}
    mass, extra = np.zeros(op.GROUPS), dict(zip(model.place, model.extra))
    for w, x in extra.items():
        if w != op.END and w not in model.id:
            mass[op.group_of(w)] += 10.0 ** x
    new = sorted(w for w in short if w not in extra)
    g = np.array([op.group_of(w) for w in new])
    np.add.at(mass, g, 10.0 ** (model.spell_log10(new, g) + model.left[g]))
    assert (mass <= 1 + 1e-4).all() and mass.max() > 0.3
    rows = 10.0 ** model.spell.astype(float)
    assert np.allclose(rows.sum(1), 1, atol=1e-4)      # each step of a spelling is a distribution


def test_spelling_is_given_the_group(spark):
    words = [b"abcing", b"xyzing", b"w.", b"abced"]
    c, s, first = op._spelling_keys(words, [1, 1, 2, 3])
    assert len(c) == sum(len(w) + 1 for w in words) and first.tolist() == [0, 6, 9, 16]
    spelled = [bytes(s[a:b - 1].astype(np.uint8))[::-1] for a, b in zip(first, [*first[1:], len(s)])]
    assert spelled[::-1] == words and (s[[*first[1:] - 1, -1]] == 256).all()
    assert (c[9:13] == c[16:20]).all()
    alone = op._spelling_keys([b"abcing"], [1])
    other = op._spelling_keys([b"abcing"], [5])
    assert (alone[0][:4] != other[0][:4]).all() and (alone[0][4:] == other[0][4:]).all()


def test_start_is_not_cut():
    assert op.STEPS >= 600


def test_texts_are_looked_up_together_as_each_alone():
    """Rare words of a batch's texts are spelled at once; the same scores."""
    head = [(b"the", 9), (b"end", 4), (b"", 3)]
    model = op.Model(head, np.full((1 << 15, 257), -2.0, np.float32), 16, 3, np.ones((2, op.GROUPS)))
    texts = [b"the end", b"", None, b"The rare rare word", b"word the \xc3\xa9", *(b"word%d the the x%d" % (k % 7, k) for k in range(50))]

    def score(rows):
        batch = op.pa.RecordBatch.from_arrays([op.pa.array([0] * len(rows)), op.pa.array([False] * len(rows)), op.pa.array(range(len(rows))),
                                               op.pa.array(rows, op.pa.binary())], names=["a", "b", "c", "d"])
        return [r for out in op._score(model)(iter([batch])) for r in out.to_pylist()]
    calls, spell = [], model.spell_log10
    model.spell_log10 = lambda words, groups: (calls.append(len(words)), spell(words, groups))[1]
    together = score(texts)
    assert len(calls) == 1 and score([]) == []
    for text, got in zip(texts, together):
        want, words = score([text])[0], op.words_of(text)
        assert got["n_tokens"] == len(words) + 1 and got["n_known"] == 1 + sum(w in (b"the", b"end") for w in words)
        assert got["base_score"] == pytest.approx(want["base_score"]) and got["score"] == pytest.approx(want["score"], rel=1e-5)
        assert sorted((r["word"], r["k"]) for r in got["rest"]) == sorted(Counter(w for w in words if w not in model.place).items())
