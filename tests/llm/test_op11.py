import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
from pyspark.sql import types as T

from quire.llm import op11_phrase_mining as op

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("a.b", T.StringType()), T.StructField("n", T.LongType()), T.StructField("prefix", T.StringType())])


def brute(rows, least=3, most=5, top=2000, percent=100):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split("[.,;:!?\n-\r]", lower):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, most + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        cands = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in cands.items():
            inside = any(len(q) > len(p) and 100 * b >= percent * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                         for q, b in cands.items())
            if not inside:
                score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i, q.decode(), -a, le, r, n[lang], -s) for i, (s, a, q, le, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def run(spark, rows, least=3, parts=3, **more):
    df = spark.createDataFrame([(i, t, x, "x", 7, "y") for i, (t, x) in enumerate(rows)], SCHEMA).repartition(parts)
    out = op.collocations(df, min_count=least, **more)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, out.collect()))


def sample(seed, docs):
    rnd = random.Random(seed)
    words = [*"abcdeFGhij", "é", "Éa", "x\x1cy", "hot"]
    weights = [*range(1, 14), 60]
    return [("".join(rnd.choices(words, weights)[0] + rnd.choice([" ", " ", " ", "\t ", ", ", "\n", ". "]) for _ in range(rnd.randrange(60))),
             rnd.choice(["en", "de", None, "und", ""])) for _ in range(docs)]


def test_brute_force(spark):
    rows = sample(1, 150)
    assert run(spark, rows) == brute(rows)


def test_windows_segments_and_collisions_lose_nothing(spark, monkeypatch):
    """Tiny windows cut texts, stripes have many segments, a sketch of 8 slots
    lets nearly all pass: the same rows."""
    monkeypatch.setattr(op, "SEGMENT_BITS", 2)
    rows = sample(2, 120)
    want = brute(rows)
    assert run(spark, rows, window=50, slots=1 << 17) == want
    assert run(spark, rows, slots=8) == want


def test_words_without_codes(spark, monkeypatch):
    """No code, or few: the same rows."""
    monkeypatch.setattr(op, "SEGMENT_BITS", 2)
    rows, found = sample(4, 100), op.head_words
    want = brute(rows)
    for most in (0, 5):
        monkeypatch.setattr(op, "head_words", lambda words: found(words, most))
        assert run(spark, rows, window=200) == want


def test_numbers_are_packed():
    for a in ([0], [0, 127, 128, 16383, 16384, 5, 2**40, 2**62 + 1], list(range(300))):
        raw, ends = op._packed(np.array(a))
        assert op._unpacked(raw).tolist() == a
        assert [op._unpacked(raw[s:e]).tolist() for s, e in zip(ends[:-1], ends[1:])] == [[x] for x in a]


def test_entries_of_stripes_take_few_bytes():
    """A word that follows a prefix and its count: under two bytes and a half."""
    rng = np.random.default_rng(5)
    words = [b"!"] + [bytes(rng.integers(97, 123, rng.integers(3, 12)).astype(np.uint8)) + b"%d" % k for k in range(3000)]
    a = (3000 * rng.random(200_000) ** 2).astype(np.int32) + 1
    more = {"head": {w: k for k, w in enumerate(words[1:])}} if hasattr(op, "head_words") else {}
    out = op._stripe_rows("en", words, a, len(a), 2, np.full(1 << 17, 12, np.uint8), 20, **more)
    assert out.nbytes < 2.5 * len(set(zip(a[:-1].tolist(), a[1:].tolist())))


def test_parameters(spark):
    rows = sample(3, 100)
    assert run(spark, rows, 4, max_words=3, top=5) == brute(rows, 4, 3, 5)
    assert run(spark, rows, 4, subsume_percent=60) == brute(rows, 4, percent=60)


def test_edges(spark):
    rows = [(None, "en"), ("", "en"), (" \t,.;", None), ("Ab cD", "en"), ("ab cd", "en"), ("ab\ncd", "en"), ("a " * 50_000, "de"), ("x" * 300_000, "de"),
            ("p q r, p q r", ""), ("p q r", "")]
    got = run(spark, rows, 2)
    assert got == brute(rows, 2)
    assert ("en", 1, "ab cd", 2, 3, 3, 6, 1333) in got
    assert [r[2] for r in got if r[0] == "de"] == ["a a", "a a a", "a a a a", "a a a a a"]
    assert [r[2] for r in got if r[0] == ""] == ["p q r"]          # p q and q r lie in it
    assert run(spark, []) == []
    assert run(spark, [(None, None)]) == []


def test_exact_beyond_64_bits(spark):
    """1000 a n / (l r) of counts whose products pass 64 bits."""
    row = spark.sql("select array(9000000000000L) as lefts, array(7000000000000L) as rights, 2 as words, 6000000000000L as a, "
                    "900000000000000L as n")
    cut = row.selectExpr("(cast(1000 as decimal(38, 0)) * cast(a as decimal(38, 0)) * cast(n as decimal(38, 0))) div "
                         "(cast(lefts[0] as decimal(38, 0)) * cast(rights[0] as decimal(38, 0))) as s").first()["s"]
    assert cut == 1000 * 6 * 10**12 * 9 * 10**14 // (63 * 10**24)


def test_sql_says_the_same(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf}/documents.parquet'")
    assert sorted(map(tuple, op.query(spark, sf).collect())) == sorted(con.sql(op.ORACLE_SQL).fetchall())
