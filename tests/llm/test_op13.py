import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import types as T

from quire.llm import op13_tokenizer_alignment as op

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("a.b", T.StringType()),
                       T.StructField("run", T.LongType()), T.StructField("kind", T.StringType())])


@pytest.fixture(scope="module")
def enc():
    return op.Encoders(*op.tokenizer_files())


def brute(enc, rows):
    """By the definition, with the tokenizers called on whole texts."""
    counts, docs = Counter(), []
    for i, text in rows:
        a = enc.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = enc.b.encode(text) if text else []
        ta, tb, want = [enc.a_bytes[x] for x in a], [enc.b_bytes[x] for x in b], (" " + (text or "")).encode()
        if not text or b"".join(ta) != want or b"".join(tb) != want:
            docs.append((i, 0, 0, [], ""))
            continue
        ends_a, ends_b, n = {}, {}, 0
        for x, t in zip(a, ta):
            n += len(t)
            ends_a.setdefault(n, []).append(x)
        n = 0
        for x, t in zip(b, tb):
            n += len(t)
            ends_b.setdefault(n, []).append(x)
        links = [(x, y) for e in ends_a for x in ends_a[e] for y in ends_b.get(e, [])]
        both, groups, pa, pb = sorted(ends_a.keys() & ends_b.keys()), [], 0, 0
        for e in both:
            groups.append(",".join(str(x) for k in sorted(ends_a) if pa < k <= e for x in ends_a[k]) + "|"
                          + ",".join(str(x) for k in sorted(ends_b) if pa < k <= e for x in ends_b[k]))
            pa = e
        docs.append((i, len(a), len(b), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
        counts.update(links)
    best = Counter()
    for (_, y), c in counts.items():
        best[y] = max(best[y], c)
    return sorted(((i, na, nb, len(links), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), d)
                   for i, na, nb, links, d in docs), key=str)


def run(spark, rows, parts=3, **more):
    df = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA).repartition(parts)
    out = op.align_documents(df, **more)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted(map(tuple, out.collect()), key=str)


def texts(seed, n):
    rnd = random.Random(seed)
    bits = ["hello", "World", "’s", " ", "  ", "\n\n", "\t", "123456", "ß", "日本", "🙂", "<|endoftext|>", "<s>", "é", ".", "...", " ", "don't", "the the"]
    return [(i, "".join(rnd.choice(bits) for _ in range(rnd.randrange(1, 40)))) for i in range(n)]


def test_brute_force(spark, enc):
    rows = texts(1, 200)
    want = brute(enc, rows)
    assert sum(r[1] > 0 for r in want) > 50
    assert run(spark, rows) == want


def test_many_runs_merge_in_several_passes(spark, enc):
    rows = texts(2, 150)
    assert run(spark, rows, run_links=20, fan_in=2) == brute(enc, rows)


def test_edges(spark, enc):
    """Nulls, empty texts, texts that do not spell space + text, repeated ids
    and rows, ties."""
    rows = [(1, None), (2, ""), (None, "a tie"), (None, "a tie"), (3, "▁ odd"), (4, " "), (5, "\x00﻿"), (5, "other text"), (6, "of of")]
    want = brute(enc, rows)
    assert run(spark, rows) == want
    assert [r[1:] for r in want if r[0] in (1, 2, 3)] == [(0, 0, 0, 0, 0, 0, "")] * 3
    assert run(spark, []) == []
    assert run(spark, [(1, None)]) == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_long_texts_in_segments_have_the_same_ids(enc, monkeypatch):
    rnd = random.Random(3)
    long = "".join(t for _, t in texts(4, 300)) + " " + " ".join(rnd.choice(["ab", "çd", "12", "!"]) for _ in range(20_000))
    want = list(enc.encode([long, "x"]))
    monkeypatch.setattr(op, "_SEGMENT", 50)
    for (a, b), (c, d) in zip(enc.encode([long, "x"]), want):
        assert a.tolist() == c.tolist() and b.tolist() == d.tolist()


def test_segments_are_exact_for_this_vocabulary(enc):
    """No piece has a space after another character, so cutting before a
    single space cuts no piece; every token has bytes."""
    assert not any(" " in t.lstrip(b" ").decode("latin-1") for t in enc.b_bytes)
    assert enc.a_size.min() > 0 and enc.b_size.min() > 0


def test_the_faster_encoder_is_the_same(enc):
    """For every usual character, alone, doubled, and between others."""
    usual = [chr(c) for c in [*range(0x250), *range(0x2010, 0x2028), 0x20AC]]
    assert enc.a_ranks and not op._UNUSUAL.search("".join(usual)) and op._UNUSUAL.search("日")
    rnd = random.Random(7)
    some = [t for c in usual for t in (c, f" {c}", c + c, f"a{c}b", f"1{c} 2", f" {c} ", f"{c}\n{c}x", f"'{c}'s")]
    some += ["".join(rnd.choices(usual + list(" \n'") * 60, k=rnd.randrange(1, 80))) for _ in range(3000)]
    assert [enc.a_ranks.encode_ordinary(t) for t in some] == [x.ids for x in enc.a.encode_batch(some, add_special_tokens=False)]


def test_whole_table(spark, enc):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, op.query(spark, sf).collect()), key=str) == brute(enc, rows)
