import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T
from tokenizers import Tokenizer

from quire.llm import op10_best_fit_packing as op

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


def whole_ids(texts):
    t = Tokenizer.from_file(op.tokenizer_file())
    return [e.ids + [1] for e in t.encode_batch(texts, add_special_tokens=False)]


def check(rows, got):
    """Pieces are those of the whole texts, and sequences are gapless."""
    want = []
    for (i, _), ids in zip(rows, whole_ids([t or "" for _, t in rows])):
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at:at + 4096]
            want.append((i, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    seqs = defaultdict(list)
    for r in got:
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in seqs.values():
        at = 0
        for off, n in sorted(parts):
            assert off == at
            at += n
        assert at <= 4096
    return len(seqs), sum(r["length"] for r in got)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_brute_force(spark, sf):
    d = f"/root/testdata/{sf}"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    n, tokens = check(rows, op.query(spark, d).collect())
    assert n <= -(-tokens // 4096) + 1


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "a"), (3, "a"), (None, "x y"), (4, "don't stop " * 9000), (5, "   é́ "),
            (6, "<|endoftext|> word"), (7, "hi<|endoftext|>there, <|startoftext|>. <|EndOfText|>"), (8, "Ärger, École... straße! é É"),
            *[(None, "")] * 50]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as grp", "2 as piece", "'x' as length", "3 as `a.b`")
    check(rows, op.pack_documents(df, group_rows=3).collect())
    assert op.pack_documents(df.limit(0)).collect() == []


def test_letters_encoder_is_the_same(spark):
    """For every string of the vocabulary, random words, and all words of a
    table; and with a tiny cache."""
    rnd = random.Random(4)
    tokens, whole = op.WordTokens(op.tokenizer_file()), Tokenizer.from_file(op.tokenizer_file())
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZÀÉÖØÞßàéöøþÿ"
    words = {t.removesuffix("</w>") for t in whole.get_vocab() if op._LETTERS.fullmatch(t.removesuffix("</w>"))}
    words |= {a + b for a, b in zip(rnd.sample(sorted(words), 20_000), rnd.sample(sorted(words), 20_000))}
    words |= {"".join(rnd.choices(letters, k=rnd.randrange(1, 30))) + rnd.choice(["", ",", "...", "?!"]) for _ in range(20_000)}
    texts = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()
    words |= {w.decode() for r in texts for w in (r["text"] or "").encode().split()}
    words = sorted(words)
    simple = {w: tokens._simple(w.encode()) for w in words}
    some = [w for w in words if simple[w] is not None]
    assert len(some) > 60_000
    for w, e in zip(some, whole.encode_batch(some, add_special_tokens=False)):
        assert np.frombuffer(simple[w], "<u4").tolist() == e.ids, w
    small = op.WordTokens(op.tokenizer_file(), 50)
    texts = [" ".join(rnd.choices(words, k=30)) for _ in range(100)]
    for t, e in zip(texts, whole.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(small([t.encode()])[0], "<u4").tolist() == e.ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_packing_is_a_partition(lengths):
    bins = op.best_two_fit(lengths, 40)
    assert sorted(k for b in bins for k in b) == list(range(len(lengths)))
    assert all(sum(lengths[k] for k in b) <= 40 for b in bins)


def test_two_smaller_pieces_replace_the_smallest():
    # greedy alone: 6+3 leaves 1; 6 + (2+2) fills the bin
    assert sorted(map(sorted, [[[6, 3, 2, 2][k] for k in b] for b in op.best_two_fit([6, 3, 2, 2], 10)])) == [[2, 2, 6], [3]]


def test_packing_is_tight():
    rng = random.Random(1)
    lengths = [min(4096, int(rng.lognormvariate(6.5, 1.2)) + 1) for _ in range(8000)]
    assert len(op.best_two_fit(lengths, 4096)) <= -(-sum(lengths) // 4096) + 2
