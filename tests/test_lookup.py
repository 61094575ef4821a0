from pyspark.sql import functions as F

from quire.operators import layout, lookup, prefix
from quire.operators.index import doc_freq, term_frequencies

from conftest import rows

POSTINGS = [("a", 2, 5), ("a", 5, 1), ("a", 9, 3), ("b", 0, 7), ("b", 100, 2)]


def _postings(spark):
    return spark.createDataFrame(POSTINGS, "term STRING, doc_id BIGINT, tf BIGINT")


def _probes(spark, items):
    return spark.createDataFrame(items, "term STRING, lookup_doc_id BIGINT")


def _brute(items):
    out = []
    for t, d in items:
        hits = sorted((doc, tf) for term, doc, tf in POSTINGS if term == t and doc >= d)
        out.append((t, d) + (hits[0] if hits else (-1, -1)))
    return sorted(out)


ITEMS = [("a", 0), ("a", 2), ("a", 3), ("a", 9), ("a", 10), ("b", 1), ("b", 100), ("b", 101),
         ("c", 0), ("a", 3)]


def test_next_geq_cases(spark):
    for runs in (None, 2, 5, 30):
        got = rows(lookup.next_geq(_postings(spark), _probes(spark, ITEMS), runs=runs))
        assert got == _brute(ITEMS), runs


def test_next_geq_blocks_and_locate(spark):
    blocks = layout.posting_blocks(layout.posting_gaps(_postings(spark)))
    got = rows(lookup.next_geq_blocks(blocks, _probes(spark, ITEMS), runs=4))
    assert got == _brute(ITEMS)
    loc = rows(lookup.locate_block(blocks, _probes(spark, [("a", 3), ("a", 10), ("b", 0)])))
    assert loc == [("a", 3, 0), ("a", 10, -1), ("b", 0, 0)]


def test_next_geq_on_corpus_many_runs(spark, docs_small):
    tf = term_frequencies(docs_small)
    probes = docs_small.select(F.explode(F.array(F.lit("the"), F.lit("chch"), F.lit("zzz"))).alias("term"),
                               F.col("doc_id").alias("lookup_doc_id"))
    a = lookup.next_geq(tf, probes)
    b = lookup.next_geq(tf, probes, runs=30)
    blocks = layout.posting_blocks(layout.posting_gaps(tf, runs=30))
    c = lookup.next_geq_blocks(blocks, probes, runs=30)
    assert rows(a) == rows(b) == rows(c)


def test_query_terms_rarest_first_repeats_and_case(spark, docs_small):
    tf = term_frequencies(docs_small)
    res = lookup.query_terms(spark, ["the", "The", "chch", "the", "peacefully"], tf, 3)
    got = res.orderBy("list_rank").collect()
    assert [r["term"] for r in got] == ["chch", "the", "the"]
    assert [r["query_pos"] for r in got] == [2, 0, 3]
    missing = lookup.missing_terms(lookup.query_frame(spark, ["the", "The", "peacefully"]), doc_freq(tf))
    assert sorted(r["term"] for r in missing.collect()) == ["The", "peacefully"]


def test_lookup_terms_uses_lexicon_entry(spark, docs_small):
    tf = term_frequencies(docs_small)
    lex = prefix.lexicon(layout.posting_blocks(layout.posting_gaps(tf), with_payload=False))
    res = lookup.lookup_terms(lookup.query_frame(spark, ["the", "nope"]), lex).collect()
    assert len(res) == 1 and res[0]["doc_freq"] == 122


def test_long_query_lists_and_scattered_ids(spark):
    """More terms than a literal filter takes, and ids that no width fits."""
    far = [("a", 3, 1), ("a", 2 ** 62, 2), ("b", 10 ** 15, 3)] + [(f"t{k}", k * 10 ** 12, 1) for k in range(300)]
    postings = spark.createDataFrame(far, "term STRING, doc_id BIGINT, tf BIGINT")
    terms = [t for t, _, _ in far] + [f"none{k}" for k in range(500)]
    got = {r["term"]: (r["doc_id"], r["tf"]) for r in lookup.query_terms(spark, terms, postings, 4, runs=12).collect()}
    assert got["a"] == (2 ** 62, 2) and got["b"] == (10 ** 15, 3) and got["t0"] == (-1, -1) and got["t299"] == (299 * 10 ** 12, 1)
    assert len(got) == 302


def test_asof_runs_once_over_few_block_reads(spark, docs_small):
    import re
    from quire.session import pin
    blocks = pin(layout.posting_blocks(layout.posting_gaps(term_frequencies(docs_small))))
    probes = docs_small.select(F.lit("the").alias("term"), F.col("doc_id").alias("lookup_doc_id"))
    plan = lookup.next_geq_blocks(blocks, probes)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Window", plan)) == 0                # the as-of was computed before
    assert sum("payload#" in line for line in plan.splitlines() if "Relation" in line) == 1
