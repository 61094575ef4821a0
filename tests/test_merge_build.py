import math
import tempfile

from pyspark.sql import functions as F

from quire.operators import index as idx
from quire.plans import build as B
from quire.operators.lookup import query_terms
from quire.sinks.text import posting_lines, write_postings_text
from quire.sources.postings import read_postings_text

from conftest import rows


def test_merge_of_twelve_slices_equals_full_build(spark, docs_small):
    full = idx.term_frequencies(docs_small)
    # twelve disjoint doc-id ranges, each indexed by itself
    partials = [idx.term_frequencies(docs_small.where((F.col("doc_id") >= lo) & (F.col("doc_id") < lo + 17)))
                for lo in range(0, 204, 17)]
    merged, rejects = B.merge_partial_indexes(partials)
    assert rejects.count() == 0
    assert merged.exceptAll(full).count() == 0 and full.exceptAll(merged).count() == 0


def test_duplicate_postings_rejected(spark):
    a = spark.createDataFrame([("a", 5, 1), ("b", 1, 1)], "term STRING, doc_id BIGINT, tf BIGINT")
    b = spark.createDataFrame([("a", 5, 1)], "term STRING, doc_id BIGINT, tf BIGINT")
    good, rejects = B.merge_partial_indexes([a, b])
    assert rows(good) == [("a", 5, 1), ("b", 1, 1)]
    assert [r["reason"] for r in rejects.collect()] == ["duplicate posting x2"]
    c = spark.createDataFrame([("a", 5, 4), (None, 1, 1), ("c", None, 1), ("c", 2, None), ("d", -1, 1)], "term STRING, doc_id BIGINT, tf BIGINT")
    good, rejects = B.merge_partial_indexes([a, b, c])
    assert rows(good) == [("b", 1, 1)]
    assert sorted(r["reason"] for r in rejects.collect()) == ["copies with tf 1 to 4", "negative doc id or tf"] + ["no term, doc id or tf"] * 3


def test_text_round_trip_through_files(spark, docs_small):
    tf = idx.term_frequencies(docs_small)
    d = tempfile.mkdtemp(prefix="quire-test-")
    write_postings_text(tf, f"{d}/runs", num_files=3, chunk_size=64)
    back, rejects = read_postings_text(spark, f"{d}/runs")
    assert rejects.count() == 0
    assert back.exceptAll(tf).count() == 0 and tf.exceptAll(back).count() == 0
    # globally sorted: part files in name order give ascending (term, chunk)
    lines = [r["value"] for r in spark.read.text(f"{d}/runs").collect()]
    import glob
    ordered = []
    for f in sorted(glob.glob(f"{d}/runs/part-*")):
        ordered += [ln.split(" ", 1)[0] for ln in open(f).read().splitlines()]
    assert ordered == sorted(ordered) and len(ordered) == len(lines)


def test_long_list_split_into_chunk_lines(spark):
    postings = spark.createDataFrame([("x", d, 1) for d in range(10)], "term STRING, doc_id BIGINT, tf BIGINT")
    lines = rows(posting_lines(postings, chunk_size=4), "chunk", "line")
    assert lines == [(0, "x 0:1 1:1 2:1 3:1"), (1, "x 4:1 5:1 6:1 7:1"), (2, "x 8:1 9:1")]
    far = spark.createDataFrame([("x", d * 100_000, 1) for d in range(3)], "term STRING, doc_id BIGINT, tf BIGINT")
    assert rows(posting_lines(far), "chunk", "line") == [(0, "x 0:1 100000:1 200000:1")]
    # the reader concatenates the lines of one term back into its list
    from quire.sources.postings import parse_posting_lines
    parsed = parse_posting_lines(posting_lines(postings, chunk_size=4).select(F.col("line").alias("value")))
    assert rows(parsed.good) == [("x", d, 1) for d in range(10)]


def test_build_write_open_query(spark, docs_small):
    index = B.build_index(docs_small, runs=20)
    d = tempfile.mkdtemp(prefix="quire-test-")
    B.write_index_tables(index, f"{d}/idx", num_files=4)
    opened = B.open_index(spark, f"{d}/idx")
    terms = ["the", "tion", "ed", "chch", "peacefully"]
    got = rows(B.query_index(spark, opened, terms, 3))
    tf = idx.term_frequencies(docs_small)
    want = rows(query_terms(spark, terms, tf, 3))
    assert got == want and len(got) == 4
    # invariants: sum of tf = sum of lengths; blocks per term = ceil(df / 64)
    dec = opened.postings()
    assert dec.agg(F.sum("tf")).first()[0] == opened.doc_lengths.agg(F.sum("n_tokens")).first()[0]
    nb = opened.blocks.groupBy("term").count().join(opened.lexicon, "term")
    assert all(r["count"] == math.ceil(r["doc_freq"] / 64) for r in nb.collect())
    lex = opened.lexicon.orderBy("term").collect()
    assert all(a["offset"] + a["length"] == b["offset"] for a, b in zip(lex, lex[1:]))


def test_merged_runs_become_an_index(spark, docs_small):
    d = tempfile.mkdtemp(prefix="quire-test-")
    tf = idx.term_frequencies(docs_small)
    for k in range(3):
        write_postings_text(tf.where(F.col("doc_id") % 3 == k), f"{d}/runs", mode="append", global_order=False, chunk_size=16)
    index, rejects = B.merge_runs(spark, f"{d}/runs", idx.doc_lengths(docs_small), runs=20)
    assert rejects.count() == 0
    built = B.build_index(docs_small, runs=20)
    assert rows(index.blocks) == rows(built.blocks) and rows(index.lexicon) == rows(built.lexicon)


def test_payload_crosses_one_exchange(spark, docs_small, monkeypatch):
    import re
    plans = []
    monkeypatch.setattr(B, "pin", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df)
    B.build_index(docs_small, runs=20)
    last_step = plans[-1].split("AdaptiveSparkPlan")[1]
    # the pieces of a block meet once, by (term, block_no); nothing after that
    assert len(re.findall(r"Exchange hashpartitioning\(term#\d+, block_no#\d+", last_step)) == 1
    assert "rangepartitioning" not in last_step


def test_dump_interleaved_blocks_as_text(spark):
    postings = spark.createDataFrame([("x", 0, 2), ("x", 7, 1), ("y", 300, 5)],
                                     "term STRING, doc_id BIGINT, tf BIGINT")
    from quire.operators import layout
    blocks = layout.posting_blocks(layout.posting_gaps(postings), layout="interleaved")
    lines = rows(B.dump_index_text(blocks, "interleaved"), "line")
    assert lines == [("x 0:2 7:1",), ("y 300:5",)]


def test_duplicate_postings_fail_mode(spark):
    a = spark.createDataFrame([("a", 5, 1)], "term STRING, doc_id BIGINT, tf BIGINT")
    good, _ = B.merge_partial_indexes([a, a], on_duplicate="fail")
    try:
        good.collect()
    except Exception as e:  # noqa: BLE001
        assert "rejected posting" in str(e)
    else:
        raise AssertionError("expected failure")


def test_posting_files_are_even_in_bytes(spark, docs_small, tmp_path):
    """Lines of very unlike length: files in order, none over twice the
    median."""
    import glob
    import os
    write_postings_text(idx.term_frequencies(docs_small), str(tmp_path / "p"), num_files=6, chunk_size=64)
    files = sorted(glob.glob(str(tmp_path / "p" / "part-*")))
    sizes = sorted(os.path.getsize(f) for f in files)
    assert len(files) == 6 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    terms = [line.split(" ")[0].encode() for f in files for line in open(f, encoding="utf-8")]
    assert terms == sorted(terms)
