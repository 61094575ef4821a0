import math

from pyspark.sql import functions as F

from quire.operators import layout
from quire.operators.index import term_frequencies
from quire.operators.ranges import Ranges

from conftest import rows


def _lists(spark, lengths):
    data = [(f"t{n}", d, 1 + d % 3) for n in lengths for d in range(0, 2 * n, 2)]
    return spark.createDataFrame(data, "term STRING, doc_id BIGINT, tf BIGINT")


def test_block_counts_at_borders(spark):
    lengths = [1, 63, 64, 65, 128, 129]
    blocks = layout.posting_blocks(layout.posting_gaps(_lists(spark, lengths)), with_payload=False)
    got = dict((r["term"], r["c"]) for r in blocks.groupBy("term").agg(F.count("*").alias("c")).collect())
    assert got == {f"t{n}": math.ceil(n / 64) for n in lengths}
    sizes = rows(blocks.where("term = 't65'"), "block_no", "n_postings", "last_doc_id")
    assert sizes == [(0, 64, 126), (1, 1, 128)]


def test_gaps_run_across_blocks_and_runs(spark):
    postings = _lists(spark, [129])
    wide = layout.posting_gaps(postings)
    narrow = layout.posting_gaps(postings, runs=40)  # the list spans many runs
    cols = ["term", "doc_id", "tf", "gap", "pos", "block_no"]
    assert rows(wide, *cols) == rows(narrow, *cols)
    # blocks straddling runs come out the same as blocks inside one
    assert rows(layout.posting_blocks(wide)) == rows(layout.posting_blocks(narrow))
    gaps = rows(wide, "pos", "doc_id", "gap", "block_no")
    assert gaps[0] == (0, 0, 0, 0)
    assert all(g == 2 for _, _, g, _ in gaps[1:])
    assert gaps[64] == (64, 128, 2, 1)


def test_doc_zero_payload(spark):
    postings = spark.createDataFrame([("a", 0, 1), ("a", 300, 2)], "term STRING, doc_id BIGINT, tf BIGINT")
    blocks = layout.posting_blocks(layout.posting_gaps(postings))
    r = blocks.select(F.hex("payload").alias("h"), "n_bytes").first()
    assert r["h"] == "00AC020102" and r["n_bytes"] == 5


def test_round_trip_both_layouts(spark, docs_small):
    tf = term_frequencies(docs_small)
    gaps = layout.posting_gaps(tf, runs=50)
    for lay in ("split", "interleaved"):
        dec = layout.decode_blocks(layout.posting_blocks(gaps, layout=lay), layout=lay)
        assert dec.exceptAll(tf).count() == 0 and tf.exceptAll(dec).count() == 0


def test_blocks_invariant_on_corpus(spark, docs_small):
    tf = term_frequencies(docs_small)
    blocks = layout.posting_blocks(layout.posting_gaps(tf), with_payload=False)
    per_term = blocks.groupBy("term").agg(F.count("*").alias("nb"), F.sum("n_postings").alias("df"))
    bad = per_term.where(F.col("nb") != F.ceil(F.col("df") / 64)).count()
    assert bad == 0


def test_runs_are_stretches_of_the_order(spark):
    """Every row is in the run that its borders say, quotes, spaces and
    characters beyond ASCII included; runs are even for any ids."""
    data = sorted({(t, k * k * 10 ** 9) for t in ["a", "it's", "b\\", "é", "日", "x y", ""] for k in range(60)},
                  key=lambda r: (r[0].encode(), r[1]))
    df = spark.createDataFrame(data, "term STRING, doc_id BIGINT")
    ranges = Ranges.of(df, "term", "doc_id", 12)
    assert ranges.borders == [data[len(data) * i // 12] for i in range(1, 12)]
    got = {(r["term"], r["doc_id"]): r["run"] for r in df.withColumn("run", ranges.run("term", "doc_id")).collect()}
    order = [(t.encode(), k) for t, k in ranges.borders]
    assert all(r == sum(b <= (t.encode(), k) for b in order) for (t, k), r in got.items())
    assert ranges.of_spanning(df).count() == 60 * len({t for t, _ in ranges.borders})
    assert Ranges.of(df, "term", "doc_id").borders == [] and Ranges.of(df.limit(0), "term", "doc_id", 5).borders == []


def test_hot_term_over_scattered_ids_and_a_null_id(spark):
    ids = [7 * 10 ** 13 * k + 3 for k in range(200)] + [2 ** 62]
    docs = spark.createDataFrame([(i, "a b a") for i in ids] + [(None, "a"), (-5, "a")], "doc_id BIGINT, text STRING")
    gaps = layout.posting_gaps(term_frequencies(docs), runs=20)
    got = sorted((r["doc_id"], r["gap"], r["pos"]) for r in gaps.where("term = 'a'").collect())
    assert [g[0] for g in got] == sorted(ids) and [g[2] for g in got] == list(range(201))
    assert [g[1] for g in got] == [b - a for a, b in zip([0] + sorted(ids), sorted(ids))]
    assert gaps.groupBy("term", "run").count().agg(F.max("count")).first()[0] <= 40
    plain = layout.posting_gaps(term_frequencies(docs))
    assert rows(gaps, "term", "doc_id", "gap", "pos") == rows(plain, "term", "doc_id", "gap", "pos")
