import random

from pyspark.sql import functions as F

from quire.operators import layout, prefix
from quire.operators.index import term_frequencies


def test_global_running_sum_matches_cumsum(spark):
    rnd = random.Random(7)
    data = [(f"k{i:05d}", rnd.randint(0, 50)) for i in range(5000)]
    rnd.shuffle(data)
    df = spark.createDataFrame(data, "k STRING, v BIGINT")
    out = prefix.global_running_sum(df, ["k"], "v", "off", num_partitions=7)
    got = {r["k"]: r["off"] for r in out.collect()}
    run = 0
    for k, v in sorted(data):
        assert got[k] == run
        run += v


def test_lexicon_offsets_are_contiguous(spark, docs_small):
    blocks = layout.posting_blocks(layout.posting_gaps(term_frequencies(docs_small)), with_payload=False)
    lex = prefix.lexicon(blocks).orderBy("term").collect()
    off = 0
    for r in lex:
        assert r["offset"] == off
        off += r["length"]
    total = blocks.agg(F.sum("n_bytes")).first()[0]
    assert off == total
    starts = prefix.block_offsets(blocks).where("block_no = 0").select("term", "offset")
    assert starts.exceptAll(prefix.lexicon(blocks).select("term", "offset")).count() == 0


def test_rows_are_summed_where_they_are_ordered(spark):
    """rows crossed the network and were sorted a second time for a window;
    only the totals of the partitions need one."""
    rows = spark.range(500).select((F.col("id") * 7 % 500).alias("k"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("v"))
    out = prefix.global_running_sum(rows, ["k"], "v", "at", num_partitions=6)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 1
    got = {r["k"]: (r["v"], r["at"]) for r in out.collect()}
    total = 0
    for k in range(500):
        assert got[k][1] == total
        total += got[k][0] or 0
