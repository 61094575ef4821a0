from pyspark.sql import functions as F

from quire.operators import bloom, lookup

from conftest import rows


def _keys(spark, n, prefix="k"):
    return spark.range(n).select(F.concat(F.lit(prefix), F.col("id").cast("string")).alias("term"))


def test_no_key_is_lost_and_few_others_pass(spark):
    keys, table = _keys(spark, 2000), _keys(spark, 2000).union(_keys(spark, 20000, "other"))
    got = bloom.cut_to(table, keys, "term")
    assert got.join(keys, "term", "left_semi").count() == 2000
    assert got.count() < 2000 + 600                    # about 1.2 % of the others


def test_a_filter_that_is_too_small_passes_more_never_less(spark):
    keys = _keys(spark, 500)
    got = bloom.cut_to(_keys(spark, 700), keys, "term", words=1)
    assert got.join(keys, "term", "left_semi").count() == 500
    assert bloom.filter_words(10 ** 12) == bloom.MAX_WORDS and bloom.filter_words(0) == 1


def test_merged_filters_equal_the_filter_of_all_keys(spark):
    a, b = _keys(spark, 100), _keys(spark, 150, "x")
    parts = bloom.bloom_filter(a, "term", 40).union(bloom.bloom_filter(b, "term", 40))
    assert bloom.merge_filters(parts, 40).first() == bloom.bloom_filter(a.union(b), "term", 40).first()


def test_nulls_repeats_and_empty_lists(spark):
    table = spark.createDataFrame([("a",), (None,), ("a",), ("",)], "term STRING")
    empty = table.limit(0)
    assert bloom.cut_to(table, empty, "term").count() == 0
    assert bloom.cut_to(empty, table, "term").count() == 0
    got = rows(bloom.cut_to(table, spark.createDataFrame([("a",), ("",), (None,)], "term STRING"), "term"))
    assert got == [("",), ("a",), ("a",)]


def test_long_query_lists_give_the_rows_of_short_ones(spark):
    lexicon = _keys(spark, 3000).withColumn("doc_freq", F.length("term").cast("bigint"))
    query = _keys(spark, 40).union(_keys(spark, 7, "none")).union(_keys(spark, 3)).withColumn("query_pos", F.monotonically_increasing_id())
    for op in (lookup.lookup_terms, lookup.missing_terms):
        long = op(query, lexicon, broadcast_rows=5)
        assert rows(long) == rows(op(query, lexicon)) and long.count()
    plan = lookup.lookup_terms(query, lexicon, broadcast_rows=5)._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan and "bit_or" in plan.lower()
