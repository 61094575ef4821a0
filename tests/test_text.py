from pyspark.sql import functions as F

from quire.functions.text import parse_doc_id, tokenize


def _tokens(spark, text):
    df = spark.createDataFrame([(text,)], "text STRING")
    return df.select(tokenize("text").alias("t")).first()["t"]


def test_tokenize_ascii_runs_lowercased(spark):
    assert _tokens(spark, "Don't A1b2_Z") == ["don", "t", "a1b2", "z"]


def test_tokenize_non_ascii_separates(spark):
    # extract first, lower second: the dotted capital I never turns into 'i'
    assert _tokens(spark, "café İx") == ["caf", "x"]


def test_tokenize_line_breaks_and_digits(spark):
    assert _tokens(spark, "a\rb c\r\n42 x") == ["a", "b", "c", "42", "x"]


def test_tokenize_empty_and_junk(spark):
    assert _tokens(spark, "") == []
    assert _tokens(spark, " -- ... ") == []


def test_tokenize_repeats_kept_in_order(spark):
    assert _tokens(spark, "the cat THE the") == ["the", "cat", "the", "the"]


def test_parse_doc_id(spark):
    df = spark.createDataFrame([(" 8",), ("7abc",), ("xx",), ("-3",), ("+5",), ("",), (None,)], "raw STRING")
    got = [r[0] for r in df.select(parse_doc_id("raw")).collect()]
    assert got == [8, 7, None, -3, 5, None, None]


def test_tokenizer_is_evaluated_once(spark):
    """explode_outer + filter keeps the regex tokenizer once in the plan."""
    from quire.operators.index import term_frequencies
    docs = spark.createDataFrame([(1, "a b")], "doc_id BIGINT, text STRING")
    plan = term_frequencies(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
    assert F  # keep import used


def test_null_and_empty_text_count_zero_tokens(spark):
    from quire.operators.index import doc_lengths, term_frequencies
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a a")], "doc_id BIGINT, text STRING")
    assert sorted(tuple(r) for r in doc_lengths(docs).collect()) == [(1, 0), (2, 0), (3, 2)]
    assert [tuple(r) for r in term_frequencies(docs).collect()] == [("a", 3, 2)]
