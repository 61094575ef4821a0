"""Bloom filters as one aggregation: which keys of a large table can a list of
keys contain at all? Used before a join that has to shuffle, so that the large
side is cut down at its scan.

A filter is one row with an array of 64-bit words. Its size follows the number
of keys up to ``MAX_WORDS`` words (2 MB); beyond that more rows of the large
side get through, never fewer, and the join that follows stays exact. Filters
of one size merge word by word, so that they can be made part by part.

Null keys are in no filter and pass none. A filter of no keys passes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY, HASHES, MAX_WORDS = 10, 4, 1 << 18


def filter_words(keys: int) -> int:
    """Words of a filter for so many keys."""
    return min(MAX_WORDS, max(1, -(-keys * BITS_PER_KEY // 64)))


def _positions(key: Column, words: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(k), key), F.lit(words * 64)) for k in range(HASHES)]


def _word(at: Column) -> Column:
    return F.shiftright(at, 6).cast("int")


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), (at % 64).cast("int"))


def _as_row(words_table: DataFrame, words: int) -> DataFrame:
    zeros = words_table.sparkSession.range(words).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    both = words_table.unionByName(zeros).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    return both.agg(F.sort_array(F.collect_list(F.struct("word", "bits")))["bits"].alias("bloom"))


def bloom_filter(keys: DataFrame, key: str, words: int) -> DataFrame:
    """One row ``bloom`` of all non-null values of ``key``. Partial words are
    combined map-side; the last task gets ``words`` rows."""
    at = F.explode(F.array(*_positions(F.col(key), words))).alias("at")
    bits = keys.where(F.col(key).isNotNull()).select(at).select(_word(F.col("at")).alias("word"), _bit(F.col("at")).alias("bits"))
    return _as_row(bits.groupBy("word").agg(F.bit_or("bits").alias("bits")), words)


def merge_filters(filters: DataFrame, words: int) -> DataFrame:
    """The filter of all keys of several filters of one size, a row each."""
    each = filters.select(F.posexplode("bloom").alias("word", "bits"))
    return _as_row(each.groupBy("word").agg(F.bit_or("bits").alias("bits")), words)


def might_contain(bloom: Column, key: Column, words: int) -> Column:
    """False only if the filter was made without the key."""
    found = key.isNotNull()
    for at in _positions(key, words):
        found = found & (F.get(bloom, _word(at)).bitwiseAND(_bit(at)) != 0)
    return found


def cut_to(table: DataFrame, keys: DataFrame, key: str, words: int | None = None) -> DataFrame:
    """Rows of ``table`` whose ``key`` may be one of ``keys``: all that are,
    and about one in a hundred of the others. The filter is a subquery that
    runs before the table's scan, whose rows it is tested on."""
    wanted = keys.select(key).distinct()
    words = words or filter_words(wanted.count())
    return table.where(might_contain(bloom_filter(wanted, key, words).scalar(), F.col(key), words))
