import duckdb
import pytest

import __spark_entry__ as E

from conftest import SF0001
from quire.plans.catalog import QUERIES


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["list_rank", "query_pos", "term", "doc_freq", "lookup_doc_id", "doc_id", "tf"]
    assert df.count() == 5


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF0001}/documents.parquet')")
    return con


def _canon(cols, rs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    def norm(v):
        return bytes(v).hex() if isinstance(v, (bytes, bytearray, memoryview)) else str(v)
    return sorted("|".join(norm(r[i]) for i in order) for r in rs)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF0001)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(df.columns, got) == _canon(ocols, res.fetchall())


def test_expected_lookup_at_sf001(spark):
    """Rarest list first, first posting at or after doc 3 (FIXTURES.md)."""
    res = E.queries()["query_terms"](spark, "/root/testdata/sf0.01").orderBy("list_rank")
    got = [(r["term"], r["query_pos"], r["doc_freq"], r["doc_id"], r["tf"]) for r in res.collect()]
    assert got == [("chch", 3, 60, 20, 4), ("ed", 2, 301, 5, 1), ("tion", 1, 373, 3, 7),
                   ("the", 0, 615, 5, 3), ("the", 6, 615, 5, 3)]


def test_posting_files_have_lists_of_several_lines(spark, duck):
    """The order of a list's lines takes part: frequent terms have a line for
    every 256 postings."""
    lines = E.queries()["posting_file_order"](spark, "/root/testdata/sf0.01")
    assert lines.count() > lines.select("term").distinct().count()
