import duckdb
import pytest

from quire.llm.queries import ORACLE, QUERIES


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(tuple(str(r[k]) for k in order) for r in rows)


@pytest.mark.parametrize("name", ["op1_suffix_dedup", "op9_jaccard_join"])
def test_query_equals_sql(spark, name):
    d = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{d}/documents.parquet')")
    want = con.execute(ORACLE[name])
    columns = [c[0] for c in want.description]
    got = QUERIES[name](spark, d)
    assert sorted(got.columns) == sorted(columns)
    assert canon(got.columns, [tuple(r) for r in got.collect()]) == canon(columns, want.fetchall())
