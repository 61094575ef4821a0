"""Work that tasks do on whole Arrow batches."""

import re

import numpy as np
import pyarrow as pa

from quire.functions import batches as B
from quire.functions.varbyte import decode_codes, encode_codes
from quire.operators import layout
from quire.operators.index import term_frequencies, validate_postings


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_counting_tokens_keeps_no_table_of_a_task(spark, docs_small):
    """An aggregation held all postings of a task."""
    assert "HashAggregate" not in _plan(term_frequencies(docs_small))


def test_validation_deals_postings_before_it_groups_them(spark):
    """the tables of the check hold a bounded share of the pairs."""
    rows = spark.createDataFrame([("a", 1, 2)], "term STRING, doc_id BIGINT, tf BIGINT")
    good, _ = validate_postings(rows)
    assert _plan(good).index("HashAggregate") < _plan(good).index("REPARTITION_BY_NUM")


def test_blocks_and_runs_have_no_function_of_each_posting(spark, docs_small):
    """No array function or sort runs posting by posting."""
    gaps = layout.posting_gaps(term_frequencies(docs_small), runs=8)
    blocks = layout.posting_blocks(gaps)
    plan = _plan(layout.decode_blocks(blocks))
    assert "collect_list(struct(doc_id" not in plan and "regexp_extract_all" not in plan and not re.search(r"row_number\(", plan)


def test_block_rows_leave_python_once_a_block(spark, docs_small):
    """Every posting went from the scan to Spark's rows and
    back before its block was made."""
    tf = term_frequencies(docs_small)
    flat, nested = layout.posting_gaps(tf, runs=8), layout.posting_gaps(tf, runs=8, nested=True)
    assert nested.where("size(doc_ids) > 64").count() == 0 and nested.where("spans").count() and nested.count() < flat.count() / 2
    for kind in ("split", "interleaved"):
        a, b = (sorted(tuple(r) for r in layout.posting_blocks(g, layout=kind).collect()) for g in (flat, nested))
        assert a == b and len(a) > 1000


def test_range_exchanges_sample_what_is_written(spark, tmp_path):
    """block rows and document lengths were computed twice, once
    for the sample of the range exchange."""
    from pyspark.sql import functions as F

    from quire.operators import prefix
    from quire.sinks.text import write_doc_lengths
    for n, work in enumerate((lambda rows: prefix.global_running_sum(rows, ["doc_id"], "n_tokens", "at").count(),
                              lambda rows: write_doc_lengths(rows, str(tmp_path / "lengths")))):
        seen = spark.sparkContext.accumulator(0)

        def noted(batches, seen=seen):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch
        rows = spark.range(100).select(F.col("id").alias("doc_id"), F.col("id").alias("n_tokens")).mapInArrow(noted, "doc_id bigint, n_tokens bigint")
        work(rows)
        assert seen.value == 100, n


def test_a_document_over_batches_is_counted_once():
    def batch(rows):
        return pa.RecordBatch.from_pylist([{"doc_id": d, "tokens": t} for d, t in rows],
                                          schema=pa.schema([("doc_id", pa.int64()), ("tokens", pa.string())]))
    given = [batch([(1, "a b a"), (2, "b")]), batch([(2, "b c"), (2, None)]), batch([(2, "c"), (3, "")]), batch([(4, "a")])]
    got = [tuple(r.values()) for out in B.count_tokens(iter(given)) for r in out.to_pylist()]
    assert sorted(got) == [("a", 1, 2), ("a", 4, 1), ("b", 1, 1), ("b", 2, 2), ("c", 2, 2)]


def test_codes_round_trip():
    values = np.array([0, 1, 127, 128, 300, 16383, 16384, 2 ** 35, 2 ** 62, 2 ** 63 - 1])
    data, ends = encode_codes(values)
    got, counts = decode_codes(data, np.array([ends[3], 0, ends[-1] - ends[3]]))
    assert got.tolist() == values.tolist() and counts.tolist() == [4, 0, 6]
    assert data[ends[3]:ends[4]].tolist() == [0xAC, 0x02]


def test_plain_postings_are_numbers_when_read():
    """only words that are not plain numbers go on as text."""
    from quire.sources.postings import _scan
    words = "t 1:2 30:4\nu x:1 5:06 7:\nv".split(" ")
    batch = pa.RecordBatch.from_arrays([pa.array(words), pa.array([9] * len(words)), pa.array([0] * len(words))], names=["value", "file", "block"])
    got = [(r["term"], r["doc_id"], r["tf"], r["posting"]) for out in _scan(iter([batch]), False) for r in out.to_pylist()]
    assert got == [(None, None, None, "t"), (None, 1, 2, None), (None, 30, 4, None), ("u", None, None, "x:1"), ("u", 5, 6, None), ("u", None, None, "7:")]
    (end,) = [r for out in _scan(iter([batch]), True) for r in out.to_pylist()]
    assert (end["defined"], end["awaits"], end["term"], end["first"]) == (True, False, "v", "t")


def test_postings_are_written_in_stretches_of_lists(spark, docs_small):
    """Every posting was a row of its own when documents were counted,
    written, read and dealt. Stretches hold the same postings in far fewer rows."""
    flat, lists = term_frequencies(docs_small), term_frequencies(docs_small, lists=True)
    rows, found = 0, []
    for r in lists.collect():
        docs, tfs = np.frombuffer(r["doc_ids"], "<i8"), np.frombuffer(r["tfs"], "<i8")
        assert len(docs) == len(tfs) == r["n"] and (np.diff(docs) > 0).all()
        rows, found = rows + 1, found + [(r["term"], d, t) for d, t in zip(docs.tolist(), tfs.tolist())]
    assert sorted(found) == sorted(map(tuple, flat.collect())) and rows < len(found) / 2
    for runs in (None, 40):
        a, b = (sorted(tuple(r) for r in layout.posting_gaps(p, runs=runs).drop("run", "spans").collect()) for p in (flat, lists))
        assert a == b and len(a) > 1000
        a, b = (sorted(tuple(r) for r in layout.posting_blocks(layout.posting_gaps(p, runs=runs, nested=True)).collect()) for p in (flat, lists))
        assert a == b and len(a) > 1000


def test_stretches_of_lists_hold_a_document_once():
    """Documents over batches and over the gathered postings, long lists,
    null texts, and characters that are no token bytes."""
    def batch(rows):
        return pa.RecordBatch.from_pylist([{"doc_id": d, "text": t} for d, t in rows],
                                          schema=pa.schema([("doc_id", pa.int64()), ("text", pa.string())]))
    given = [batch([(1, "A b-a"), (2, "b")]), batch([(2, "İb é C_c"), (2, None)]), batch([(2, "c"), (3, "")]), batch([(4, "a"), (5, "a"), (6, " a9 a")])]
    want = [("a", 1, 2), ("a", 4, 1), ("a", 5, 1), ("a", 6, 1), ("a9", 6, 1), ("b", 1, 1), ("b", 2, 2), ("c", 2, 3)]
    for most in (1, 2, 3, 100):
        out = [r for b in B.count_lists(iter(given), most, 2) for r in b.to_pylist()]
        lists = [(r["term"], *(np.frombuffer(r[c], "<i8").tolist() for c in ("doc_ids", "tfs"))) for r in out]
        assert sorted((term, d, t) for term, docs, tfs in lists for d, t in zip(docs, tfs)) == want
        assert [r["n"] for r in out] == [len(docs) for _, docs, _ in lists] and max(r["n"] for r in out) <= 2
