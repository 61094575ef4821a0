"""Plan-shape checks for the properties the design relies on at scale."""

import re
import tempfile

from quire.operators import layout
from quire.operators.index import term_frequencies
from quire.plans import build as B


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(plan: str) -> list[str]:
    return re.findall(r"Exchange (\w+\([^)]*\)|SinglePartition)", plan)


def test_term_frequencies_shuffles_text_not_postings(docs_small):
    ex = _exchanges(_plan(term_frequencies(docs_small)))
    assert len(ex) == 1 and ex[0].startswith("hashpartitioning(doc_id")


def test_gaps_and_blocks_shuffle_postings_once(docs_small):
    """Postings move by (term, run) for the window. Besides, only the carries
    (one row a run) and the pieces of lists that span runs move."""
    gaps = layout.posting_gaps(term_frequencies(docs_small), runs=20)
    kinds = [re.sub(r"#\d+L?", "", e) for e in _exchanges(_plan(gaps))]
    kinds = [k for k in kinds if k.startswith("hash")]
    assert len(kinds) == 3 and sum("(term, run" in k for k in kinds) == 2
    plan = _plan(layout.posting_blocks(gaps))
    by_block = [e for e in _exchanges(plan) if "block_no" in e]
    assert len(by_block) == 1 and "Union" in plan


def test_skewed_probes_make_no_large_group(spark, docs_small, monkeypatch):
    """Nearly all probes past a term's last document: no run has over twice
    the median of rows (of those a term's rows fill)."""
    from pyspark.sql import functions as F

    from quire.operators import lookup
    from quire.operators.ranges import Ranges
    postings = term_frequencies(docs_small)
    probes = spark.range(20_000).select(F.lit("the").alias("term"), (F.col("id") + 10 ** 6).alias("lookup_doc_id"))
    probes = probes.union(docs_small.select(F.lit("the"), "doc_id"))
    seen, real = [], Ranges.of.__func__

    def of(cls, table, term, key, runs=None):
        out = real(cls, table, term, key, runs)
        seen.append([r["count"] for r in table.withColumn("run", out.run(term, key)).groupBy("run").count().collect()])
        return out
    monkeypatch.setattr(Ranges, "of", classmethod(of))
    got = lookup.next_geq(postings, probes, runs=16)
    assert got.where("lookup_doc_id >= 1000000 and doc_id <> -1").count() == 0
    sizes = sorted(seen[0])
    assert len(sizes) == 16 and sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_pins_leave_session_settings_alone(spark, docs_small):
    from concurrent.futures import ThreadPoolExecutor

    from quire.session import pin
    key = "spark.sql.adaptive.enabled"
    assert spark.conf.get(key) == "true"
    with ThreadPoolExecutor(2) as pool:
        a, b = pool.map(pin, [term_frequencies(docs_small), docs_small])
    assert spark.conf.get(key) == "true" and b.count() == docs_small.count() and a.count() > 0


def test_stored_index_lookup_pushes_terms_to_the_scan(spark, docs_small):
    d = tempfile.mkdtemp(prefix="quire-test-")
    B.write_index_tables(B.build_index(docs_small), f"{d}/idx", num_files=2)
    q = B.query_index(spark, B.open_index(spark, f"{d}/idx"), ["the", "chch"], 3)
    plan = _plan(q)
    assert re.search(r"PushedFilters: \[[^\]]*In\(term, \[chch,the\]", plan)
    assert q.count() == 2


def test_probes_meet_the_blocks_of_all_terms(spark, monkeypatch):
    from quire.operators import lookup
    from quire.plans import catalog
    for name in ("next_geq_blocks", "locate_block"):
        seen, real = [], getattr(lookup, name)
        monkeypatch.setattr(lookup, name, lambda blocks, *a, real=real, **k: (seen.append(blocks), real(blocks, *a, **k))[1])
        catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
        terms = seen[0].select("term").distinct().count()
        assert terms == catalog.q_doc_freq(spark, "/root/testdata/sf0.001").count() > len(catalog.PROBE_TERMS)
