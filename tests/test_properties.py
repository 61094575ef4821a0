"""Property tests against brute force on small random fixtures."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quire.operators import layout, lookup

from conftest import rows

_postings = st.dictionaries(
    keys=st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(min_value=0, max_value=400)),
    values=st.integers(min_value=1, max_value=20000),
    min_size=1, max_size=150)
_probes = st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d"]), st.integers(min_value=0, max_value=450)),
                   min_size=1, max_size=40)
_settings = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def _frames(spark, post, probes):
    p = spark.createDataFrame([(t, d, tf) for (t, d), tf in post.items()],
                              "term STRING, doc_id BIGINT, tf BIGINT")
    q = spark.createDataFrame(probes, "term STRING, lookup_doc_id BIGINT")
    return p, q


def _brute(post, probes):
    out = []
    for t, d in probes:
        hits = sorted((doc, tf) for (term, doc), tf in post.items() if term == t and doc >= d)
        out.append((t, d) + (hits[0] if hits else (-1, -1)))
    return sorted(out)


@_settings
@given(post=_postings, probes=_probes, width=st.sampled_from([3, 16, 1 << 16]))
def test_next_geq_matches_brute_force(spark, post, probes, width):
    p, q = _frames(spark, post, probes)
    assert rows(lookup.next_geq(p, q, runs=width)) == _brute(post, probes)
    blocks = layout.posting_blocks(layout.posting_gaps(p, runs=width, block_size=64))
    assert rows(lookup.next_geq_blocks(blocks, q, runs=width)) == _brute(post, probes)


@_settings
@given(post=_postings, width=st.sampled_from([2, 7, 1 << 16]), lay=st.sampled_from(["split", "interleaved"]))
def test_blocks_round_trip_and_sizes(spark, post, width, lay):
    p, _ = _frames(spark, post, [("a", 0)])
    blocks = layout.posting_blocks(layout.posting_gaps(p, runs=width), layout=lay)
    assert rows(layout.decode_blocks(blocks, layout=lay)) == sorted((t, d, tf) for (t, d), tf in post.items())
    for r in blocks.collect():
        assert len(r["payload"]) == r["n_bytes"]
        assert 1 <= r["n_postings"] <= 64
