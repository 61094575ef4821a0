import tempfile

from quire.operators import layout, prefix
from quire.operators.index import term_frequencies
from quire.sinks.text import write_block_meta, write_doc_lengths, write_lexicon
from quire.operators.index import doc_lengths
from quire.sources.tables import attach_block_terms, read_block_meta, read_doc_lengths, read_lexicon

from conftest import rows


def _write(path, data: bytes):
    with open(path, "wb") as f:
        f.write(data)


def test_lexicon_reader_last_wins_and_rejects(spark):
    d = tempfile.mkdtemp(prefix="quire-test-")
    _write(f"{d}/lex.txt", b"a 0 4 2\nb 4 3 x\nbroken\na 9 9 9\nc 7 3 1\n")
    good, rejects = read_lexicon(spark, f"{d}/lex.txt")
    assert rows(good) == [("a", 9, 9, 9), ("c", 7, 3, 1)]
    assert sorted(r["line"] for r in rejects.collect()) == ["b 4 3 x", "broken"]


def test_page_table_reader(spark):
    d = tempfile.mkdtemp(prefix="quire-test-")
    _write(f"{d}/pt.tsv", b"0\t5\n1\t0\nbad\n0\t7\n")
    good, rejects = read_doc_lengths(spark, f"{d}/pt.tsv")
    assert rows(good) == [(0, 7), (1, 0)]
    assert rejects.count() == 1


def test_side_files_round_trip(spark, docs_small):
    tf = term_frequencies(docs_small)
    blocks = layout.posting_blocks(layout.posting_gaps(tf), with_payload=False)
    offs = prefix.block_offsets(blocks)
    lex = prefix.lexicon(blocks)
    d = tempfile.mkdtemp(prefix="quire-test-")
    write_lexicon(lex, f"{d}/lexicon", num_files=3)
    write_block_meta(blocks, f"{d}/blockmeta", num_files=1)
    write_doc_lengths(doc_lengths(docs_small), f"{d}/pagetable", num_files=2)
    lex_back, rj = read_lexicon(spark, f"{d}/lexicon")
    assert rj.count() == 0 and rows(lex_back) == rows(lex)
    pt_back, _ = read_doc_lengths(spark, f"{d}/pagetable")
    assert rows(pt_back) == rows(doc_lengths(docs_small))
    meta, rj = read_block_meta(spark, f"{d}/blockmeta")
    assert rj.count() == 0
    keyed = attach_block_terms(meta, lex_back)
    assert rows(keyed, "term", "block_no", "n_bytes", "last_doc_id", "offset") == \
        rows(offs, "term", "block_no", "n_bytes", "last_doc_id", "offset")
