"""End-to-end plans: build an index from documents, store it, open it, and
answer queries on the stored form.

Stored layout under one folder (all Parquet):

* ``blocks/``       term, block_no, n_postings, first_doc_id, last_doc_id,
                    n_bytes, payload, sorted by (term, block_no), so row-group
                    min/max on ``term`` prunes a lookup's reads;
* ``lexicon/``      term, offset, length, doc_freq, sorted by term;
* ``doc_lengths/``  doc_id, n_tokens, sorted by doc_id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import LINE_POSTINGS, MAX_LITERAL_TERMS
from ..operators import index as idx
from ..operators import layout, lookup, prefix
from ..session import pin
from ..sinks.text import ordered, posting_lines, write_index
from ..sources.postings import read_postings_dir


@dataclass
class InvertedIndex:
    blocks: DataFrame
    lexicon: DataFrame
    doc_lengths: DataFrame

    def postings(self) -> DataFrame:
        """Posting rows decoded from the blocks (map-only)."""
        return layout.decode_blocks(self.blocks)


def dump_index_text(blocks: DataFrame, layout_name: str = "split",
                    chunk_size: int = LINE_POSTINGS) -> DataFrame:
    """Readable posting lines (``term, chunk, line``) from a block table of
    either payload layout: decode every block, then render the lines."""
    return posting_lines(layout.decode_blocks(blocks, layout=layout_name), chunk_size)


def build_index_from_postings(postings: DataFrame, lengths: DataFrame,
                              runs: int | None = None) -> InvertedIndex:
    """Index posting rows (of documents, of merged runs): gap + varbyte
    blocks of 64, lexicon with global byte offsets, page table.

    Blocks are written once, sorted by (term, block_no) inside each file; the
    lexicon reads their sizes only, so payloads cross the network once."""
    gaps = layout.posting_gaps(postings, runs=runs, nested=True)
    blocks = pin(layout.posting_blocks(gaps).sortWithinPartitions("term", "block_no"))
    return InvertedIndex(blocks, prefix.lexicon(blocks.select("term", "n_bytes", "n_postings")), lengths)


def build_index(docs: DataFrame, runs: int | None = None) -> InvertedIndex:
    """Index ``doc_id, text`` documents. Rows with a NULL or negative id are
    left out (``index.invalid_documents`` lists them)."""
    docs, _ = idx.invalid_documents(docs)
    postings = idx.term_frequencies(docs, lists=True)
    return build_index_from_postings(postings, idx.doc_lengths(docs), runs)


def merge_runs(spark: SparkSession, directory: str, lengths: DataFrame,
               runs: int | None = None) -> tuple[InvertedIndex, DataFrame]:
    """The merge program: every posting text run of a folder becomes one
    index. Returns it and the rejected postings (``line, reason``)."""
    parsed = read_postings_dir(spark, directory)
    good, duplicates = idx.validate_postings(pin(parsed.good))
    rejects = parsed.rejects.unionByName(duplicates.select(
        F.concat_ws(" ", "term", F.col("doc_id").cast("string")).alias("line"), "reason"))
    return build_index_from_postings(good, lengths, runs), rejects


def merge_partial_indexes(partials: list[DataFrame],
                          on_duplicate: str = "reject") -> tuple[DataFrame, DataFrame]:
    """Merge partial posting tables into one set of posting rows.

    Returns ``(postings, rejects)``; with ``on_duplicate='fail'`` a
    duplicate (term, doc_id) raises instead. ``build_index_from_postings``
    turns the postings into an index."""
    good, rejects = idx.validate_postings(idx.merge_indexes(*partials))
    if on_duplicate == "fail":
        good = good.unionByName(rejects.select(
            "term", "doc_id", F.raise_error(F.concat(F.lit("rejected posting: "), F.col("reason")))
            .cast("bigint").alias("tf")))
    return good, rejects


def write_index_tables(index: InvertedIndex, path: str, num_files: int | None = None,
                       mode: str = "overwrite", global_order: bool = False) -> None:
    """Write the three tables. Block files are by default only sorted inside
    (no further shuffle of the largest table); pass ``global_order=True`` for
    files that are also ordered among each other."""
    write_index(index.blocks, f"{path}/blocks", num_files, mode, global_order=global_order)
    n = num_files or int(index.lexicon.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (ordered(index.lexicon, ["term"], n)
     .write.mode(mode).parquet(f"{path}/lexicon"))
    (ordered(index.doc_lengths, ["doc_id"], n)
     .write.mode(mode).parquet(f"{path}/doc_lengths"))


def open_index(spark: SparkSession, path: str) -> InvertedIndex:
    return InvertedIndex(spark.read.parquet(f"{path}/blocks"),
                         spark.read.parquet(f"{path}/lexicon"),
                         spark.read.parquet(f"{path}/doc_lengths"))


def query_index(spark: SparkSession, index: InvertedIndex, terms: list[str], doc_id: int,
                runs: int | None = None) -> DataFrame:
    """The lookup program on a stored index: look the terms up in the
    lexicon, order the lists rarest first, and probe each at ``doc_id`` by
    decoding only the one block that can hold the answer.

    ``list_rank, query_pos, term, doc_freq, lookup_doc_id, doc_id, tf``.
    A few terms go to the scans as a literal filter, which row-group
    statistics can use; more are joined."""
    query = lookup.query_frame(spark, terms)
    wanted = sorted(set(terms))

    def cut(table: DataFrame) -> DataFrame:
        if len(wanted) <= MAX_LITERAL_TERMS:
            return table.where(F.col("term").isin(wanted))
        return table.join(query.select("term").distinct(), "term", "left_semi")

    probes = lookup.ranked_probes(query, cut(index.lexicon), doc_id)
    return lookup.next_geq_blocks(cut(index.blocks), probes, runs=runs)
