"""Named end-to-end queries over a folder of tables (``documents.parquet``).

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
``documents`` table. They are what ``__spark_entry__.queries()`` and the
bench run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import LINE_POSTINGS
from ..functions.text import tokenize
from ..operators import index as idx
from ..operators import layout, lookup, prefix
from ..session import delete_on_exit, pin, scratch_path
from ..sinks import text as sinks
from ..sinks.text import posting_lines, write_postings_text
from ..sources import tables
from ..sources.collection import parse_collection_lines, read_collection, read_corpus, to_collection_lines
from ..sources.postings import read_postings_dir, read_postings_text
from ..streaming.runs import read_runs, stream_collection_runs
from . import build, incremental

# Fixed query of the checks: four terms present at every scale, one absent,
# an upper-case spelling (looked up verbatim, so missing) and a repeat.
QUERY_TERMS = ["the", "tion", "ed", "chch", "peacefully", "The", "the"]
PROBE_TERMS = ["the", "tion", "ed", "chch", "peacefully"]
QUERY_DOC_ID = 3
# Postings in one line of the sorted posting files whose order is checked: few,
# so that lists of many lines (equal terms, by chunk) take part at every scale.
FILE_LINE_POSTINGS = 256
# Shards of the corpus for the merge queries: one per language, plus the rest.
_LANGS = ["en", "de", "fr", "es"]

def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_corpus(spark, f"{sf_dir}/documents.parquet").good


def _postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idx.term_frequencies(documents(spark, sf_dir))


def _gaps(spark: SparkSession, sf_dir: str, nested: bool = False) -> DataFrame:
    return layout.posting_gaps(idx.term_frequencies(documents(spark, sf_dir), lists=True), nested=nested)


def _blocks(spark: SparkSession, sf_dir: str, with_payload: bool = True, layout_name: str = "split") -> DataFrame:
    return layout.posting_blocks(_gaps(spark, sf_dir, nested=True), with_payload=with_payload, layout=layout_name)


def _shard_postings(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Postings of each language shard, from one pass over the corpus; the
    last shard holds every other language."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    shard = F.when(F.col("lang").isin(_LANGS), F.col("lang")).otherwise("other")
    # a task orders its postings by shard: few documents for each
    tf = pin(idx.term_frequencies(docs.select("doc_id", "text", shard.alias("shard")), 8 * docs.rdd.getNumPartitions()), partition_by="shard")
    return [tf.where(F.col("shard") == s).drop("shard") for s in [*_LANGS, "other"]]


def probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probes derived from the corpus: every probe term at every document's
    id, and at 2*id+1 (which also reaches past the last document)."""
    docs = documents(spark, sf_dir).select("doc_id")
    per_term = docs.select(F.explode(F.array(*[F.lit(t) for t in PROBE_TERMS])).alias("term"), "doc_id")
    return per_term.select(
        "term", F.explode(F.array(F.col("doc_id"), F.col("doc_id") * 2 + 1)).alias("lookup_doc_id"))


def q_term_frequencies(spark, sf_dir):
    return _postings(spark, sf_dir)


def q_doc_lengths(spark, sf_dir):
    return idx.doc_lengths(documents(spark, sf_dir))


def q_doc_freq(spark, sf_dir):
    return idx.doc_freq(_postings(spark, sf_dir))


def q_posting_lines(spark, sf_dir):
    return posting_lines(_gaps(spark, sf_dir), LINE_POSTINGS)


def q_merge_indexes(spark, sf_dir):
    """Merge the partial indexes of the language shards, validate, and
    export: equals the index of the whole corpus."""
    good, _rejects = idx.validate_postings(idx.merge_indexes(*_shard_postings(spark, sf_dir)))
    return posting_lines(good, LINE_POSTINGS)


def _run_files(spark, sf_dir):
    """Each language shard's partial index as posting text runs in one folder."""
    runs = scratch_path(spark, "runs")
    for part in _shard_postings(spark, sf_dir):
        write_postings_text(part, runs, mode="append", global_order=False)
    delete_on_exit(spark, runs)
    return runs


def q_merge_posting_files(spark, sf_dir):
    """The index-then-merge flow through files: the runs' folder is read back
    (every ``*.txt``, any order), merged, validated and exported."""
    merged, _rejects = idx.validate_postings(pin(read_postings_dir(spark, _run_files(spark, sf_dir)).good))
    return posting_lines(merged, LINE_POSTINGS)


def q_merge_and_index(spark, sf_dir):
    """The merge program: run files to a compressed index, block by block."""
    lengths = idx.doc_lengths(documents(spark, sf_dir))
    index, _rejects = build.merge_runs(spark, _run_files(spark, sf_dir), lengths)
    return index.blocks.select("term", "block_no", F.hex("payload").alias("payload_hex"))


def q_merge_runs_incrementally(spark, sf_dir):
    """The language shards taken in one run after the other."""
    path = scratch_path(spark, "generations")
    first, *runs = _shard_postings(spark, sf_dir)
    incremental.create(first, path, ranges=16)
    for run in runs:
        incremental.merge_run(spark, path, run)
    delete_on_exit(spark, path)
    return incremental.open_postings(spark, path)


def _twice_german(spark, sf_dir):
    """The language shards with the German one merged twice, and every
    Spanish posting of an even document a second time with another tf."""
    parts = _shard_postings(spark, sf_dir)
    changed = parts[_LANGS.index("es")].where("doc_id % 2 = 0").withColumn("tf", F.col("tf") + 1)
    return idx.validate_postings(idx.merge_indexes(*parts, parts[_LANGS.index("de")], changed))


def q_validate_postings(spark, sf_dir):
    """What is reported when shards overlap: German postings as duplicates
    (one copy is kept), Spanish ones of even documents as contradictory."""
    return _twice_german(spark, sf_dir)[1]


def q_validated_postings(spark, sf_dir):
    """What is kept when shards overlap."""
    return _twice_german(spark, sf_dir)[0]


def q_rejected_lines(spark, sf_dir):
    """Collection lines made malformed in five ways by document id: what the
    reader rejects, as the line's digest and the reason."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.col("doc_id").cast("string").alias("i"), F.translate("text", "\t\n", "  ").alias("t"), (F.col("doc_id") % 5).alias("k"))
    line = (F.when(F.col("k") == 1, F.concat("i", F.lit(" "), "t")).when(F.col("k") == 2, F.concat(F.lit("x"), "i", F.lit("\t"), "t"))
            .when(F.col("k") == 3, F.concat(F.lit("-"), "i", F.lit("\t"), "t")).when(F.col("k") == 4, F.concat(F.lit("\t"), "t"))
            .otherwise(F.concat("i", F.lit("\t"), "t")))
    return parse_collection_lines(docs.select(line.alias("value"))).rejects.select(F.md5("line").alias("line_md5"), "reason")


def q_rejected_documents(spark, sf_dir):
    """Documents with every third id NULL and every third negative, written
    and read as a corpus: the rejects."""
    k = F.col("doc_id") % 3
    bad = F.when(k == 0, F.lit(None)).when(k == 1, -F.col("doc_id")).otherwise(F.col("doc_id")).cast("bigint")
    table = pin(spark.read.parquet(f"{sf_dir}/documents.parquet").select(bad.alias("doc_id"), "text"))
    return read_corpus(spark, table.inputFiles()[0].rsplit("/", 1)[0]).rejects


def q_posting_gaps(spark, sf_dir):
    return _gaps(spark, sf_dir).select("term", "doc_id", "tf", "gap", "pos", "block_no")


#: Scattered 64-bit ids (order differs from the documents' own) and an outlier.
SCATTER, MODULUS, OUTLIER = 1_000_003_000_017, 9_007_199_254_740_881, 4_611_686_018_427_387_904


def q_posting_gaps_scattered(spark, sf_dir):
    """Gaps over ids that are far apart, one of them an outlier."""
    i = F.col("doc_id")
    scattered = F.when(i == 0, F.lit(OUTLIER)).otherwise(F.pmod(i.cast("decimal(38,0)") * SCATTER, F.lit(MODULUS)).cast("bigint"))
    docs = documents(spark, sf_dir).select(scattered.alias("doc_id"), "text")
    return layout.posting_gaps(idx.term_frequencies(docs, lists=True)).select("term", "doc_id", "tf", "gap", "pos", "block_no")


def q_posting_blocks(spark, sf_dir):
    return _blocks(spark, sf_dir, with_payload=False)


def q_encode_blocks(spark, sf_dir):
    return _blocks(spark, sf_dir).select("term", "block_no", F.hex("payload").alias("payload_hex"))


def q_encode_blocks_interleaved(spark, sf_dir):
    blocks = _blocks(spark, sf_dir, layout_name="interleaved")
    return blocks.select("term", "block_no", F.hex("payload").alias("payload_hex"))


def q_decode_blocks(spark, sf_dir):
    return layout.decode_blocks(_blocks(spark, sf_dir))


def q_decode_blocks_interleaved(spark, sf_dir):
    blocks = _blocks(spark, sf_dir, layout_name="interleaved")
    return layout.decode_blocks(blocks, layout="interleaved")


def q_block_offsets(spark, sf_dir):
    return prefix.block_offsets(_blocks(spark, sf_dir, with_payload=False)).select(
        "term", "block_no", "offset", "n_bytes", "last_doc_id")


def q_lexicon(spark, sf_dir):
    return prefix.lexicon(_blocks(spark, sf_dir, with_payload=False))


def q_read_postings_text(spark, sf_dir):
    """Write posting text files and read them back."""
    path = scratch_path(spark, "postings")
    write_postings_text(_gaps(spark, sf_dir), path, chunk_size=LINE_POSTINGS)
    delete_on_exit(spark, path)
    return read_postings_text(spark, path).good


def q_posting_file_order(spark, sf_dir):
    """Line number and term of every line of the sorted posting files."""
    path = scratch_path(spark, "postings")
    write_postings_text(_gaps(spark, sf_dir), path, chunk_size=FILE_LINE_POSTINGS)
    delete_on_exit(spark, path)
    lines = tables.numbered_lines(spark, path)
    return lines.select("line_no", F.split_part("value", F.lit(" "), F.lit(1)).alias("term"))


def q_read_lexicon(spark, sf_dir):
    """The lexicon through its text file."""
    path = scratch_path(spark, "lexicon")
    sinks.write_lexicon(_lexicon(spark, sf_dir), path)
    delete_on_exit(spark, path)
    return tables.read_lexicon(spark, path).good


def q_read_doc_lengths(spark, sf_dir):
    """The page table through its text file."""
    path = scratch_path(spark, "lengths")
    sinks.write_doc_lengths(idx.doc_lengths(documents(spark, sf_dir)), path)
    delete_on_exit(spark, path)
    return tables.read_doc_lengths(spark, path).good


def q_block_meta_file(spark, sf_dir):
    """Block metadata through its text file: position, size, last id."""
    path = scratch_path(spark, "meta")
    sinks.write_block_meta(_blocks(spark, sf_dir, with_payload=False), path)
    delete_on_exit(spark, path)
    return tables.read_block_meta(spark, path).good


def q_query_stored_index(spark, sf_dir):
    """Build an index, store it, open it and query the stored form."""
    path = scratch_path(spark, "index")
    build.write_index_tables(build.build_index(documents(spark, sf_dir)), path)
    delete_on_exit(spark, path)
    return build.query_index(spark, build.open_index(spark, path), QUERY_TERMS, QUERY_DOC_ID)


def q_read_collection(spark, sf_dir):
    """Write the corpus as a ``docID<TAB>passage`` collection file, read it
    back with the collection reader, and count tokens per document."""
    path = scratch_path(spark, "collection")
    to_collection_lines(documents(spark, sf_dir)).write.option("lineSep", "\n").text(path)
    delete_on_exit(spark, path)
    return idx.doc_lengths(read_collection(spark, path).good)


def _lexicon(spark, sf_dir):
    return prefix.lexicon(_blocks(spark, sf_dir, with_payload=False))


def q_lookup_terms(spark, sf_dir):
    query = lookup.query_frame(spark, QUERY_TERMS)
    return lookup.lookup_terms(query, _lexicon(spark, sf_dir)).select(
        "query_pos", "term", "offset", "length", "doc_freq")


def q_missing_terms(spark, sf_dir):
    query = lookup.query_frame(spark, QUERY_TERMS)
    lex = idx.doc_freq(_postings(spark, sf_dir))
    return lookup.missing_terms(query, lex).select("query_pos", "term")


def q_lookup_term_list(spark, sf_dir):
    """The distinct terms of the benchmark texts, as a long query list, in
    the corpus' lexicon cut down by their Bloom filter."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    terms = items.select(F.explode_outer(tokenize(F.col("text"))).alias("term")).where("term is not null").distinct()
    return lookup.lookup_terms(terms, idx.doc_freq(_postings(spark, sf_dir)), broadcast_rows=0).select("term", "doc_freq")


def q_next_geq(spark, sf_dir):
    return lookup.next_geq(_postings(spark, sf_dir), probes(spark, sf_dir))


def _stored_blocks(spark, sf_dir, with_payload):
    """The stored block table of the whole corpus."""
    return pin(_blocks(spark, sf_dir, with_payload=with_payload))


def q_next_geq_blocks(spark, sf_dir):
    return lookup.next_geq_blocks(_stored_blocks(spark, sf_dir, True), probes(spark, sf_dir))


def q_locate_block(spark, sf_dir):
    return lookup.locate_block(_stored_blocks(spark, sf_dir, False), probes(spark, sf_dir))


def q_query_terms(spark, sf_dir):
    return lookup.query_terms(spark, QUERY_TERMS, _postings(spark, sf_dir), QUERY_DOC_ID)


def q_stream_runs(spark, sf_dir):
    """Index the documents table, a file or a folder of files, as a stream
    (one run per micro-batch of files), then merge the runs: equals the batch
    index."""
    runs, table = scratch_path(spark, "runs"), f"{sf_dir}/documents.parquet"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    source = {"source": table} if fs.getFileStatus(path).isDirectory() else {"source": sf_dir, "file_filter": "documents.parquet"}
    query = stream_collection_runs(spark, runs_path=runs, checkpoint_location=f"{runs}/_stream",
                                   source_format="parquet", **source)
    query.awaitTermination()
    delete_on_exit(spark, runs)
    postings, _rejects = read_runs(spark, runs)
    return postings


def q_index_stats(spark, sf_dir):
    return idx.index_stats(documents(spark, sf_dir), _postings(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "term_frequencies": q_term_frequencies,
    "doc_lengths": q_doc_lengths,
    "doc_freq": q_doc_freq,
    "posting_lines": q_posting_lines,
    "merge_indexes": q_merge_indexes,
    "merge_posting_files": q_merge_posting_files,
    "merge_and_index": q_merge_and_index,
    "merge_runs_incrementally": q_merge_runs_incrementally,
    "validate_postings": q_validate_postings,
    "validated_postings": q_validated_postings,
    "rejected_lines": q_rejected_lines,
    "rejected_documents": q_rejected_documents,
    "posting_gaps": q_posting_gaps,
    "posting_gaps_scattered": q_posting_gaps_scattered,
    "posting_blocks": q_posting_blocks,
    "encode_blocks": q_encode_blocks,
    "encode_blocks_interleaved": q_encode_blocks_interleaved,
    "decode_blocks": q_decode_blocks,
    "decode_blocks_interleaved": q_decode_blocks_interleaved,
    "block_offsets": q_block_offsets,
    "lexicon": q_lexicon,
    "read_postings_text": q_read_postings_text,
    "posting_file_order": q_posting_file_order,
    "read_lexicon": q_read_lexicon,
    "read_doc_lengths": q_read_doc_lengths,
    "block_meta_file": q_block_meta_file,
    "query_stored_index": q_query_stored_index,
    "read_collection": q_read_collection,
    "lookup_terms": q_lookup_terms,
    "missing_terms": q_missing_terms,
    "lookup_term_list": q_lookup_term_list,
    "next_geq": q_next_geq,
    "next_geq_blocks": q_next_geq_blocks,
    "locate_block": q_locate_block,
    "query_terms": q_query_terms,
    "index_stats": q_index_stats,
    "stream_runs": q_stream_runs,
}
