"""

``entry(spark)`` runs the flagship query (look up the query terms and probe
each list at doc 3) on sf0.001; ``queries()`` lists every registered query
over its whole tables; ``oracle_sql()`` gives the DuckDB SQL
that computes the same rows independently.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quire.plans.catalog import (FILE_LINE_POSTINGS, LINE_POSTINGS, MODULUS, OUTLIER, PROBE_TERMS, QUERIES,  # noqa: E402
                                 QUERY_DOC_ID, QUERY_TERMS, SCATTER)
from quire.session import ensure_checkpoint_dir  # noqa: E402

try:  # the training-data operators may be absent; nothing else depends on them
    from quire.llm.queries import ORACLE as LLM_ORACLE
    from quire.llm.queries import QUERIES as LLM_QUERIES
except ModuleNotFoundError as e:
    if e.name not in ("quire.llm", "quire.llm.queries"):
        raise
    LLM_QUERIES, LLM_ORACLE = {}, {}
try:
    import corpus_pipeline
except ModuleNotFoundError as e:
    if e.name not in ("corpus_pipeline", "quire.llm"):
        raise
else:
    LLM_QUERIES = {**LLM_QUERIES, "pipeline": corpus_pipeline.run}
    if corpus_pipeline.ORACLE_SQL:
        LLM_ORACLE = {**LLM_ORACLE, "pipeline": corpus_pipeline.ORACLE_SQL}

FLAGSHIP_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """
    first, first posting at or after doc 3 in each list."""
    ensure_checkpoint_dir(spark)
    return QUERIES["query_terms"](spark, FLAGSHIP_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def with_ckpt(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_checkpoint_dir(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        return run
    return {name: with_ckpt(fn) for name, fn in {**QUERIES, **LLM_QUERIES}.items()}


# ---------------------------------------------------------------- oracle SQL

def _vb(x: str) -> str:
    """Varbyte size of x in SQL (x >= 0)."""
    arms = " ".join(f"WHEN {x} < {1 << (7 * k)} THEN {k}" for k in range(1, 9))
    return f"(CASE {arms} ELSE 9 END)"


def _vb_hex(x: str) -> str:
    n = _vb(x)
    return (f"array_to_string(list_transform(range({n}), lambda i: printf('%02X', "
            f"(({x} >> (7 * i)::INT) & 127) | (CASE WHEN i < {n} - 1 THEN 128 ELSE 0 END))), '')")


_TF = """
tf AS (
  SELECT term, doc_id, count(*)::BIGINT AS tf
  FROM (SELECT doc_id, lower(unnest(regexp_extract_all(text, '[A-Za-z0-9]+'))) AS term FROM documents)
  GROUP BY term, doc_id)"""

_G = """
g AS (
  SELECT term, doc_id, tf,
         doc_id - lag(doc_id, 1, 0) OVER (PARTITION BY term ORDER BY doc_id) AS gap,
         (row_number() OVER (PARTITION BY term ORDER BY doc_id) - 1)::BIGINT AS pos,
         ((row_number() OVER (PARTITION BY term ORDER BY doc_id) - 1) // 64)::BIGINT AS block_no
  FROM tf)"""

_B = f"""
b AS (
  SELECT term, block_no, count(*)::BIGINT AS n_postings, min(doc_id) AS first_doc_id,
         max(doc_id) AS last_doc_id, sum({_vb('gap')} + {_vb('tf')})::BIGINT AS n_bytes
  FROM g GROUP BY term, block_no)"""

_LEX = """
lex AS (
  SELECT term, (sum(length) OVER (ORDER BY term) - length)::BIGINT AS "offset", length, doc_freq
  FROM (SELECT term, sum(n_bytes)::BIGINT AS length, sum(n_postings)::BIGINT AS doc_freq
        FROM b GROUP BY term))"""


def _values(rows: list[tuple[int, str]]) -> str:
    return ", ".join(f"({i}, '{t}')" for i, t in rows)


_Q = f"""
q AS (SELECT query_pos::BIGINT AS query_pos, term
      FROM (VALUES {_values(list(enumerate(QUERY_TERMS)))}) AS v(query_pos, term))"""

_P = f"""
p AS (
  SELECT row_number() OVER () AS probe_id, term, lookup_doc_id::BIGINT AS lookup_doc_id
  FROM (SELECT t.term, d.doc_id FROM documents d,
        (VALUES {", ".join(f"('{t}')" for t in PROBE_TERMS)}) AS t(term)) AS x,
       LATERAL (SELECT unnest([x.doc_id, x.doc_id * 2 + 1]) AS lookup_doc_id))"""

_NEXT_GEQ = f"""
WITH {_TF}, {_P}
SELECT p.term, p.lookup_doc_id,
       coalesce(min(tf.doc_id), -1)::BIGINT AS doc_id,
       coalesce(arg_min(tf.tf, tf.doc_id), -1)::BIGINT AS tf
FROM p LEFT JOIN tf ON p.term = tf.term AND tf.doc_id >= p.lookup_doc_id
GROUP BY p.probe_id, p.term, p.lookup_doc_id"""

def _lines(postings: int) -> str:
    """Posting lines of at most so many postings."""
    return f"""
WITH {_TF}
SELECT term, chunk, term || ' ' || string_agg(doc_id::VARCHAR || ':' || tf::VARCHAR, ' ' ORDER BY doc_id) AS line
FROM (SELECT *, ((row_number() OVER (PARTITION BY term ORDER BY doc_id) - 1) // {postings})::BIGINT AS chunk FROM tf)
GROUP BY term, chunk"""


_LINES = _lines(LINE_POSTINGS)

# Ids far apart (another order than the documents' own) and one outlier.
_SCATTERED = f"""
s AS (SELECT CASE WHEN doc_id = 0 THEN {OUTLIER} ELSE ((doc_id::HUGEINT * {SCATTER}) % {MODULUS})::BIGINT END AS doc_id, text
      FROM documents),
tf AS (
  SELECT term, doc_id, count(*)::BIGINT AS tf
  FROM (SELECT doc_id, lower(unnest(regexp_extract_all(text, '[A-Za-z0-9]+'))) AS term FROM s)
  GROUP BY term, doc_id)"""

_KIND = """
k AS (SELECT tf.*, d.lang FROM tf JOIN documents d ON tf.doc_id = d.doc_id)"""

_ENCODE = f"""
WITH {_TF}, {_G}
SELECT term, block_no,
       string_agg({_vb_hex('gap')}, '' ORDER BY doc_id) || string_agg({_vb_hex('tf')}, '' ORDER BY doc_id)
         AS payload_hex
FROM g GROUP BY term, block_no"""

_ENCODE_INTERLEAVED = f"""
WITH {_TF}, {_G}
SELECT term, block_no, string_agg({_vb_hex('doc_id')} || {_vb_hex('tf')}, '' ORDER BY doc_id) AS payload_hex
FROM g GROUP BY term, block_no"""

_QUERY = f"""WITH {_TF}, {_Q},
        found AS (SELECT q.query_pos, q.term, d.doc_freq
                  FROM q JOIN (SELECT term, count(*)::BIGINT AS doc_freq FROM tf GROUP BY term) d
                  ON q.term = d.term),
        hit AS (SELECT term, min(doc_id) AS doc_id, arg_min(tf, doc_id) AS tf
                FROM tf WHERE doc_id >= {QUERY_DOC_ID} GROUP BY term)
        SELECT row_number() OVER (ORDER BY found.doc_freq, found.term, found.query_pos)::BIGINT
                 AS list_rank,
               found.query_pos, found.term, found.doc_freq, {QUERY_DOC_ID}::BIGINT AS lookup_doc_id,
               coalesce(hit.doc_id, -1)::BIGINT AS doc_id, coalesce(hit.tf, -1)::BIGINT AS tf
        FROM found LEFT JOIN hit ON found.term = hit.term"""

_DOC_LENGTHS = """
        SELECT doc_id, len(regexp_extract_all(text, '[A-Za-z0-9]+'))::BIGINT AS n_tokens FROM documents"""

_ORACLE = {
    "term_frequencies": f"WITH {_TF} SELECT term, doc_id, tf FROM tf",
    "doc_lengths": """
        SELECT doc_id, len(regexp_extract_all(text, '[A-Za-z0-9]+'))::BIGINT AS n_tokens FROM documents""",
    "doc_freq": f"WITH {_TF} SELECT term, count(*)::BIGINT AS doc_freq FROM tf GROUP BY term",
    "posting_lines": _LINES,
    "merge_indexes": _LINES,
    "merge_posting_files": _LINES,
    "merge_and_index": _ENCODE,
    "merge_runs_incrementally": f"WITH {_TF} SELECT term, doc_id, tf FROM tf",
    "validate_postings": f"""WITH {_TF}, {_KIND}
        SELECT term, doc_id, CASE WHEN lang = 'de' THEN 'duplicate posting x2'
                                  ELSE 'copies with tf ' || tf || ' to ' || (tf + 1) END AS reason
        FROM k WHERE lang = 'de' OR (lang = 'es' AND doc_id % 2 = 0)""",
    "validated_postings": f"""WITH {_TF}, {_KIND}
        SELECT term, doc_id, tf FROM k WHERE lang IS NULL OR NOT (lang = 'es' AND doc_id % 2 = 0)""",
    "rejected_lines": """
        SELECT md5(CASE doc_id % 5 WHEN 1 THEN doc_id || ' ' || t WHEN 2 THEN 'x' || doc_id || chr(9) || t
                   WHEN 3 THEN '-' || doc_id || chr(9) || t ELSE chr(9) || t END) AS line_md5,
               CASE doc_id % 5 WHEN 1 THEN 'no tab' WHEN 3 THEN 'negative doc id' ELSE 'doc id not a number' END AS reason
        FROM (SELECT doc_id, translate(text, chr(9) || chr(10), '  ') AS t FROM documents) WHERE doc_id % 5 <> 0""",
    "rejected_documents": """
        SELECT CASE WHEN doc_id % 3 = 1 THEN -doc_id END::BIGINT AS doc_id,
               CASE WHEN doc_id % 3 = 1 THEN 'negative doc id' ELSE 'doc id is null' END AS reason
        FROM documents WHERE doc_id % 3 <> 2""",
    "posting_file_order": f"""
        WITH lines AS ({_lines(FILE_LINE_POSTINGS).strip()})
        SELECT (row_number() OVER (ORDER BY term, chunk) - 1)::BIGINT AS line_no, term FROM lines""",
    "read_lexicon": f"WITH {_TF}, {_G}, {_B}, {_LEX} SELECT term, \"offset\", length, doc_freq FROM lex",
    "read_doc_lengths": _DOC_LENGTHS,
    "block_meta_file": f"""WITH {_TF}, {_G}, {_B}
        SELECT (row_number() OVER w - 1)::BIGINT AS block_index, n_bytes, last_doc_id,
               (sum(n_bytes) OVER w - n_bytes)::BIGINT AS "offset"
        FROM b WINDOW w AS (ORDER BY term, block_no)""",
    "posting_gaps_scattered": f"WITH {_SCATTERED}, {_G} SELECT term, doc_id, tf, gap, pos, block_no FROM g",
    "encode_blocks_interleaved": _ENCODE_INTERLEAVED,
    "posting_gaps": f"WITH {_TF}, {_G} SELECT term, doc_id, tf, gap, pos, block_no FROM g",
    "posting_blocks": f"""WITH {_TF}, {_G}, {_B}
        SELECT term, block_no, n_postings, first_doc_id, last_doc_id, n_bytes FROM b""",
    "encode_blocks": _ENCODE,
    "decode_blocks": f"WITH {_TF} SELECT term, doc_id, tf FROM tf",
    "decode_blocks_interleaved": f"WITH {_TF} SELECT term, doc_id, tf FROM tf",
    "block_offsets": f"""WITH {_TF}, {_G}, {_B}
        SELECT term, block_no,
               (sum(n_bytes) OVER (ORDER BY term, block_no) - n_bytes)::BIGINT AS "offset",
               n_bytes, last_doc_id
        FROM b""",
    "lexicon": f"WITH {_TF}, {_G}, {_B}, {_LEX} SELECT term, \"offset\", length, doc_freq FROM lex",
    "read_postings_text": f"WITH {_TF} SELECT term, doc_id, tf FROM tf",
    "read_collection": """
        SELECT doc_id, len(regexp_extract_all(text, '[A-Za-z0-9]+'))::BIGINT AS n_tokens FROM documents""",
    "lookup_terms": f"""WITH {_TF}, {_G}, {_B}, {_LEX}, {_Q}
        SELECT q.query_pos, q.term, lex."offset", lex.length, lex.doc_freq
        FROM q JOIN lex ON q.term = lex.term""",
    "missing_terms": f"""WITH {_TF}, {_Q}
        SELECT query_pos, term FROM q WHERE term NOT IN (SELECT term FROM tf)""",
    "lookup_term_list": f"""WITH {_TF}, wanted AS (
            SELECT DISTINCT lower(unnest(regexp_extract_all(text, '[A-Za-z0-9]+'))) AS term FROM benchmark)
        SELECT tf.term, count(*)::BIGINT AS doc_freq FROM tf JOIN wanted ON tf.term = wanted.term GROUP BY tf.term""",
    "next_geq": _NEXT_GEQ,
    "next_geq_blocks": _NEXT_GEQ,
    "locate_block": f"""WITH {_TF}, {_G}, {_P}
        SELECT p.term, p.lookup_doc_id,
               coalesce(arg_min(g.block_no, g.doc_id), -1)::BIGINT AS block_no
        FROM p LEFT JOIN g ON p.term = g.term AND g.doc_id >= p.lookup_doc_id
        GROUP BY p.probe_id, p.term, p.lookup_doc_id""",
    "query_terms": _QUERY,
    "query_stored_index": _QUERY,
    "stream_runs": f"WITH {_TF} SELECT term, doc_id, tf FROM tf",
    "index_stats": f"""WITH {_TF}, {_G}, {_B}
        SELECT (SELECT count(*) FROM documents)::BIGINT AS n_docs,
               (SELECT sum(len(regexp_extract_all(text, '[A-Za-z0-9]+'))) FROM documents)::BIGINT
                 AS n_tokens,
               (SELECT count(*) FROM tf)::BIGINT AS n_postings,
               (SELECT count(DISTINCT term) FROM tf)::BIGINT AS n_terms,
               (SELECT count(*) FROM b)::BIGINT AS n_blocks""",
}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query key, over the pre-registered table views."""
    return {**{k: v for k, v in _ORACLE.items() if k in QUERIES}, **LLM_ORACLE}
