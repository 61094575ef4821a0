"""An index that takes in runs one by one, rewriting only what a run touches.

Stored layout under one folder (all Parquet):

* ``borders/``   number, term, doc_id: fixed at creation, they cut the (term,
                 doc id) order into ranges, even in postings then; a hot term
                 has several, so a run of new documents meets only its last;
* ``postings/gen=<g>/rng=<r>/``  term, doc_id, tf, sorted in each file: range
                 ``r`` as the run ``g`` left it;
* ``manifest/gen=<g>/``  rng, data_gen: for each range, the generation that
                 holds it after run ``g``.

A run is dealt by the borders, checked (``validate_postings``) together with
those current rows of its own ranges that are of a document the run has too -
only they can be copies; the others were checked when they came - and written
with the rest of these ranges as a new generation. The manifest is written last, as one file: until it stands, readers see the index
as it was, and a run that failed half-way is simply given again. Ranges that no
run touched stay the files they were. Old generations are never changed;
:func:`unused` lists what no range needs any more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import TASK_ROWS
from ..operators import index as idx
from ..operators.lookup import small
from ..operators.ranges import Ranges
from ..session import pin

_COLUMNS = ["term", "doc_id", "tf"]
# Rows that a task sorts into one file of a range.
_SORT_ROWS = 4 * TASK_ROWS


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _write(rows: DataFrame, borders: Ranges, path: str, gen: int, untouched: dict[int, int], size: int) -> None:
    """Rows of whole ranges (``term, doc_id, tf, rng``, about ``size`` of them)
    as generation ``gen``, then the manifest. A range is sorted by as many
    tasks as its share of the rows asks for."""
    spark = rows.sparkSession
    ranges = len(borders.borders) + 1
    share = max(1, -(-size // (ranges * _SORT_ROWS)))
    place = F.col("rng") * share + F.pmod(F.xxhash64("term", "doc_id"), F.lit(share)).cast("int")
    target = f"{path}/postings/gen={gen}"
    (rows.repartitionById(ranges * share, place).sortWithinPartitions("rng", "term", "doc_id")
     .write.mode("overwrite").partitionBy("rng").parquet(target))
    written = spark.read.schema("term STRING, doc_id BIGINT, tf BIGINT, rng INT").parquet(target)
    touched = [r["rng"] for r in written.select("rng").distinct().collect()]     # at most one a range
    now = {**untouched, **dict.fromkeys(touched, gen)}
    (spark.createDataFrame(sorted(now.items()), "rng INT, data_gen INT").coalesce(1)
     .write.mode("overwrite").parquet(f"{path}/manifest/gen={gen}"))


def create(postings: DataFrame, path: str, ranges: int | None = None) -> DataFrame:
    """Store the postings of the first run; returns the rejected ones. The
    folder must not hold an index yet."""
    spark = postings.sparkSession
    if _exists(spark, f"{path}/borders"):
        raise ValueError(f"{path} holds an index already")
    good, rejects = idx.validate_postings(pin(postings.select(*_COLUMNS)))
    good = pin(good)
    borders = Ranges.of(good, "term", "doc_id", ranges)
    rows = [(i, t, d) for i, (t, d) in enumerate(borders.borders)]
    spark.createDataFrame(rows, "number INT, term STRING, doc_id BIGINT").coalesce(1).write.parquet(f"{path}/borders")
    _write(good.withColumn("rng", borders.run("term", "doc_id")), borders, path, 0, {}, borders.rows)
    return rejects


def _borders(spark: SparkSession, path: str) -> Ranges:
    # fixed at creation: as many rows as ranges
    rows = spark.read.parquet(f"{path}/borders").orderBy("number").collect()
    return Ranges([(r["term"], r["doc_id"]) for r in rows])


def manifest(spark: SparkSession, path: str) -> tuple[int, dict[int, int]]:
    """The last run's number, and the generation of each range that has rows."""
    table = spark.read.parquet(f"{path}/manifest")
    last = table.agg(F.max("gen")).first()[0]
    return last, {r["rng"]: r["data_gen"] for r in table.where(F.col("gen") == last).collect()}


def _ranges(spark: SparkSession, path: str, current: dict[int, int]) -> DataFrame:
    """Current rows of the given ranges and their ``rng``: a filter on folders."""
    by_gen: dict[int, list[int]] = {}
    for rng, gen in current.items():
        by_gen.setdefault(gen, []).append(rng)
    table = spark.read.schema("term STRING, doc_id BIGINT, tf BIGINT, gen INT, rng INT").parquet(f"{path}/postings")
    wanted = F.lit(False)
    for gen, rngs in by_gen.items():
        wanted = wanted | ((F.col("gen") == gen) & F.col("rng").isin(rngs))
    return table.where(wanted).select(*_COLUMNS, "rng")


def merge_run(spark: SparkSession, path: str, run: DataFrame) -> DataFrame:
    """Take one more run in; returns what was rejected: postings of the run
    that the index has already with another tf are rejected with the
    index's own, equal copies are reported and kept once."""
    borders = _borders(spark, path)
    last, current = manifest(spark, path)
    new = pin(run.select(*_COLUMNS).withColumn("rng", borders.run("term", "doc_id")))
    touched = {r["rng"] for r in new.select("rng").distinct().collect()}
    old = _ranges(spark, path, {r: g for r, g in current.items() if r in touched})
    # Copies have a document that both sides know: other rows need no check again.
    docs = pin(old.select("doc_id").distinct().join(new.select("doc_id").distinct(), "doc_id"))
    given, rest = new.select(*_COLUMNS), old
    if docs.count():
        given = pin(idx.merge_indexes(old.join(small(docs), "doc_id", "left_semi"), given))
        rest = old.join(small(docs), "doc_id", "left_anti").select(*old.columns)
    good, rejects = idx.validate_postings(given)
    rows = rest.unionByName(good.withColumn("rng", borders.run("term", "doc_id")))
    _write(rows, borders, path, last + 1, {r: g for r, g in current.items() if r not in touched}, old.count() + new.count())
    return rejects


def open_postings(spark: SparkSession, path: str) -> DataFrame:
    """``term, doc_id, tf`` of the index after its last run."""
    return _ranges(spark, path, manifest(spark, path)[1]).select(*_COLUMNS)


def unused(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """``(gen, rng)`` folders that the last manifest does not name."""
    _, current = manifest(spark, path)
    stored = spark.read.parquet(f"{path}/postings").select("gen", "rng").distinct().collect()
    return sorted((r["gen"], r["rng"]) for r in stored if current.get(r["rng"]) != r["gen"])
