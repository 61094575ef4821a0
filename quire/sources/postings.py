"""Readers of the text posting format: ``term d:tf d:tf ...`` per line.

A posting list may span several lines with the same term (one per partial
index, or one per chunk of a long list); readers concatenate them by
returning flat posting rows ``term, doc_id, tf``.

Lines may be of any length: files are read word by word (the record separator
is the blank), so Spark cuts a file, and a list that is one line of it, into
splits as usual. A word knows its term from the words before it in its split;
words before a split's first line end take the term carried over from the
splits before, a table of one row a split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import FIELD_SEP, MAX_BROADCAST_ROWS, POSTING_SEP
from ..session import pin
from .collection import Parsed

_PLACE = ["file", "block"]


def parse_posting_lines(lines: DataFrame, line_col: str = "value",
                        on_error: str = "reject") -> Parsed:
    """Flatten posting lines into ``(term, doc_id, tf)`` rows.

    A posting without ``:``, with a non-numeric part, or with a negative doc
    id or tf is rejected as ``(term posting, reason)`` (``on_error='fail'``
    raises instead). Runs of white space are one separator, also before the
    term; a term with no posting yields no row.
    """
    # Split once per line; each exploded posting carries only its term (never
    # the whole line, which for a long list would be copied per posting).
    words = lines.select(F.filter(F.split(F.col(line_col), r"\s+"), lambda w: w != "").alias("_w"))
    split = words.select(F.get("_w", 0).alias("term"),
                         F.slice("_w", 2, F.greatest(F.size("_w") - 1, F.lit(1))).alias("_p"))
    items = split.select("term", F.explode_outer("_p").alias("posting")).where(
        F.col("posting").isNotNull() & (F.col("term") != ""))
    return _parse_items(items, on_error)


def _parse_items(items: DataFrame, on_error: str) -> Parsed:
    """Good and rejected rows of ``items(term, posting)``; if they have
    ``doc_id`` and ``tf``, rows without a ``posting`` are parsed already."""
    colon = F.instr("posting", POSTING_SEP)
    doc_id = F.split_part("posting", F.lit(POSTING_SEP), F.lit(1)).try_cast("bigint")
    tf = F.split_part("posting", F.lit(POSTING_SEP), F.lit(2)).try_cast("bigint")
    if "doc_id" in items.columns:
        doc_id, tf = [F.when(F.col("posting").isNull(), F.col(c)).otherwise(word) for c, word in (("doc_id", doc_id), ("tf", tf))]
    reason = (F.when(colon == 0, F.lit("posting without colon"))
              .when(doc_id.isNull() | tf.isNull(), F.lit("posting not a number"))
              .when((doc_id < 0) | (tf < 0), F.lit("negative doc id or tf")))
    staged = items.select("term", doc_id.alias("doc_id"), tf.alias("tf"), "posting",
                          reason.alias("reason"))
    if on_error == "fail":
        staged = staged.withColumn(
            "reason",
            F.when(F.col("reason").isNull(), F.col("reason")).otherwise(
                F.raise_error(F.concat(F.lit("malformed posting: "), F.col("posting"))).cast("string")),
        )
    good = staged.where(F.col("reason").isNull()).select("term", "doc_id", "tf")
    rejects = staged.where(F.col("reason").isNotNull()).select(
        F.concat_ws(FIELD_SEP, "term", "posting").alias("line"),
        F.concat(F.col("reason"), F.lit(": "), F.col("posting")).alias("reason"))
    return Parsed(good, rejects)


class _Split:
    """What one split of a file says of the splits after it."""

    def __init__(self, place: tuple):
        self.place = place
        self.term: str | None = None           # of the line that is open
        self.awaits = False                    # the next word is a term
        self.defined = False                   # a line end was seen
        self.first: str | None = None          # the first word before any line end
        self.leading = 0                       # words before the first line end


_SPACE = np.isin(np.arange(256), np.frombuffer(b" \t\n\x0b\f\r", np.uint8))


def _strings(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(data))


def _numbers(data: np.ndarray, ends: np.ndarray, digits: np.ndarray) -> np.ndarray:
    """Numbers of so many digits that end before ``ends``."""
    out = np.zeros(len(ends), np.int64)
    for k in range(int(digits.max()) if len(digits) else 0):
        rows = np.flatnonzero(digits > k)
        out[rows] += (data[ends[rows] - 1 - k] - 48).astype(np.int64) * 10 ** k
    return out


def _postings(data: np.ndarray, lengths: np.ndarray) -> tuple[pa.Array, pa.Array, pa.Array]:
    """``doc_id, tf`` of the words that are two numbers of up to 18 digits with
    a colon between them, and the text of the other words."""
    starts = np.cumsum(lengths) - lengths
    if not len(lengths):
        return pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.string())
    colon = data == ord(POSTING_SEP)
    is_digit = (data >= 48) & (data <= 57)
    plain = (np.add.reduceat(colon, starts, dtype=np.int64) == 1) & (np.add.reduceat(is_digit, starts, dtype=np.int64) == lengths - 1)
    at = np.zeros(len(lengths), np.int64)
    at[plain] = np.flatnonzero(colon & np.repeat(plain, lengths))
    left, right = at - starts, starts + lengths - at - 1
    plain &= (left > 0) & (left <= 18) & (right > 0) & (right <= 18)
    doc, tf = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    doc[plain] = _numbers(data, at[plain], left[plain])
    tf[plain] = _numbers(data, (starts + lengths)[plain], right[plain])
    odd = pa.array(np.where(plain, 0, np.cumsum(~plain) - 1), mask=plain)
    texts = _strings(data[np.repeat(~plain, lengths)], lengths[~plain])
    return pa.array(doc, mask=~plain), pa.array(tf, mask=~plain), texts.take(odd)


_SCANNED = ("file long, block long, nth long, term string, doc_id bigint, tf bigint, posting string, "
            "defined boolean, awaits boolean, first string")
_KINDS = pa.schema([("file", pa.int64()), ("block", pa.int64()), ("nth", pa.int64()), ("term", pa.string()), ("doc_id", pa.int64()),
                    ("tf", pa.int64()), ("posting", pa.string()), ("defined", pa.bool_()), ("awaits", pa.bool_()), ("first", pa.string())])


def _scan(batches: Iterator[pa.RecordBatch], ends_only: bool) -> Iterator[pa.RecordBatch]:
    """Words of files in order (``value, file, block``) as a row for each
    posting: ``term, doc_id, tf``, or ``posting`` if it is not plain numbers.
    ``nth`` counts the words before the split's first line end, whose term is
    not known here, from 0, and is NULL for others, as is their place. With
    ``ends_only`` instead a row for each split (:class:`_Split`)."""
    split, done = None, []

    def rows(words: pa.Array) -> pa.RecordBatch | None:
        """The next words of the split."""
        text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), FIELD_SEP)
        raw = text[0].as_buffer()
        data = np.frombuffer(raw, np.uint8)
        space = _SPACE[data]
        edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
        starts, lengths = edge[::2], edge[1::2] - edge[::2]
        ends = np.flatnonzero(data == 10)
        line = np.searchsorted(ends, starts)
        known, n = split.defined, len(starts)
        heads = np.diff(line, prepend=0) > 0
        if n and line[0] == 0 and known and split.awaits:
            heads[0] = True
        before = 0 if known else int(np.searchsorted(line, 1))
        data = data[~space]
        head_bytes = np.repeat(heads, lengths)
        terms = _strings(data[head_bytes], lengths[heads])
        if before and split.first is None:
            split.first = data[:lengths[0]].tobytes().decode(errors="replace")
        open_term = pa.array([split.term if known else None], pa.string())
        nth = pa.array(np.arange(split.leading, split.leading + before))
        split.leading += before
        if len(terms):
            split.term = terms[-1].as_py()
            split.awaits = False
        if len(ends):
            split.defined = True
            if not n or line[-1] < len(ends):
                split.term, split.awaits = None, True
        if ends_only:
            return None
        doc, tf, posting = _postings(data[~head_bytes], lengths[~heads])
        of = np.cumsum(heads)[~heads]
        named = pa.concat_arrays([open_term, terms]).take(pa.array(of))
        rest = len(of) - before
        place = [pa.array([p] * before, pa.int64()) for p in split.place]
        none = [pa.nulls(rest, pa.int64())]
        columns = [pa.concat_arrays([c, *none]) for c in (*place, nth)] + [named, doc, tf, posting]
        return pa.RecordBatch.from_arrays(columns + [pa.nulls(len(of), f.type) for f in list(_KINDS)[7:]], schema=_KINDS)

    for batch in batches:
        values, files, blocks = batch.column(0), batch.column(1).to_numpy(), batch.column(2).to_numpy()
        cuts = [0, *(np.flatnonzero((files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])) + 1).tolist(), batch.num_rows]
        for s, e in zip(cuts, cuts[1:]):
            if s == e:
                continue
            place = (int(files[s]), int(blocks[s]))
            if split is None or split.place != place:
                split = _Split(place)
                done.append(split)
            out = rows(values.slice(s, e - s))
            if out is not None and out.num_rows:
                yield out
    if not ends_only:
        return
    yield pa.RecordBatch.from_pylist(
        [{"file": d.place[0], "block": d.place[1], "term": d.term, "defined": d.defined, "awaits": d.awaits, "first": d.first} for d in done],
        schema=_KINDS)


def _carried(ends: DataFrame) -> DataFrame:
    """``file, block, carried, named``: the term that is open where a split
    begins, and whether the split's first word is that term itself."""
    by_file = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # splits without a line end belong to the last one before them that has one
    told = F.struct("awaits", "term")
    last = F.last(F.when(F.col("defined"), told), ignorenulls=True).over(by_file)
    groups = ends.withColumn("_last", last).withColumn("_group", F.coalesce(F.sum(F.col("defined").cast("int")).over(by_file), F.lit(0)))
    in_group = Window.partitionBy("file", "_group").orderBy("block")
    open_term = F.coalesce(F.col("_last.awaits"), F.lit(True))     # a file begins with a term
    before = F.first("first", ignorenulls=True).over(in_group.rowsBetween(Window.unboundedPreceding, -1))
    return groups.select(
        "file", "block",
        F.when(open_term, F.coalesce(before, "first")).otherwise(F.col("_last.term")).alias("carried"),
        (open_term & before.isNull()).alias("named"))


def _read(spark: SparkSession, path: str, on_error: str, **options: str) -> Parsed:
    # a file is told by its name's hash: a word is shorter than any name
    words = spark.read.options(lineSep=FIELD_SEP, **options).text(path).select(
        "value", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    # one row a split, found in one pass without parsing a posting
    ends = pin(words.mapInArrow(lambda b: _scan(b, True), _SCANNED).select(*_PLACE, "defined", "awaits", "term", "first").repartition("file"))
    items = words.mapInArrow(lambda b: _scan(b, False), _SCANNED).select(*_PLACE, "nth", "term", "doc_id", "tf", "posting")
    carried = _carried(ends)
    parsed = ["doc_id", "tf", "posting"]
    if ends.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS:
        # one pass: words that know their term have a NULL place, which meets nothing
        told = items.join(F.broadcast(carried), _PLACE, "left")
        known = told.where("nth is null or not (named and nth = 0)").select(F.coalesce("term", "carried").alias("term"), *parsed)
    else:
        leading = items.where("nth is not null").drop("term").join(carried, _PLACE).where("not (named and nth = 0)")
        known = items.where("nth is null").select("term", *parsed).unionByName(
            leading.select(F.col("carried").alias("term"), *parsed))
    return _parse_items(known, on_error)


def read_postings_text(spark: SparkSession, path: str, on_error: str = "reject") -> Parsed:
    """Read posting text files (a file, a glob, or a folder); a line may be
    longer than a split."""
    return _read(spark, path, on_error)


def read_postings_dir(spark: SparkSession, directory: str, on_error: str = "reject") -> Parsed:
    """Read every ``*.txt`` directly inside ``directory`` (not recursive).

    The order of the files does not matter: the merge orders by doc id, so a
    run named ``_10`` sorting before ``_2`` cannot scramble a list.
    """
    return _read(spark, directory, on_error, pathGlobFilter="*.txt", recursiveFileLookup="false")
