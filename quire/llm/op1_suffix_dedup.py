"""Suffix-array deduplication of byte strings across documents.

A byte of a document is removed if a string of ``length`` (50) bytes that
covers it also starts in a document with a smaller id.

A winnowing hash join takes the place of prefix doubling: no rank of an
earlier round is used and offsets do not grow. Equal prefixes need a common
name but no order among different ones, so a rank is the 64-bit hash of the
prefix, and grouping by it brings equal prefixes together. Three things keep
the pairs below the size of the text:

* *Sampled positions.* Of the 31 prefixes of 20 bytes in a string of 50, the
  one with the smallest rank (the leftmost on ties) stands for the string.
  Equal strings choose equal places, so only chosen positions (about one
  byte in 16) are sorted in the first round.
* *Runs.* The consecutive strings with one chosen position form a run, named
  by the hash of all its bytes. A run whose (rank, name) occurs in a smaller
  document is removed whole; equal runs inside one task are settled there and
  only the smallest document's travels, so a passage of a third of all
  documents costs a row for each task, not for each document.
* *Second round at offset 25.* Only runs whose chosen prefix is shared but
  whose name differs (edges of passages, edits) are expanded: each of their
  strings is named by the pair of ranks of its bytes 0-24 and 25-49.

Rows are packed: one row for each (input batch, bucket of ranks) or (batch,
block of documents) with sorted arrays in it. Blocks hold a bounded share of
the texts; what is found for a document travels to its block as one 64-bit key
a run.

Nulls and edge cases: a null text counts as empty, an empty or short one is
kept as it is. A row with a null id counts as larger than every id. Rows with
equal ids do not remove each other's bytes. Long texts are cut into
overlapping segments of 2^17 bytes for ranking only; results do not depend on
it. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, mix64, prefix_sums, row_slices, scratch, shuffle_partitions, span_hashes, table, text_slices

LENGTH, FIRST, HALF = 50, 20, 25
SEGMENT = 1 << 17
#: stands for a null id: larger than all others
NO_ID = np.iinfo(np.int64).max
TEXT, WHOLE, PARTIAL, STRINGS, SPREAD = 0, 1, 2, 3, 4
#: Names of one rank in a batch above which its entries are spread over all buckets.
HOT_NAMES = 64
#: Text that a task ranks or packs at a time.
BATCH_BYTES = 6 << 20
ROW = "kind byte, place int, a binary, b binary, c binary, d binary"


class Runs:
    """Runs of the strings of several texts that share a chosen position.

    Arrays over runs: ``text`` (index of the text), ``first`` and ``last``
    (starts of the strings inside the text), ``rank`` (of the chosen prefix)
    and ``name`` (of all the bytes of the run). ``sums`` and ``shift`` lead
    from a start in the text to a place in the buffer.
    """

    def __init__(self, buf: bytes, owner: np.ndarray, begin: np.ndarray, size: np.ndarray, offset: np.ndarray):
        a = np.frombuffer(buf, np.uint8)
        self.sums = prefix_sums(a)
        at = np.arange(len(a) - FIRST + 1)
        ranks = span_hashes(self.sums, at, at + FIRST)
        # high bits: order by rank; low bits: leftmost place on ties
        best = (ranks >> np.uint64(21) << np.uint64(21)) | at.astype(np.uint64)
        width, have = LENGTH - FIRST + 1, 1
        while have * 2 <= width:
            best = np.minimum(best[:-have], best[have:])
            have *= 2
        if have < width:
            best = np.minimum(best[:have - width], best[width - have:])
        chosen = (best & np.uint64((1 << 21) - 1)).astype(np.int64)
        piece = np.repeat(np.arange(len(size)), size)[:len(chosen)]
        at = at[:len(chosen)]
        inside = at + LENGTH <= (begin + size)[piece]
        cut = np.ones(len(chosen), bool)
        cut[1:] = (chosen[1:] != chosen[:-1]) | (piece[1:] != piece[:-1]) | (inside[1:] != inside[:-1])
        start = np.flatnonzero(cut)
        end = np.append(start[1:], len(chosen)) - 1
        ok = inside[start]
        start, end = start[ok], end[ok]
        self.rank = ranks[chosen[start]]
        self.name = mix64(span_hashes(self.sums, start, end + LENGTH) + (chosen[start] - start).astype(np.uint64))
        piece = piece[start]
        self.text = owner[piece]
        self.shift = (begin - offset)[piece]
        self.first, self.last = start - self.shift, end - self.shift

    def strings(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Run index, start in the text and the pair of ranks of each string
        of the given runs."""
        n = (self.last - self.first + 1)[which]
        run = np.repeat(which, n)
        start = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n) + self.first[run]
        at = start + self.shift[run]
        return (run, start, span_hashes(self.sums, at, at + HALF),
                span_hashes(self.sums, at + HALF, at + LENGTH))


def runs_of(texts: list[bytes]) -> Iterator[Runs]:
    """Runs of the texts, some hundred kilobytes at a time."""
    step = SEGMENT - LENGTH + 1
    buf: list[bytes] = []
    meta: list[tuple[int, int, int, int]] = []
    total = 0

    def build() -> Runs:
        m = np.array(meta, np.int64)
        return Runs(b"".join(buf), m[:, 0], m[:, 1], m[:, 2], m[:, 3])

    for k, raw in enumerate(texts):
        for off in range(0, max(1, len(raw) - LENGTH + 1), step):
            part = raw[off:off + SEGMENT]
            if len(part) < LENGTH:
                continue
            if total + len(part) > 2 * SEGMENT:
                yield build()
                buf, meta, total = [], [], 0
            buf.append(part)
            meta.append((k, total, len(part), off))
            total += len(part)
    if meta:
        yield build()


def doc_key(doc: np.ndarray, name: np.ndarray) -> np.ndarray:
    """What stands for (document, name) inside a block."""
    return mix64(doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)) ^ name


def pair_name(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix64(a * np.uint64(0xD6E8FEB86659FD93) + b)


def block_of(doc: np.ndarray, blocks: int) -> np.ndarray:
    return (mix64(doc.astype(np.uint64) + np.uint64(0x51ED270B)) % np.uint64(blocks)).astype(np.int64)


def _groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the runs of equal values of a sorted array."""
    if not len(key):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    s = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return s, np.append(s[1:], len(key))


class Out:
    """Rows ``kind, place, a, b, c, d``, handed out in record batches."""

    def __init__(self):
        self.rows: list[tuple] = []
        self.size = 0
        self.found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.n_found = 0

    def add(self, kind: int, place: int, a: bytes = b"", b: bytes = b"", c: bytes = b"", d: bytes = b"") -> None:
        self.rows.append((kind, place, a, b, c, d))
        self.size += len(a) + len(b) + len(c) + len(d)

    def keys(self, kind: int, doc: np.ndarray, name: np.ndarray, blocks: int) -> None:
        """Keys of (document, name); gathered, then a row for each block."""
        if len(doc):
            self.found.setdefault(kind, []).append((block_of(doc, blocks), doc_key(doc, name)))
            self.n_found += len(doc)

    def full(self) -> bool:
        return self.size > 8 << 20 or len(self.rows) > 20_000 or self.n_found > 2_000_000

    def take(self) -> pa.RecordBatch:
        for kind, parts in self.found.items():
            block, key = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((key, block))
            block, key = block[order], key[order]
            for s, e in zip(*_groups(block)):
                self.add(kind, int(block[s]), key[s:e].tobytes())
        cols = list(zip(*self.rows)) or [[]] * 6
        self.rows, self.size, self.found, self.n_found = [], 0, {}, 0
        types = [pa.int8(), pa.int32(), *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                          names=["kind", "place", "a", "b", "c", "d"])


def _pack(rank: np.ndarray, name: np.ndarray, doc: np.ndarray, buckets: int, kind: int, out: Out, short: bool) -> None:
    """A row for each bucket of ranks; documents as compressed differences.
    ``short``: keep 40 bits of the rank besides the bucket (a chance hit there
    only causes a needless comparison of names)."""
    bucket = (rank % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((doc, bucket))
    bucket, rank, name, doc = bucket[order], rank[order], name[order], doc[order]
    for s, e in zip(*_groups(bucket)):
        r = rank[s:e]
        if short:
            r = np.ascontiguousarray((r // np.uint64(buckets)).view(np.uint8).reshape(-1, 8)[:, :5])
        out.add(kind, int(bucket[s]), r.tobytes(), name[s:e].tobytes(),
                zlib.compress(np.diff(doc[s:e], prepend=0).tobytes(), 1))


def _unpack(rows: list[tuple[bytes, bytes, bytes]], short: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if short:
        raw = np.frombuffer(b"".join(r[0] for r in rows), np.uint8).reshape(-1, 5)
        wide = np.zeros((len(raw), 8), np.uint8)
        wide[:, :5] = raw
        rank = wide.view(np.uint64).ravel()
    else:
        rank = np.frombuffer(b"".join(r[0] for r in rows), np.uint64)
    name = np.frombuffer(b"".join(r[1] for r in rows), np.uint64)
    doc = np.concatenate([np.cumsum(np.frombuffer(zlib.decompress(r[2]), np.int64)) for r in rows])
    return rank, name, doc


def settle(rank: np.ndarray, name: np.ndarray, doc: np.ndarray):
    """Sort by (rank, name, document). Returns the order, the index range of
    each class in it, and for each sorted entry the class's smallest document."""
    order = np.lexsort((doc, name, rank))
    r, n, d = rank[order], name[order], doc[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (n[1:] != n[:-1])
    least = d[new][np.cumsum(new) - 1] if len(d) else d
    return r, n, d, new, least


def _docs(ids: list) -> np.ndarray:
    return np.array([NO_ID if i is None else i for i in ids], np.int64)


def _sample(buckets: int, blocks: int):
    """Rows ``id, text`` -> chosen positions by bucket of ranks (kind
    STRINGS), and what is settled inside the batch (kind WHOLE)."""
    def sample_positions(batches):
        out = Out()
        for batch in text_slices(batches, 1, BATCH_BYTES):
            docs = _docs(batch.column(0).to_pylist())
            parts = [(r.rank, r.name, docs[r.text]) for r in runs_of([t or b"" for t in batch.column(1).to_pylist()])]
            if not parts:
                continue
            r, n, d, new, least = settle(*[np.concatenate(x) for x in zip(*parts)])
            out.keys(WHOLE, d[d > least], n[d > least], blocks)
            r, n, d = r[new], n[new], d[new]
            s, e = _groups(r)
            hot = np.repeat(e - s > HOT_NAMES, e - s)
            if hot.any():
                # known to be shared, so the rank's bucket only needs two of
                # its names; the rest spreads over all buckets by name
                _pack(pair_name(r[hot], n[hot]), n[hot], d[hot], buckets, SPREAD, out, True)
                hot[s], hot[e - 1] = False, False
                r, n, d = r[~hot], n[~hot], d[~hot]
            _pack(r, n, d, buckets, STRINGS, out, True)
            yield out.take()
    return sample_positions


def _by_place(batches) -> Iterator[tuple[int, int, bytes, bytes, bytes, bytes]]:
    """Rows sorted by place, streamed one by one."""
    for batch in row_slices(batches, 64):
        yield from zip(*[batch.column(i).to_pylist() for i in range(6)])


def _first_round(blocks: int):
    """Buckets of chosen positions -> keys by block: runs to remove whole
    (WHOLE) and runs to expand (PARTIAL). WHOLE rows of the batches pass."""
    def bucket(kind, rows, out):
        r, n, d, new, least = settle(*_unpack(rows, True))
        out.keys(WHOLE, d[d > least], n[d > least], blocks)
        # ranks with more than one name: the smallest document of each name
        r, n, d = r[new], n[new], d[new]
        s, e = _groups(r)
        shared = np.repeat(e - s > 1, e - s) | (kind == SPREAD)
        out.keys(PARTIAL, d[shared], n[shared], blocks)

    return _bucketwise(bucket, "first_round")


def _bucketwise(bucket, name: str):
    """Call ``bucket(kind, rows, out)`` for each bucket; rows of keys pass.
    ``name`` tells the step apart in plans."""
    def run(batches):
        out, held, at = Out(), [], None
        for kind, p, a, b, c, _ in _by_place(batches):
            if kind < STRINGS:
                out.add(kind, p, a)
            else:
                if (kind, p) != at and held:
                    bucket(at[0], held, out)
                    held = []
                at = kind, p
                held.append((a, b, c))
            if out.full():
                yield out.take()
        if held:
            bucket(at[0], held, out)
        yield out.take()
    run.__name__ = name
    return run


def _second_round(blocks: int):
    """Buckets of strings named by rank pairs -> keys of strings that a
    smaller document has (PARTIAL)."""
    def bucket(_, rows, out):
        r, n, d, _, least = settle(*_unpack(rows, False))
        out.keys(PARTIAL, d[d > least], pair_name(r[d > least], n[d > least]), blocks)

    return _bucketwise(bucket, "second_round")


def _texts_by_block(blocks: int, rest: bool):
    """Texts packed by block: a row for each (batch, block). The third column,
    if ``rest``, travels as an Arrow stream."""
    def pack_texts(batches):
        out = Out()
        for batch in text_slices(batches, 1, BATCH_BYTES):
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            docs = _docs(ids)
            block = block_of(docs, blocks)
            order = np.argsort(block, kind="stable")
            for s, e in zip(*_groups(block[order])):
                which = order[s:e]
                sizes = np.array([-1 if texts[k] is None else len(texts[k]) for k in which], np.int64)
                out.add(TEXT, int(block[which[0]]), docs[which].tobytes(), sizes.tobytes(),
                        zlib.compress(b"".join(texts[k] or b"" for k in which), 1),
                        _to_ipc(batch.select([2]).take(pa.array(which))) if rest else b"")
                if out.full():
                    yield out.take()
        yield out.take()
    return pack_texts


def _to_ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _from_ipc(raw: bytes) -> pa.Array:
    return pa.ipc.open_stream(raw).read_next_batch().column(0)


def _unpack_texts(a: bytes, b: bytes, c: bytes) -> tuple[np.ndarray, list[bytes]]:
    raw, sizes = zlib.decompress(c), np.maximum(np.frombuffer(b, np.int64), 0)
    ends = np.cumsum(sizes)
    return np.frombuffer(a, np.int64), [raw[e - s:e] for s, e in zip(sizes.tolist(), ends.tolist())]


def _sorted_blocks(batches):
    """For each packed row of texts: its block's WHOLE and PARTIAL keys as
    sorted arrays, and the row. Keys come before texts."""
    place, keys, ready = None, {WHOLE: [], PARTIAL: []}, None
    for kind, p, a, b, c, d in _by_place(batches):
        if p != place:
            place, keys, ready = p, {WHOLE: [], PARTIAL: []}, None
        if kind != TEXT:
            keys[kind].append(a)
            continue
        if ready is None:
            ready = [np.unique(np.frombuffer(b"".join(keys[k]), np.uint64)) for k in (WHOLE, PARTIAL)]
        yield ready[0], ready[1], _unpack_texts(a, b, c), d


def _among(keys: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(x), bool)
    return keys[np.minimum(np.searchsorted(keys, x), len(keys) - 1)] == x


def _expand(buckets: int, blocks: int):
    """Blocks with texts and the runs to expand -> strings named by their
    pair of ranks, by bucket."""
    def expand_runs(batches):
        out = Out()
        held: list[tuple] = []
        size = 0
        for _, partial, (docs, texts), _ in _sorted_blocks(batches):
            if len(partial):
                for runs in runs_of(texts):
                    d = docs[runs.text]
                    which = np.flatnonzero(_among(partial, doc_key(d, runs.name)))
                    if len(which):
                        run_no, _, r1, r2 = runs.strings(which)
                        held.append((r1, r2, d[run_no]))
                        size += len(r1)
            if size > 1_000_000:
                _flush(held, buckets, out)
                held, size = [], 0
                yield out.take()
        if held:
            _flush(held, buckets, out)
        yield out.take()

    def _flush(held, buckets, out):
        r, n, d, new, least = settle(*[np.concatenate(x) for x in zip(*held)])
        # settled here for all but the smallest document, which travels
        out.keys(PARTIAL, d[d > least], pair_name(r[d > least], n[d > least]), blocks)
        _pack(r[new], n[new], d[new], buckets, STRINGS, out, False)
    return expand_runs


def _remove(as_string: bool):
    """Blocks with texts and all keys -> the result rows."""
    def rows(docs, texts, whole, partial):
        removed = [np.zeros(0, np.int64)] * len(texts)
        starts: dict[int, list[np.ndarray]] = {}
        for runs in runs_of(texts):
            d = docs[runs.text]
            hit = _among(whole, doc_key(d, runs.name))
            found_run, found = [], []
            if hit.any():
                r, s, _, _ = runs.strings(np.flatnonzero(hit))
                found_run.append(r), found.append(s)
            if len(partial) and not hit.all():
                r, s, r1, r2 = runs.strings(np.flatnonzero(~hit))
                m = _among(partial, doc_key(d[r], pair_name(r1, r2)))
                found_run.append(r[m]), found.append(s[m])
            if found:
                r, s = np.concatenate(found_run), np.concatenate(found)
                t = runs.text[r]
                order = np.argsort(t, kind="stable")
                t, s = t[order], s[order]
                for x, y in zip(*_groups(t)):
                    starts.setdefault(int(t[x]), []).append(s[x:y])
        for k, raw in enumerate(texts):
            if k not in starts:
                yield k, len(raw), 0, b"", raw
                continue
            s = np.unique(np.concatenate(starts[k]))
            new = np.append(True, s[1:] > s[:-1] + LENGTH)
            lo, hi = s[new], np.append(s[:-1][new[1:]], s[-1]) + LENGTH
            kept, at = [], 0
            for x, y in zip(lo.tolist(), hi.tolist()):
                kept.append(raw[at:x])
                at = y
            kept.append(raw[at:])
            yield k, len(raw), int((hi - lo).sum()), np.stack([lo, hi]).T.tobytes(), b"".join(kept)

    def remove_strings(batches):
        schema = pa.schema([("id", pa.int64()), ("text", pa.string() if as_string else pa.binary()),
                            ("spans", pa.list_(pa.list_(pa.int64()))), ("n_bytes", pa.int64()),
                            ("n_removed", pa.int64()), ("kept_sha256", pa.string())])
        for whole, partial, (docs, texts), rest in _sorted_blocks(batches):
            cols: list[list] = [[], [], [], [], [], []]
            for k, n, gone, spans, kept in rows(docs, texts, whole, partial):
                d = int(docs[k])
                for col, v in zip(cols, (None if d == NO_ID else d, kept.decode("utf-8", "ignore") if as_string else kept,
                                         np.frombuffer(spans, np.int64).reshape(-1, 2).tolist(), n, gone,
                                         hashlib.sha256(kept).hexdigest())):
                    col.append(v)
            arrays, names = [pa.array(c, f.type) for c, f in zip(cols, schema)], list(schema.names)
            if rest:
                arrays.append(_from_ipc(rest))
                names.append("rest")
            yield pa.RecordBatch.from_arrays(arrays, names=names)
    return remove_strings


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 rest: list[str] | None = None, as_string: bool = False) -> DataFrame:
    """``id, text, spans, n_bytes, n_removed, kept_sha256``: one row for each
    input row. ``text`` (BINARY) is what is left, ``spans`` the removed byte
    ranges [start, end) of the original, maximal and in order. Columns named
    in ``rest`` come back in a struct ``rest``. ``as_string``: ``text`` is a
    STRING, without the rest of a character that a span has cut."""
    spark = docs.sparkSession
    n = shuffle_partitions(spark)
    places = 2 * n                              # packed rows: tasks x places
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"),
                      *([F.struct(*[column(c) for c in rest]).alias("rest")] if rest else []))
    out = f"id long, text {"string" if as_string else "binary"}, spans array<array<long>>, n_bytes long, n_removed long, kept_sha256 string"
    if rest:
        out += f", rest {src.schema['rest'].dataType.simpleString()}"

    def placed(df: DataFrame) -> DataFrame:
        # keys (kinds WHOLE, PARTIAL) stand before the texts of their block
        return df.repartition(n, "place").sortWithinPartitions("place", F.desc("kind"))

    found = scratch(placed(src.select("id", "text").mapInArrow(_sample(places, places), ROW))
                    .mapInArrow(_first_round(places), ROW))
    plain = src.select("id", "text").mapInArrow(_texts_by_block(places, False), ROW)
    strings = placed(plain.union(found.where(F.col("kind") == PARTIAL))).mapInArrow(_expand(places, places), ROW)
    second = placed(strings).mapInArrow(_second_round(places), ROW)
    texts = src.mapInArrow(_texts_by_block(places, True), ROW) if rest else plain
    return placed(texts.union(found.where(F.col("kind") == WHOLE)).union(second)).mapInArrow(_remove(as_string), out)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What removal of repeated 50-byte strings leaves of every document."""
    return suffix_dedup(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
