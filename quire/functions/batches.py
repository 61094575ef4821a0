"""Arrow functions of the posting tasks: Spark deals and orders the rows, these
work on the columns of one task's batches.

A task that sorts holds one bounded share of the postings (``TASK_ROWS``); all
others stream, and hold the rows of one list piece besides a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ..config import LIST_POSTINGS, LIST_TASK_POSTINGS
from .varbyte import decode_codes, encode_codes

_OUT_ROWS = 1 << 16


def ints(column: pa.Array | pa.ChunkedArray, name: str) -> np.ndarray:
    if column.null_count:
        raise ValueError(f"{name} is null")
    return column.to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.to_numpy()


def _codes(terms: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """Number of each row's term, and the terms by number."""
    array = terms.combine_chunks() if isinstance(terms, pa.ChunkedArray) else terms
    found = array.dictionary_encode(null_encoding="encode")
    return found.indices.to_numpy(zero_copy_only=False), found.dictionary


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, _OUT_ROWS):
        yield batch.slice(at, _OUT_ROWS)


def count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc_id, tokens, ...`` (tokens joined by blanks) with the rows of a
    document one after the other, as ``term, doc_id, tf, ...``; a document may go over batches."""
    held: pa.Table | None = None

    def counted(rows: pa.Table, last: bool) -> tuple[list[pa.RecordBatch], pa.Table | None]:
        """Counts of ``term, doc_id, tf, ...`` rows; the last document's are
        held back if more may follow."""
        rows = rows.combine_chunks()
        keys = [rows.column(c) for c in rows.column_names if c not in ("term", "tf")]
        new = np.zeros(rows.num_rows, bool)
        new[:1] = True
        for column in keys:
            codes = _codes(column)[0]
            new[1:] |= codes[1:] != codes[:-1]
        doc = np.cumsum(new) - 1
        codes, _ = _codes(rows.column("term"))
        n = int(codes.max()) + 1
        order = np.argsort(doc * n + codes, kind="stable")
        sorted_keys = (doc * n + codes)[order]
        starts = np.flatnonzero(np.diff(sorted_keys, prepend=-1))
        tf = np.add.reduceat(ints(rows.column("tf"), "tf"), starts)
        at = order[starts]
        out = rows.take(pa.array(at)).set_column(rows.column_names.index("tf"), "tf", pa.array(tf, pa.int64()))
        cut = out.num_rows if last else int(np.searchsorted(doc[at], doc[-1]))
        return out.slice(0, cut).combine_chunks().to_batches(_OUT_ROWS), (out.slice(cut) if cut < out.num_rows else None)

    for batch in batches:
        texts = pc.fill_null(batch.column("tokens"), "")
        for s, e in _shares(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64), 1 << 22):
            part = pc.split_pattern(texts.slice(s, e - s), " ")
            index = np.repeat(np.arange(s, e), pc.list_value_length(part).to_numpy(zero_copy_only=False))
            words = part.flatten()
            some = pc.not_equal(words, "")              # of a text without a token
            if pc.min(some).as_py() is False:
                index, words = index[some.to_numpy(zero_copy_only=False)], words.filter(some)
            if not len(index):
                continue
            others = {c: batch.column(c).take(pa.array(index)) for c in batch.schema.names if c != "tokens"}
            rows = pa.table({"term": words, "doc_id": others.pop("doc_id"), "tf": pa.array(np.ones(len(index), np.int64)), **others})
            done, held = counted(rows if held is None else pa.concat_tables([held, rows]), False)
            yield from done
    if held is not None:
        yield from counted(held, True)[0]


# Bytes of tokens, A-Z lower-cased; all others, those of longer characters too, separate tokens.
_TOKEN_BYTES = np.array([c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 else 0 for c in range(256)], np.uint8)


def tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The tokens of texts, as ``functions.text.tokenize`` has them, and how
    many each text has."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = _TOKEN_BYTES[np.frombuffer(held, np.uint8)[offsets[0]:offsets[-1]]] if held else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    inside = data != 0
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    begins = offsets[:-1][offsets[:-1] < len(data)]       # a text's first token starts with it
    starts[begins] = inside[begins]
    at = np.flatnonzero(starts)
    ends = np.append(np.flatnonzero(starts[inside]), np.count_nonzero(inside)).astype(np.int32)
    words = pa.StringArray.from_buffers(len(at), pa.py_buffer(ends), pa.py_buffer(data[inside]))
    return words, np.diff(np.searchsorted(at, offsets))


def _packed(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The numbers between bounds as one binary value each, 8 bytes a number."""
    data = np.ascontiguousarray(values[bounds[0]:bounds[-1]], "<i8")
    offsets = ((bounds - bounds[0]) * 8).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _unpacked(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The numbers of all values of a packed column, one after the other."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    out = []
    for c in chunks:
        width = np.int32 if pa.types.is_binary(c.type) else np.int64
        ends = np.frombuffer(c.buffers()[1], width)[[c.offset, c.offset + len(c)]] if len(c) else (0, 0)
        if ends[1] > ends[0]:
            out.append(np.frombuffer(c.buffers()[2], "<i8", (int(ends[1]) - int(ends[0])) // 8, int(ends[0])))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def count_lists(batches: Iterator[pa.RecordBatch], most: int = LIST_TASK_POSTINGS, longest: int = LIST_POSTINGS) -> Iterator[pa.RecordBatch]:
    """``doc_id, text`` ordered by doc id, as stretches of posting lists,
    ``term, n, doc_ids, tfs`` (packed): a term has one row for about ``most`` postings of
    the task, or for ``longest`` of its own. Rows of equal doc ids are one document."""
    held: list[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]] = []       # terms, codes, doc ids, tfs

    def merged() -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """What is held, ordered by code and doc id, a pair once."""
        found = pa.concat_arrays([h[0] for h in held]).dictionary_encode()
        number = np.split(found.indices.to_numpy(zero_copy_only=False), np.cumsum([len(h[0]) for h in held])[:-1])
        codes = np.concatenate([no[h[1]] for no, h in zip(number, held)])
        doc, tf = (np.concatenate([h[i] for h in held]) for i in (2, 3))
        # parts follow one another by doc id, so places break ties of a code
        order = np.sort(codes.astype(np.int64) << 32 | np.arange(len(codes))) & 0xFFFFFFFF
        codes, doc, tf = codes[order], doc[order], tf[order]
        new = np.ones(len(codes), bool)
        new[1:] = (codes[1:] != codes[:-1]) | (doc[1:] != doc[:-1])
        starts = np.flatnonzero(new)
        return found.dictionary, codes[starts], doc[starts], np.add.reduceat(tf, starts)

    def rows(terms: pa.Array, codes: np.ndarray, doc: np.ndarray, tf: np.ndarray) -> Iterator[pa.RecordBatch]:
        new = np.ones(len(codes), bool)
        new[1:] = codes[1:] != codes[:-1]
        place = np.arange(len(codes))
        new |= (place - np.maximum.accumulate(np.where(new, place, 0))) % longest == 0
        starts = np.flatnonzero(new)
        bounds = np.append(starts, len(codes))
        for s, e in _shares(np.diff(bounds), 1 << 17):
            cut = bounds[s:e + 1]
            yield pa.RecordBatch.from_arrays([terms.take(pa.array(codes[starts[s:e]])), pa.array(np.diff(cut), pa.int32()), _packed(doc, cut), _packed(tf, cut)],
                                             names=["term", "n", "doc_ids", "tfs"])

    for batch in batches:
        texts, ids = batch.column("text"), ints(batch.column("doc_id"), "doc id")
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        for s, e in _shares(sizes, 1 << 22):
            words, n = tokens(texts.slice(s, e - s))
            if not len(words):
                continue
            codes, terms = _codes(words)
            pairs = np.sort(codes.astype(np.int64) * (e - s) + np.repeat(np.arange(e - s), n))
            starts = np.flatnonzero(np.diff(pairs, prepend=-1))
            code, doc = np.divmod(pairs[starts], e - s)
            held.append((terms, code, ids[s:e][doc], np.diff(starts, append=len(pairs))))
            if sum(len(h[1]) for h in held) >= most:
                # the last document may go on
                terms, code, doc, tf = merged()
                open_ = doc == ids[e - 1]
                if not open_.all():
                    yield from rows(terms, code[~open_], doc[~open_], tf[~open_])
                    some, code = np.unique(code[open_], return_inverse=True)
                    terms, doc, tf = terms.take(pa.array(some)), doc[open_], tf[open_]
                held = [(terms, code, doc, tf)] if len(code) else []
    if held:
        yield from rows(*merged())


def split_lists(batches: Iterator[pa.RecordBatch], borders: dict[str, tuple[int, list[int]]]) -> Iterator[pa.RecordBatch]:
    """Stretches ``term, n, doc_ids, tfs`` cut at their term's borders, with the
    number of the run (of those before the first border, and the borders) and
    the last doc id."""
    for batch in batches:
        if not batch.num_rows:
            continue
        doc, tf = _unpacked(batch.column("doc_ids")), _unpacked(batch.column("tfs"))
        terms, runs, bounds, at = [], [], [], 0
        for term, n in zip(batch.column("term").to_pylist(), batch.column("n").to_pylist()):
            first, ids = borders[term]
            cuts = at + np.concatenate([[0], np.searchsorted(doc[at:at + n], ids, side="left"), [n]])
            some = np.flatnonzero(np.diff(cuts))
            terms += [term] * len(some)
            runs.append(first + some), bounds.append(cuts[some])
            at += n
        bounds = np.append(np.concatenate(bounds), at)
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string()), pa.array(np.concatenate(runs), pa.int32()), pa.array(np.diff(bounds), pa.int32()),
             pa.array(doc[bounds[1:] - 1]), _packed(doc, bounds), _packed(tf, bounds)], names=["term", "run", "n", "last", "doc_ids", "tfs"])


def picked_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``picks`` doc ids of each stretch ``t, n, doc_ids``, at even distances from
    a start of ``r`` in 0..1."""
    for batch in batches:
        n, picks, r = (batch.column(c).to_numpy() for c in ("n", "picks", "r"))
        starts = np.repeat(np.cumsum(n, dtype=np.int64) - n, picks)
        step = np.arange(len(starts)) - np.repeat(np.cumsum(picks, dtype=np.int64) - picks, picks)
        at = np.minimum((step + np.repeat(r, picks)) * np.repeat(n / np.maximum(picks, 1), picks), np.repeat(n, picks) - 1)
        terms = batch.column("t").take(pa.array(np.repeat(np.arange(len(n)), picks)))
        yield pa.RecordBatch.from_arrays([terms, pa.array(_unpacked(batch.column("doc_ids"))[starts + at.astype(np.int64)])], names=["t", "k"])


def _shares(sizes: np.ndarray, most: int = 1 << 20) -> list[tuple[int, int]]:
    """Stretches of rows with about ``most`` elements."""
    share = (np.cumsum(sizes) - sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(share)) + 1).tolist(), len(sizes)]
    return list(zip(cuts, cuts[1:])) if len(sizes) else []


def positions(batches: Iterator[pa.RecordBatch], block_size: int, nested: bool) -> Iterator[pa.RecordBatch]:
    """``term, run, doc_id, tf`` of one task (run 0 if there is none), or
    stretches of lists ``term, run, n, doc_ids, tfs``, ordered, with ``gap`` and ``pos``. ``_base`` and ``_last``, if given, are the postings and the last
    doc id of the list before the run. ``nested``: one row for each block of a
    run, ``term, run, block_no, doc_ids, gaps, tfs``."""
    found = list(batches)
    if not found:
        return
    rows = pa.Table.from_batches(found).combine_chunks()
    del found
    codes, words = _codes(rows.column("term"))
    lists = "doc_ids" in rows.column_names
    doc, tf = (rows.column(c).combine_chunks() for c in (("doc_ids", "tfs") if lists else ("doc_id", "tf")))
    if lists:
        sizes, doc, tf = ints(rows.column("n"), "n"), pa.array(_unpacked(doc)), pa.array(_unpacked(tf))

    def each(values: np.ndarray) -> np.ndarray:
        return np.repeat(values, sizes) if lists else values
    codes, doc = each(codes).astype(np.int64), ints(doc, "doc id")
    run = each(ints(rows.column("run"), "run")) if "run" in rows.column_names else np.zeros(len(doc), np.int32)
    low, span = int(doc.min()), int(doc.max()) - int(doc.min()) + 1
    if run.any():
        order = np.lexsort((doc, run, codes))
    elif span * len(words) < 1 << 63:
        order = np.argsort(codes * span + (doc - low))
    else:
        order = np.lexsort((doc, codes))
    codes, run, doc = codes[order], run[order], doc[order]
    tf = tf.take(pa.array(order))
    new = np.ones(len(doc), bool)
    new[1:] = (codes[1:] != codes[:-1]) | (run[1:] != run[:-1])
    place = np.arange(len(doc))
    pos = place - np.maximum.accumulate(np.where(new, place, 0))
    prev = np.concatenate([doc[:1], doc[:-1]])
    prev[new] = 0
    if "_base" in rows.column_names:
        pos += each(ints(rows.column("_base"), "base"))[order]
        prev[new] = each(ints(rows.column("_last"), "last doc id"))[order][new]
    gap = doc - prev
    if not nested:
        for s in range(0, len(doc), _OUT_ROWS):
            e = s + _OUT_ROWS
            yield pa.RecordBatch.from_arrays(
                [words.take(pa.array(codes[s:e])), pa.array(run[s:e]), pa.array(doc[s:e]), tf.slice(s, _OUT_ROWS), pa.array(gap[s:e]), pa.array(pos[s:e])],
                names=["term", "run", "doc_id", "tf", "gap", "pos"])
        return
    block = pos // block_size
    new[1:] |= block[1:] != block[:-1]
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(doc))
    tf = ints(tf, "tf").astype(np.int64)
    for s in range(0, len(starts), _OUT_ROWS // block_size or 1):
        at = starts[s:s + (_OUT_ROWS // block_size or 1)]
        low, high = at[0], ends[s + len(at) - 1]
        offsets = pa.array(np.append(at, high) - low, pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(values[low:high])) for values in (doc, gap, tf)]
        yield pa.RecordBatch.from_arrays([words.take(pa.array(codes[at])), pa.array(run[at]), pa.array(block[at]), *lists],
                                         names=["term", "run", "block_no", "doc_ids", "gaps", "tfs"])


def _pieces(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows with the starts of their groups by ``keys``, whose rows follow one
    another; a group is never cut."""
    held: list[pa.RecordBatch] = []

    def starts(rows: pa.Table) -> np.ndarray:
        new = np.zeros(rows.num_rows, bool)
        new[:1] = True
        for key in keys:
            codes = _codes(rows.column(key))[0] if pa.types.is_string(rows.column(key).type) else ints(rows.column(key), key)
            new[1:] |= codes[1:] != codes[:-1]
        return np.flatnonzero(new)

    rows_held = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows_held += batch.num_rows
        if rows_held < _OUT_ROWS:
            continue
        rows = pa.Table.from_batches(held).combine_chunks()
        at = starts(rows)
        if at[-1]:
            yield rows.slice(0, at[-1]).combine_chunks(), at[:-1]
        held = rows.slice(at[-1]).combine_chunks().to_batches()
        rows_held = 0
    if held:
        rows = pa.Table.from_batches(held).combine_chunks()
        yield rows, starts(rows)


def _binaries(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _nested(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, list[np.ndarray]]]:
    """Keys, sizes, and doc ids, gaps and tfs of rows that hold a block each."""
    for batch in batches:
        if batch.num_rows:
            sizes = pc.list_value_length(batch.column("doc_ids")).to_numpy(zero_copy_only=False).astype(np.int64)
            yield batch, sizes, [ints(batch.column(c).flatten(), c) for c in ("doc_ids", "gaps", "tfs")]


def _flat(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray, list[np.ndarray]]]:
    """The same of rows that hold a posting each."""
    for rows, starts in _pieces(batches, ["term", "run", "block_no"]):
        yield (rows.select(["term", "block_no"]).take(pa.array(starts)).combine_chunks(), np.diff(starts, append=rows.num_rows),
               [ints(rows.column(c), c) for c in ("doc_id", "gap", "tf")])


def blocks(batches: Iterator[pa.RecordBatch], layout: str, with_payload: bool, nested: bool) -> Iterator[pa.RecordBatch]:
    """Pieces of blocks of ``term, run, block_no`` and their postings; the codes
    of pieces that follow one another are one stretch of bytes."""
    for keys, sizes, (doc, gap, tf) in (_nested if nested else _flat)(batches):
        ends = np.cumsum(sizes)
        last = ends - 1
        if layout == "split":
            firsts = [gap], [tf]
        else:
            firsts = [np.stack([doc, tf], 1).ravel()], []
        cut = ends * (1 if layout == "split" else 2) - 1
        columns, n_bytes = [], np.zeros(len(ends), np.int64)
        for values in firsts:
            data, ends_of = encode_codes(values[0], with_payload) if values else (np.zeros(0, np.uint8), np.zeros(len(doc) * 2, np.int64))
            ends_of = ends_of[cut]
            n_bytes += np.diff(ends_of, prepend=0)
            columns.append(_binaries(data, ends_of) if with_payload else None)
        one = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (keys.column("term"), keys.column("block_no"))]
        out = [*one, pa.array(sizes), pa.array(doc[ends - sizes]), pa.array(doc[last]), pa.array(n_bytes)]
        names = ["term", "block_no", "n_postings", "first_doc_id", "last_doc_id", "n_bytes"]
        if with_payload:
            out, names = out + columns, [*names, "_p1", "_p2"]
        yield from _slices(pa.RecordBatch.from_arrays(out, names=names))


def decoded(batches: Iterator[pa.RecordBatch], layout: str) -> Iterator[pa.RecordBatch]:
    """``term, first_doc_id, payload`` of blocks as ``term, doc_id, tf``."""
    for batch in batches:
        payload = batch.column("payload").cast(pa.large_binary())
        sizes = pc.fill_null(pc.binary_length(payload), 0).to_numpy(zero_copy_only=False)
        for s, e in _shares(sizes):
            part = payload.slice(s, e - s)
            data = np.frombuffer(b"".join(part.to_pylist()), np.uint8)
            values, counts = decode_codes(data, sizes[s:e])
            n, at = counts // 2, np.cumsum(counts) - counts
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            if layout == "split":
                first = np.repeat(at, n) + within
                gaps, tf = values[first], values[first + np.repeat(n, n)]
                total, some = np.cumsum(gaps), n > 0
                begins = (np.cumsum(n) - n)[some]
                docs = total + np.repeat(ints(batch.column("first_doc_id").slice(s, e - s), "doc id")[some] - total[begins], n[some])
            else:
                docs, tf = values[np.repeat(at, n) + 2 * within], values[np.repeat(at, n) + 2 * within + 1]
            terms = batch.column("term").take(pa.array(np.repeat(np.arange(s, e), n)))
            yield from _slices(pa.RecordBatch.from_arrays([terms, pa.array(docs), pa.array(tf)], names=["term", "doc_id", "tf"]))


def running_sums(batches: Iterator[pa.RecordBatch], values: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows of one task, in order, with the sum of each value up to them."""
    total = [0] * len(values)
    for batch in batches:
        if not batch.num_rows:
            continue
        sums = [total[i] + np.cumsum(pc.fill_null(batch.column(v), 0).to_numpy(zero_copy_only=False).astype(np.int64)) for i, v in enumerate(values)]
        total = [int(s[-1]) for s in sums]
        yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, sums)], names=[*batch.schema.names, *(f"_up_to{i}" for i in range(len(values)))])


def joined_lines(batches: Iterator[pa.RecordBatch], sep: str) -> Iterator[pa.RecordBatch]:
    """``term, run, chunk, doc_id, p``: the texts ``p`` of each group joined."""
    for rows, starts in _pieces(batches, ["term", "run", "chunk"]):
        first = pa.array(starts)
        offsets = pa.array(np.append(starts, rows.num_rows).astype(np.int32))
        texts = pc.binary_join(pa.ListArray.from_arrays(offsets, rows.column("p").combine_chunks()), sep)
        for at in range(0, len(starts), 1 << 12):
            some = first.slice(at, 1 << 12)
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(c).take(some).combine_chunks() for c in ("term", "chunk", "doc_id")), texts.slice(at, 1 << 12)],
                names=["term", "chunk", "_first", "_text"])
