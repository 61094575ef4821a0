"""Phrase collocation mining by stripes.

A stripe belongs to a prefix (a phrase of k-1 words of one language) and is an
associative counter of the words that follow it, with one more count, `rest`,
for the occurrences that nothing counted follows (the end of a piece, or a word
that cannot make a frequent phrase). Stripes of the tasks are merged element by
element. A merged stripe gives

* the phrases of k words: prefix and next word, with their exact counts,
* the prefix total: the sum of the stripe, which is the prefix's own count,
* the largest count of an extension to the right, for the subsumption rule.

The text is read once and kept as windows of word numbers, which each phrase
length reads. A phrase of k words can
only be frequent if both its phrases of k-1 words are, so tasks leave out what
a *sketch* of the frequent phrases rules out: 2^22 bytes, whatever the input,
that hold the binary logarithm of the largest count of a slot. A collision lets
an infrequent phrase pass, to be dropped after the exact merge; nothing frequent
is ever left out, so results do not depend on the sketch's size.

Hot prefixes: a stripe has at most as many entries as its prefix has
occurrences, and the sketch bounds those in every task alike, so a stripe of a
prefix with over 2^14 occurrences is cut by a hash of the next word into
segments that are merged apart. The empty prefix's stripe (the vocabulary) is
always cut. The other stripes travel in bundles of about 128 prefixes, compressed,
so that rows are few and long. Merging streams over sorted rows and holds one bundle or
segment.

On their way the most frequent words, 2^17 of all languages together at most, are
codes, which every task knows; a stripe's entries are sorted by them and written as
gaps. All other words are written as they are.

Words and phrases are compared as strings, products are 38-digit decimals, so
counts and scores are exact.

Nulls and edge cases: a null or empty text has no words; a null language is
``und``, an empty one is a language of its own. Rows are counted as they are:
repeated rows count again, ids are not read and may be null or repeated. A very
long text is read in segments and counted in windows that overlap by the phrase
length, so that no phrase is lost. Ties: equal scores of cuts go to the smallest
cut, equal phrases in rank cannot occur. An empty table gives an empty result.
Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, broadcast_if_small, column, discard, mix64, row_slices, scratch, shuffle_partitions, table, text_slices

MIN_COUNT, MAX_WORDS, TOP, SUBSUME_PERCENT = 100, 5, 2000, 100
#: Slots of the sketch, words that a task counts at a time, segments of the
#: empty prefix's stripe, log2 of the entries of a segment, prefixes of a bundle.
SLOTS, WINDOW_WORDS, ROOT_SEGMENTS, SEGMENT_BITS, BUNDLE = 1 << 22, 4 << 20, 1024, 14, 128
#: Words that have codes, of all languages together, at most.
HEAD = 1 << 17
_BLOCK, _HELD = 1 << 17, 1 << 20

_END = b"!"                                     # stands for every piece border
_BORDERS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes(_END[0] if c in _BORDERS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
_SEGMENT = 1 << 20

# A row of stripes: in `numbers`, compressed, for each of its `stripes` prefixes
# how many entries it has, its rest and the codes of its words, then the gaps
# between the codes of each stripe's entries and their counts; in `words`, joined
# by spaces and compressed, the words without a code, in order.
_COLUMNS = ["kind", "lang", "prefix", "seg", "stripes", "numbers", "words"]
_STRIPES = "kind string, lang string, prefix string, seg int, stripes int, numbers binary, words binary"
_MERGED = "lang string, prefix string, total long, best long, next array<string>, n array<long>"


# ------------------------------------------------------------------ in tasks

class _Words:
    """Numbered words of one language, with the texts as numbers; 0 is a
    piece border, which no phrase crosses."""

    def __init__(self):
        self.ids: defaultdict[bytes, int] = defaultdict()
        self.ids.default_factory = self.ids.__len__
        self.ids[_END]
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, raw: bytes) -> None:
        at = 0
        while at < len(raw):
            end = min(len(raw), at + _SEGMENT)
            while end < len(raw) and raw[end] not in b" \t":
                end += 1
            words = raw[at:end].translate(_TABLE).replace(_END, b" ! ").split()
            self.parts.append(np.fromiter(map(self.ids.__getitem__, words), np.int32, len(words)))
            self.size += len(words)
            at = end
        self.parts.append(np.zeros(1, np.int32))


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.array([zlib.crc32(w) | zlib.crc32(w, 0x5BD1E995) << 32 for w in words], np.uint64)


def _seed(lang: str) -> np.uint64:
    return _word_hashes([lang.encode()])[0]


def _longer(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of phrases with one more word. They only choose slots of the
    sketch; phrases are told apart by their words."""
    return mix64(hashes * np.uint64(0xD6E8FEB86659FD93) + words)


def _passing(lang: str, words: list[bytes], a: np.ndarray, k: int, sketch: np.ndarray) -> np.ndarray:
    """For the phrase of ``k`` words at each position of ``a``, 1 + log2 of a
    bound of its count, 0 if it cannot be frequent."""
    slots, word = np.uint64(len(sketch)), _word_hashes(words)
    hashes = mix64(word ^ _seed(lang))
    level = sketch[hashes % slots]
    level[0] = 0
    level, hashes = level[a], hashes[a]
    for j in range(2, k + 1):
        n = max(0, len(a) - j + 1)
        pos = np.flatnonzero((level[:n] > 0) & (level[1:n + 1] > 0))
        found = _longer(hashes[pos], word[a[pos + j - 1]])
        hashes, level = np.zeros(n, np.uint64), np.zeros(n, np.uint8)
        hashes[pos], level[pos] = found, sketch[found % slots]
    return level


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 7, kinds)], names=_COLUMNS)


def _packed(numbers: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Numbers below 2^63 as bytes of seven bits, low ones first, the eighth
    bit set in all but a number's last; and where each number ends, after a 0."""
    a = numbers.astype(np.int64)
    size, most = np.ones(len(a), np.int64), int(a.max(initial=0))
    for j in range(1, 9):
        if most >> 7 * j:
            size += a >> 7 * j > 0
    ends = np.r_[0, np.cumsum(size)]
    out = np.empty(ends[-1], np.uint8)
    for j in range(int(size.max(initial=0))):
        of = np.flatnonzero(size > j)
        out[ends[of] + j] = (a[of] >> 7 * j & 127) | (size[of] > j + 1) * 128
    return out.tobytes(), ends


def _unpacked(raw: bytes) -> np.ndarray:
    a = np.frombuffer(raw, np.uint8)
    last = a < 128
    if last.all():
        return a.astype(np.int64)
    start = np.r_[0, np.flatnonzero(last)[:-1] + 1]
    at = np.arange(len(a)) - np.repeat(start, np.diff(np.r_[start, len(a)]))
    return np.add.reduceat((a & 127).astype(np.int64) << 7 * at, start)


def _window_rows(lang: str, text: _Words, overlap: int, window: int) -> Iterator[pa.RecordBatch]:
    """A language's texts as windows of word numbers, and the stripes of the
    empty prefix."""
    words, press = list(text.ids), zstandard.ZstdCompressor(level=3)
    everything = np.concatenate(text.parts)
    listed = press.compress(b" ".join(words))
    for at in range(0, len(everything), window):
        a = everything[at:at + window + overlap]
        starts = min(window, len(everything) - at)
        yield _batch([("text", lang, "", starts, None, press.compress(a.astype("<i4").tobytes()), listed)])
        counts = np.bincount(a[:starts], minlength=len(words))
        counts[0] = 0
        nxt = np.flatnonzero(counts)
        seg = np.array([zlib.crc32(words[w]) % ROOT_SEGMENTS for w in nxt.tolist()], np.int64)
        order = np.argsort(seg, kind="stable")
        nxt, seg = nxt[order], seg[order]
        cuts = np.r_[0, np.flatnonzero(np.diff(seg)) + 1, len(seg)] if len(seg) else np.zeros(1, np.int64)
        packed, ends = _packed(counts[nxt])
        # of one stripe: its size, no rest, and no words with codes
        yield _batch([("root", lang, "", int(seg[i]), 1,
                       press.compress(_packed(np.array([j - i, 0]))[0] + bytes(j - i) + packed[ends[i]:ends[j]]),
                       press.compress(b" ".join([words[w] for w in nxt[i:j].tolist()])))
                      for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist())])


def _windows(overlap: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: dict[str, _Words] = {}

        def flush():
            for lang, text in texts.items():
                yield from _window_rows(lang, text, overlap, window)
            texts.clear()
        for batch in text_slices(batches, 1):
            for lang, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if lang not in texts:
                    texts[lang] = _Words()
                texts[lang].add(raw or b"")
                if sum(t.size for t in texts.values()) >= window:
                    yield from flush()
        yield from flush()
    return run


def _stripe_rows(lang: str, words: list[bytes], a: np.ndarray, starts: int, k: int, sketch: np.ndarray, bundles: int,
                 head: dict[bytes, int]) -> pa.RecordBatch:
    """Stripes of the prefixes of ``k - 1`` words that begin at the first
    ``starts`` positions of a window. Words of ``head`` are written as codes."""
    press = zstandard.ZstdCompressor(level=3)
    a = a[:starts + k - 1]
    level = _passing(lang, words, a, k - 1, sketch)
    pos = np.flatnonzero(level[:starts])
    if not len(pos):
        return _batch([])
    key = a[pos].astype(np.int64)
    for j in range(1, k - 1):                  # phrases numbered by their words
        key = np.unique(key * len(words) + a[pos + j], return_inverse=True)[1]
    _, first, key = np.unique(key, return_index=True, return_inverse=True)
    strings = [b" ".join([words[w] for w in a[p:p + k - 1].tolist()]) for p in pos[first].tolist()]
    rest = np.bincount(key, minlength=len(strings))
    segs = 1 << np.maximum(level[pos[first]].astype(np.int64) - 1 - SEGMENT_BITS, 0)
    follows = pos + 1 < len(level)
    follows[follows] = level[pos[follows] + 1] > 0
    pair, n = np.unique(key[follows] * len(words) + a[pos[follows] + k - 1], return_counts=True)
    prefix, nxt = pair // len(words), pair % len(words)
    rest = rest - np.bincount(prefix, n, minlength=len(strings)).astype(np.int64)
    # a stripe is a prefix, or a prefix and a segment; what no entry holds goes with segment 0
    seg = np.zeros(len(pair), np.int64)
    cut = np.flatnonzero(segs[prefix] > 1)
    if len(cut):
        used, at = np.unique(nxt[cut], return_inverse=True)
        seg[cut] = np.array([zlib.crc32(words[w]) for w in used.tolist()], np.int64)[at] % segs[prefix[cut]]
    stripes, of = np.unique(np.r_[prefix << 32 | seg, np.arange(len(strings)) << 32], return_inverse=True)
    owner, seg, of = stripes >> 32, stripes & (1 << 32) - 1, of[:len(pair)]
    # whole stripes of prefixes with equal hashes share a row
    whole = segs[owner] == 1
    row = np.arange(bundles, bundles + len(stripes))
    row[whole] = [zlib.crc32(strings[p]) % bundles for p in owner[whole].tolist()]
    order = np.argsort(row, kind="stable")
    row, owner, seg, whole = row[order], owner[order], seg[order], whole[order]
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    other = len(head)                          # stands for all words without a code
    code = np.array([head.get(w, other) for w in words], np.int64)
    by = np.argsort(place[of] * (other + 1) + code[nxt], kind="stable")
    stripe, nxt, n = place[of][by], nxt[by], n[by]
    codes, sizes = code[nxt], np.bincount(stripe, minlength=len(order))
    gaps = np.diff(codes, prepend=0)
    begin = np.r_[0, np.cumsum(sizes)]
    at = begin[:-1][sizes > 0]
    gaps[at] = codes[at]
    own = a[pos[first][owner][:, None] + np.arange(k - 1)]
    own_codes = code[own].ravel()
    spare = [[words[w] for w in ids[c == other].tolist()] for ids, c in ((own.ravel(), own_codes), (nxt, codes))]
    before = [np.r_[0, np.cumsum(c == other)] for c in (own_codes, codes)]
    columns = [_packed(x) for x in (sizes, np.where(seg == 0, rest[owner], 0), own_codes, gaps, n)]
    cuts, rows = np.r_[0, np.flatnonzero(np.diff(row)) + 1, len(row)].tolist(), []
    for i, j in zip(cuts[:-1], cuts[1:]):
        e, f = begin[i], begin[j]
        parts = [(i, j), (i, j), (i * (k - 1), j * (k - 1)), (e, f), (e, f)]
        numbers = press.compress(b"".join([raw[ends[s]:ends[t]] for (raw, ends), (s, t) in zip(columns, parts)]))
        listed = b" ".join([w for ws, b, (s, t) in zip(spare, before, parts[2:4]) for w in ws[b[s]:b[t]]])
        kind, name, no = ("bundle", "", row[i]) if whole[i] else ("part", strings[owner[i]].decode(), seg[i])
        rows.append((kind, lang, name, int(no), j - i, numbers, press.compress(listed) if listed else b""))
    return _batch(rows)


def _stripes(k: int, sketch, bundles: int, head):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, unpack = np.frombuffer(sketch.value, np.uint8), zstandard.ZstdDecompressor()
        for batch in batches:
            for row in range(batch.num_rows):
                lang, starts, listed, packed = (batch.column(c)[row].as_py() for c in range(4))
                a = np.frombuffer(unpack.decompress(packed), "<i4")
                codes = {w: c for c, w in enumerate(head.value.get(lang, b"").split())}
                out = _stripe_rows(lang, unpack.decompress(listed).split(b" "), a, starts, k, held, bundles, codes)
                yield from row_slices([out], 20_000)
    return run


class _Stripes:
    """Stripes of one key, merged element by element."""

    def __init__(self, head: list[bytes]):
        self.head, self.codes, self.words = head, {}, []      # words without a code are numbered after the others
        self.prefixes: dict[tuple, int] = {}
        self.totals: list[int] = []
        self.parts, self.size = [], 0          # stripe, code and count of entries

    def coded(self, listed: list[bytes]) -> np.ndarray:
        for w in listed:
            if w not in self.codes:
                self.codes[w] = len(self.head) + len(self.words)
                self.words.append(w)
        return np.array([self.codes[w] for w in listed], np.int64)

    def add(self, stripes: int, numbers: np.ndarray, listed: list[bytes]) -> None:
        sizes, rests = numbers[:stripes], numbers[stripes:2 * stripes]
        entries = int(sizes.sum())
        own, gaps, n = np.split(numbers[2 * stripes:], [len(numbers) - 2 * stripes - 2 * entries, len(numbers) - 2 * stripes - entries])
        stripe, begin = np.repeat(np.arange(stripes), sizes), np.cumsum(sizes) - sizes
        codes = np.cumsum(gaps)
        codes -= np.repeat(np.r_[0, codes][begin], sizes)
        if listed:
            both = np.r_[own, codes]
            both[both == len(self.head)] = self.coded(listed)
            own, codes = both[:len(own)], both[len(own):]
        names = list(map(tuple, own.reshape(stripes, -1).tolist()))
        at = np.array([self.prefixes.setdefault(p, len(self.prefixes)) for p in names], np.int64)
        self.totals.extend([0] * (len(self.prefixes) - len(self.totals)))
        sums = np.bincount(stripe, n, minlength=stripes).astype(np.int64) + rests
        for p, total in zip(at.tolist(), sums.tolist()):
            self.totals[p] += total
        self.parts.append(np.stack([at[stripe], codes, n]))
        self.size += entries
        if self.size > _HELD and len(self.parts) > 1:
            self.merge()
            self.size = 0

    def merge(self) -> np.ndarray:
        stripe, codes, n = np.hstack(self.parts)
        width = len(self.head) + len(self.words) + 1
        key, at = np.unique(stripe * width + codes, return_inverse=True)
        total = np.zeros(len(key), np.int64)
        np.add.at(total, at, n)
        self.parts = [np.stack([key // width, key % width, total])]
        return self.parts[0]

    def rows(self, min_count: int, all_of_them: bool) -> Iterator[tuple]:
        """``words of the prefix, total, best, next, n``."""
        stripe, codes, n = self.merge()
        kept = n >= min_count
        stripe, codes, n = stripe[kept], codes[kept], n[kept].tolist()
        name = [(self.head[c] if c < len(self.head) else self.words[c - len(self.head)]).decode() for c in codes.tolist()]
        ends = np.cumsum(np.bincount(stripe, minlength=len(self.prefixes))).tolist()
        for (own, p), s, e in zip(self.prefixes.items(), [0, *ends], ends):
            if s < e or self.totals[p] and all_of_them:
                words = [(self.head[c] if c < len(self.head) else self.words[c - len(self.head)]).decode() for c in own]
                yield " ".join(words), self.totals[p], max(n[s:e], default=0), name[s:e], n[s:e]


def _merge(min_count: int, head=None):
    """Stripes with equal keys, which follow each other, merged element by
    element. Entries below ``min_count`` only count in the total; a stripe
    without others makes no phrase."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        key, held, out, lang_of, known = None, None, [], None, []

        def close():
            # another segment of a prefix may have entries
            out.extend([(key[1], *row) for row in held.rows(min_count, key[0] != "bundle")])

        def rows():
            cols = list(zip(*out)) or [()] * 6
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64())]
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                               names=["lang", "prefix", "total", "best", "next", "n"])
            out.clear()
            return batch
        for batch in row_slices(batches, 500):
            for kind, lang, prefix, seg, stripes, packed, words in zip(*[batch.column(i).to_pylist() for i in range(7)]):
                now = (kind, lang, prefix, seg)
                if now != key:
                    if key:
                        close()
                    if lang != lang_of:
                        lang_of, known = lang, head.value.get(lang, b"").split() if head else []
                    key, held = now, _Stripes(known)
                held.add(stripes, _unpacked(unpack(packed)), unpack(words).split(b" ") if words else [])
            if len(out) >= 10_000:
                yield rows()
        if key:
            close()
        yield rows()
    return run


# -------------------------------------------------------------------- levels

def _merged(stripes: DataFrame, min_count: int, head=None) -> DataFrame:
    """``lang, prefix, total, best, next, n``: merged stripes."""
    n = shuffle_partitions(stripes.sparkSession)
    keys = ["kind", "lang", "prefix", "seg"]
    return stripes.repartition(n, *keys).sortWithinPartitions(*keys).mapInArrow(_merge(min_count, head), _MERGED)


def merged_stripes(windows: DataFrame, k: int, sketch, frequent: int, head, min_count: int = MIN_COUNT) -> DataFrame:
    """The merged stripes of the prefixes of ``k - 1`` words, of which
    ``frequent`` are frequent."""
    bundles = max(1, -(-frequent // BUNDLE))
    text = windows.where("kind = 'text'").select("lang", "seg", "words", "numbers")
    return _merged(text.mapInArrow(_stripes(k, sketch, bundles, head), _STRIPES), min_count, head)


def head_words(words: DataFrame, most: int = HEAD) -> dict[str, bytes]:
    """Of ``lang, phrase, a`` the words over the smallest count that leaves at
    most ``most`` of them (counts by steps of an eighth of an octave): each
    language's, most frequent first, joined by spaces."""
    step = F.floor(F.log2("a") * 8)
    total, low = 0, None
    for s, n in sorted(((r[0], r[1]) for r in words.groupBy(step.alias("s")).count().collect()), reverse=True):
        total += n
        if total > most:
            break
        low = s
    out: defaultdict[str, list[bytes]] = defaultdict(list)
    if low is not None:
        for lang, word, _ in sorted(map(tuple, words.where(step >= low).select("lang", "phrase", "a").collect()), key=lambda r: (-r[2], r[1])):
            out[lang].append(word.encode())
    return {lang: b" ".join(ws) for lang, ws in out.items()}


def _sketch_rows(phrases: DataFrame, slots: int) -> DataFrame:
    """Blocks of the sketch of ``phrases(lang, phrase, a)``, all of one
    length."""
    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            by_word = list(zip(*[p.encode().split(b" ") for p in b.column(1).to_pylist()]))
            if by_word:
                hashes = mix64(_word_hashes(by_word[0]) ^ _word_hashes([x.encode() for x in b.column(0).to_pylist()]))
                for more in by_word[1:]:
                    hashes = _longer(hashes, _word_hashes(more))
                at = (hashes % np.uint64(slots)).astype(np.int64)
                bits = np.ceil(np.log2(b.column(2).to_numpy())).astype(np.int32) + 1
                yield pa.RecordBatch.from_arrays([pa.array(at // _BLOCK), pa.array(at % _BLOCK), pa.array(bits)], names=["block", "at", "bits"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: defaultdict[int, np.ndarray] = defaultdict(lambda: np.zeros(_BLOCK, np.uint8))
        for b in batches:
            block, place, value = (b.column(i).to_numpy() for i in range(3))
            for no in np.unique(block).tolist():
                of = block == no
                np.maximum.at(blocks[no], place[of], value[of].astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array(list(blocks), pa.int64()),
                                          pa.array([v.tobytes() for v in blocks.values()], pa.binary())], names=["block", "cells"])
    rows = phrases.select("lang", "phrase", "a").mapInArrow(places, "block long, at long, bits int")
    return rows.repartition(-(-slots // _BLOCK), "block").mapInArrow(pack, "block long, cells binary")


def add_to_sketch(sketch: np.ndarray, phrases: DataFrame) -> np.ndarray:
    """The sketch with the phrases of another level: at most its own size
    comes to the driver."""
    out = sketch.copy()
    for row in _sketch_rows(phrases, len(sketch)).toLocalIterator():
        cells = np.frombuffer(row["cells"], np.uint8)
        part = out[row["block"] * _BLOCK:(row["block"] + 1) * _BLOCK]
        np.maximum(part, cells[:len(part)], out=part)
    return out


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT,
                     max_words: int = MAX_WORDS, slots: int = SLOTS, window: int = WINDOW_WORDS) -> tuple[DataFrame, DataFrame]:
    """``(totals, phrases)``: ``lang, n`` and, for each phrase of 1 to
    ``max_words`` words with at least ``min_count`` occurrences, ``lang,
    phrase, words, a, lefts, rights, right_best, left_best``: the counts of its
    first 1, 2, ... words and of the rest of it, and the largest counts of the
    frequent phrases that are one word longer to the right and to the left."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(column(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        column(text_col).cast("binary").alias("text"))
    windows = scratch(texts.mapInArrow(_windows(max_words - 1, window), _STRIPES), partition_by="kind")
    sketch, totals, levels, longer = np.zeros(slots, np.uint8), None, [], []
    for k in range(1, max_words + 1):
        if k == 1:
            stripes = scratch(_merged(windows.where("kind = 'root'").select(*_COLUMNS), min_count))
        else:
            shared, frequent = spark.sparkContext.broadcast(sketch.tobytes()), levels[-1].count()
            stripes = scratch(merged_stripes(windows, k, shared, frequent, head, min_count))
            # the tables that are joined have no more rows than there are prefixes
            small = F.broadcast if frequent <= BROADCAST_ROWS else (lambda df: df)
        entries = stripes.select("lang", "prefix", F.explode(F.arrays_zip("next", "n")).alias("e")).select(
            "lang", "prefix", F.col("e.next").alias("next"), F.col("e.n").alias("a"))
        per_prefix = scratch(stripes.groupBy("lang", "prefix").agg(F.sum("total").alias("total"), F.max("best").alias("best")))
        nothing = F.array().cast("array<bigint>")
        if k == 1:
            totals = per_prefix.select("lang", F.col("total").alias("n"))
            level = entries.select("lang", F.col("next").alias("phrase"), F.lit("").alias("suffix"), F.lit(1).alias("words"), "a",
                                   nothing.alias("lefts"), nothing.alias("rights"))
        else:
            shorter = levels[-1]
            left = shorter.join(small(per_prefix), (shorter["lang"] == per_prefix["lang"])
                                & (shorter["phrase"] == per_prefix["prefix"])).select(
                shorter["lang"].alias("lang"), shorter["phrase"].alias("prefix"),
                F.concat("lefts", F.array("total")).alias("lefts"))
            right = shorter.select("lang", F.col("phrase").alias("suffix"), F.concat(F.array("a"), "rights").alias("rights"))
            rest = F.when(F.instr("prefix", " ") > 0, F.concat(F.expr("substr(prefix, instr(prefix, ' ') + 1)"), F.lit(" "),
                                                               F.col("next"))).otherwise(F.col("next"))
            level = (entries.join(small(left), ["lang", "prefix"]).withColumn("suffix", rest)
                     .join(small(right), ["lang", "suffix"])
                     .select("lang", F.concat_ws(" ", "prefix", "next").alias("phrase"), "suffix", F.lit(k).alias("words"), "a",
                             "lefts", "rights"))
            longer.append(per_prefix.select("lang", F.col("prefix").alias("phrase"), F.col("best").alias("right_best"),
                                            F.lit(0).cast("bigint").alias("left_best")))
        levels.append(scratch(level))
        discard(stripes)
        if k == 1:
            head = spark.sparkContext.broadcast(head_words(levels[0]))
        if k > 1:
            longer.append(levels[-1].select("lang", F.col("suffix").alias("phrase"), F.lit(0).cast("bigint").alias("right_best"),
                                            F.col("a").alias("left_best")))
        if k < max_words:
            sketch = add_to_sketch(sketch, levels[-1].select("lang", "phrase", "a"))
    phrases = levels[0]
    for level in levels[1:]:
        phrases = phrases.unionByName(level)
    if longer:
        best = longer[0]
        for more in longer[1:]:
            best = best.unionByName(more)
        best = best.groupBy("lang", "phrase").agg(F.max("right_best").alias("right_best"), F.max("left_best").alias("left_best"))
        phrases = phrases.join(best, ["lang", "phrase"], "left")
    else:
        phrases = phrases.withColumn("right_best", F.lit(0)).withColumn("left_best", F.lit(0))
    return totals, phrases.drop("suffix")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT,
                 max_words: int = MAX_WORDS, top: int = TOP, subsume_percent: int = SUBSUME_PERCENT,
                 slots: int = SLOTS, window: int = WINDOW_WORDS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``top``
    phrases of two or more words by score, count and phrase. The score of a
    phrase is that of its worst cut in two, floor(1000 a n / (l r)). A phrase
    inside a longer one that has at least ``subsume_percent`` per cent of its
    count is left out. (A phrase two words longer has no higher count than
    those between, so one word more is enough to look at.)"""
    totals, phrases = frequent_phrases(docs, text_col, lang_col, min_count, max_words, slots, window)
    best = F.greatest(F.coalesce("right_best", F.lit(0)), F.coalesce("left_best", F.lit(0)))
    kept = phrases.where((F.col("words") > 1) & ~((best > 0) & (best * 100 >= F.col("a") * subsume_percent)))
    kept = kept.join(broadcast_if_small(totals), "lang")
    cuts = F.expr("""array_min(transform(sequence(0, words - 2), k -> struct(
        (cast(1000 as decimal(38, 0)) * cast(a as decimal(38, 0)) * cast(n as decimal(38, 0)))
          div (cast(lefts[k] as decimal(38, 0)) * cast(rights[k] as decimal(38, 0))) as score,
        k as k, lefts[k] as l, rights[k] as r)))""")
    rows = kept.select("lang", "phrase", "a", "n", cuts.alias("cut")).select(
        "lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    w = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    # a rank filter is also applied before the shuffle, so a task gets at most
    # ``top`` rows of a language from each other
    return (rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2000 phrases of ``documents``."""
    return collocations(table(spark, sf_dir, "documents"))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ORACLE_SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
words AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\x09]+'), lambda w: w <> '') AS w FROM pieces),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, greatest(len(w) - k + 2, 1)), lambda i: list_slice(w, i, i + k - 1))) AS g
  FROM words, (SELECT unnest(range(1, {MAX_WORDS + 1})) AS k)),
f AS (
  SELECT lang, array_to_string(g, ' ') AS phrase, any_value(g) AS g, any_value(k) AS k, count(*)::BIGINT AS a
  FROM grams GROUP BY lang, array_to_string(g, ' ') HAVING count(*) >= {MIN_COUNT}),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
longer AS (
  SELECT lang, phrase, max(a) AS best FROM (
    SELECT lang, array_to_string(list_slice(g, s, e), ' ') AS phrase, a
    FROM f, (SELECT unnest(range(1, {MAX_WORDS + 1})) AS s), (SELECT unnest(range(1, {MAX_WORDS + 1})) AS e)
    WHERE s <= e AND e <= k AND e - s + 1 < k) GROUP BY lang, phrase),
cuts AS (
  SELECT f.lang, f.phrase, f.a, x.a AS l, y.a AS r, total.n, c.c,
         (1000::HUGEINT * f.a * total.n // (x.a::HUGEINT * y.a))::BIGINT AS score
  FROM f JOIN (SELECT unnest(range(1, {MAX_WORDS})) AS c) AS c ON c.c < f.k
  JOIN f AS x ON x.lang = f.lang AND x.phrase = array_to_string(list_slice(f.g, 1, c.c), ' ')
  JOIN f AS y ON y.lang = f.lang AND y.phrase = array_to_string(list_slice(f.g, c.c + 1, f.k), ' ')
  JOIN total ON total.lang = f.lang
  LEFT JOIN longer ON longer.lang = f.lang AND longer.phrase = f.phrase
  WHERE f.k >= 2 AND NOT coalesce(100 * longer.best >= {SUBSUME_PERCENT} * f.a, false)),
worst AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1)
SELECT lang, (row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase))::BIGINT AS rank,
       phrase, a, l, r, n, score
FROM worst QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= {TOP}
"""
