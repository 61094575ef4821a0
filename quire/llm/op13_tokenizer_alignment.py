"""Cross-tokenizer alignment with external spill counting.

Every text is encoded by a byte-level BPE (A) and by a piece BPE with byte
fallback (B). Byte offsets where tokens of both end cut the tokens into groups;
a group's last two tokens are a link, a pair of an A id and a B id. (Tokens
have at least a byte each, so just one pair ends at such an offset.) A pair's
count is the number of its links in the corpus.

1. *Radix runs.* A task collects the links of some documents, and spills them
   as a run: (B id, A id, document, multiplicity) records, radix-partitioned by
   the B id and, within a radix, sorted with the B id first and cut into frames
   of B ids, each compressed with zstd. Beside it stands a run of the pairs with
   their counts, one row a pair and run.
2. *Counting.* The count runs of a radix meet and are merged by a heap that
   yields their frames in order of B ids. A radix never merges more than
   ``FAN_IN`` runs in a task: while there are more, groups of them are merged to
   longer runs first. Since B ids are the major key, a frame of the last merge
   holds all pairs of its B ids, and so their maxima.
3. *Contributions.* The record runs of a radix are dealt to tasks in groups of
   about ``FAN_IN``, each with the counted frames of the radix; the same heap
   walks through both, and the sums of the run's documents stream back.

A frequent id is no hot key: before anything is shuffled its links are one
record a document, and its records are spread over the groups of runs. Runs are
written to shared storage once, so a lost executor costs the tasks it ran.

Nulls and edge cases: a null or empty text, and one whose tokens do not spell
space + text, has zeros and the empty string. Special tokens' strings are plain
text. Very long texts are encoded in segments cut before a single space between
two other characters, where both encoders always begin a token; the ids do not
change. Ties: all pairs with a B id's highest count are best. Ids may be null or
repeated: each row is a document of its own. An empty table gives an empty
result. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import column, row_slices, scratch, shuffle_partitions, table, text_slices

#: Radixes, B ids whose pairs make a frame, runs that a task merges, links and
#: documents of a run, bytes of text encoded at a time.
RADIXES, FRAME_IDS, FAN_IN, RUN_LINKS, RUN_DOCS, SLICE_BYTES = 16, 1024, 32, 4 << 20, 50_000, 1 << 20
_SEGMENT = 1 << 18
_SAFE = re.compile(r"(?<=[^\s]) (?=[^\s])")
# How a byte-level vocabulary splits words. Beyond Latin letters
# two libraries may know other versions of Unicode; the file's own encoder then
# takes the text.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_UNUSUAL = re.compile("[^\x00-\u024f\u2010-\u2027\u20ac]")

_FRAMES = "radix int, run long, frame array<int>, payload array<binary>"
_SPILL = f"kind string, {_FRAMES}, docs int, doc int, doc_id {{id}}, n_a long, n_b long, n_groups long, groups_sha256 string"


def tokenizer_files() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# ------------------------------------------------------------------ encoders

def _byte_alphabet() -> dict[str, int]:
    """Character of each byte in a byte-level vocabulary: printable Latin-1
    bytes stand for themselves, the others are numbered from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class Encoders:
    """Both tokenizers, the bytes of their ids and the texts of ids."""

    def __init__(self, a_file: str, b_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"     # Spark runs a task on each core
        import sentencepiece
        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True
        self.a_ranks = _by_ranks(a_file)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        alphabet, vocab = _byte_alphabet(), self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        n = self.b.get_piece_size()
        self.b_bytes = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(self.b.id_to_piece(list(range(n))))]
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        # how ids are written: A then ',' or '|', B then ',' or ';' or nothing
        self.written = [b"%d%c" % (i, c) for c in b",|" for i in range(len(self.a_bytes))]
        self.written += [b"%d%c" % (i, c) for c in b",;" for i in range(n)] + [b"%d" % i for i in range(n)]

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of each text by both. Texts are given without the first space."""
        parts, owner = [], []
        for k, text in enumerate(texts):
            at = 0
            while True:
                cut = _SAFE.search(text, at + _SEGMENT) if len(text) - at > _SEGMENT else None
                end = cut.start() if cut else len(text)
                parts.append(text[at:end])
                owner.append(k)
                if not cut:
                    break
                at = end + 1                   # the encoders put the space before a part
        firsts = np.searchsorted(owner, np.arange(len(texts) + 1)).tolist()
        b = self.b.encode(parts, num_threads=1)
        for s, e in zip(firsts[:-1], firsts[1:]):
            yield _flat([self.encode_a(" " + p) for p in parts[s:e]]), _flat(b[s:e])

    def encode_a(self, text: str) -> list[int]:
        if self.a_ranks and not _UNUSUAL.search(text):
            return self.a_ranks.encode_ordinary(text)
        return self.a.encode(text, add_special_tokens=False).ids


def _by_ranks(a_file: str):
    """The same encoder made from the file's vocabulary for tiktoken, which is
    several times faster: equal if the file's merges are in order of their ids
    and words are split as in its pattern; ``None`` for other files."""
    with open(a_file, encoding="utf-8") as f:
        told = json.load(f)
    model, split = told["model"], told["pre_tokenizer"] or {}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
    ids = [model["vocab"].get(x + y, -1) for x, y in pairs]
    special = {t["content"] for t in told["added_tokens"]}
    plain = {k: i for k, i in model["vocab"].items() if k not in special}
    same = (model["type"] == "BPE" and split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
            and not told["normalizer"] and ids == sorted(set(ids)) and ids[:1] >= [0] and len(plain) == 256 + len(pairs))
    if not same:
        return None
    alphabet = _byte_alphabet()
    return tiktoken.Encoding("ranks", pat_str=_SPLIT, special_tokens={},
                             mergeable_ranks={bytes(alphabet[c] for c in k): i for k, i in plain.items()})


def _flat(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), np.int64, sum(map(len, lists)))


_encoders: dict[tuple[str, str], Encoders] = {}


def encoders(a_file: str, b_file: str) -> Encoders:
    """Kept in the worker process, which Spark uses for many tasks."""
    if (a_file, b_file) not in _encoders:
        _encoders[(a_file, b_file)] = Encoders(a_file, b_file)
    return _encoders[(a_file, b_file)]


def align(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the A and of the B tokens that end groups."""
    ends = np.intersect1d(a_ends, b_ends, assume_unique=True)
    return np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)


def _spelled(enc: Encoders, a: np.ndarray, b: np.ndarray, ga: np.ndarray, gb: np.ndarray) -> Iterator[list[bytes]]:
    """The tokens of the groups in order, as written texts; a window of
    groups at a time."""
    na, nb, window = len(enc.a_bytes), len(enc.b_bytes), 1 << 17
    for at in range(0, len(ga), window):
        s_a, s_b = (0, 0) if at == 0 else (ga[at - 1] + 1, gb[at - 1] + 1)
        la, lb = ga[at:at + window] - s_a, gb[at:at + window] - s_b
        pa_, pb_ = a[s_a:s_a + la[-1] + 1].copy(), b[s_b:s_b + lb[-1] + 1] + 2 * na
        pa_[la] += na
        pb_[lb] += nb
        if at + window >= len(ga):
            pb_[-1] += nb
        out = np.empty(len(pa_) + len(pb_), np.int64)
        group_a = np.repeat(np.arange(len(la)), np.diff(la, prepend=-1))
        group_b = np.repeat(np.arange(len(lb)), np.diff(lb, prepend=-1))
        out[np.arange(len(pa_)) + np.r_[0, lb + 1][group_a]] = pa_
        out[np.arange(len(pb_)) + (la + 1)[group_b]] = pb_
        yield list(map(enc.written.__getitem__, out.tolist()))


# ---------------------------------------------------------------------- runs

def _packed(arrays: list[np.ndarray], press: zstandard.ZstdCompressor) -> bytes:
    """A frame: its length, then columns; the first one, sorted, as steps."""
    first = np.diff(arrays[0], prepend=0).astype("<i8")
    return press.compress(len(first).to_bytes(8, "little") + first.tobytes() + b"".join(x.astype("<i4").tobytes() for x in arrays[1:]))


def _counts_packed(keys: np.ndarray, counts: np.ndarray, press: zstandard.ZstdCompressor) -> bytes:
    return press.compress(len(keys).to_bytes(8, "little") + np.diff(keys, prepend=0).astype("<i8").tobytes()
                          + counts.astype("<i8").tobytes())


def _unpacked(frame: bytes, wide: bool) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(frame)
    n = int.from_bytes(raw[:8], "little")
    keys = np.cumsum(np.frombuffer(raw, "<i8", n, 8))
    rest = np.frombuffer(raw, "<i8" if wide else "<i4", -1, 8 + 8 * n)
    return [keys, *rest.reshape(-1, n)] if n else [keys]


class _Run:
    """Links of some documents until they are spilled."""

    def __init__(self, kind: pa.DataType):
        self.kind, self.rows, self.keys, self.docs, self.links, self.made = kind, [], [], [], 0, 0

    def add(self, doc_id, n_a: int, n_b: int, keys: np.ndarray, digest: str) -> None:
        self.keys.append(keys)
        self.docs.append(np.full(len(keys), len(self.rows), np.int64))
        self.rows.append((doc_id, n_a, n_b, len(keys), digest))
        self.links += len(keys)

    def spill(self, n_a_ids: int) -> Iterator[pa.RecordBatch]:
        if not self.rows:
            return
        task = TaskContext.get()
        run = ((task.partitionId() if task else 0) << 24) + self.made
        press, n = zstandard.ZstdCompressor(level=3), len(self.rows)
        code, times = np.unique(np.concatenate(self.keys) * n + np.concatenate(self.docs), return_counts=True)
        key, doc = code // n, code % n
        b = key // n_a_ids
        rows = []
        for radix in range(RADIXES):
            of = np.flatnonzero(b % RADIXES == radix)
            if not len(of):
                continue
            frame = b[of] // FRAME_IDS
            cuts = np.r_[0, np.flatnonzero(np.diff(frame)) + 1, len(of)]
            numbers, records, counts = frame[cuts[:-1]].tolist(), [], []
            for s, e in zip(cuts[:-1], cuts[1:]):
                part = of[s:e]
                records.append(_packed([key[part], doc[part], times[part]], press))
                first = np.flatnonzero(np.diff(key[part], prepend=-1))
                counts.append(_counts_packed(key[part][first], np.add.reduceat(times[part], first), press))
            rows += [("record", radix, numbers, records), ("count", radix, numbers, counts)]
        kinds, radixes, numbers, payloads = list(zip(*rows)) or [()] * 4
        m = len(rows)
        ids, n_a, n_b, groups, digests = zip(*self.rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*kinds, *["doc"] * n]), pa.array([*radixes, *[None] * n], pa.int32()), pa.array([run] * (m + n), pa.int64()),
             pa.array([*numbers, *[None] * n], pa.list_(pa.int32())), pa.array([*payloads, *[None] * n], pa.list_(pa.binary())),
             pa.array([n] * (m + n), pa.int32()), pa.array([*[None] * m, *range(n)], pa.int32()), pa.array([*[None] * m, *ids], self.kind),
             *[pa.array([*[None] * m, *x], pa.int64()) for x in (n_a, n_b, groups)], pa.array([*[None] * m, *digests], pa.string())],
            names=["kind", "radix", "run", "frame", "payload", "docs", "doc", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256"])
        self.rows, self.keys, self.docs, self.links = [], [], [], 0
        self.made += 1


def _spill(a_file: str, b_file: str, run_links: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, held = encoders(a_file, b_file), None
        for batch in text_slices(batches, 1, SLICE_BYTES):
            held = held or _Run(batch.schema.field(0).type)
            texts = batch.column(1).to_pylist()
            full = [k for k, t in enumerate(texts) if t]
            found = dict(zip(full, enc.encode([texts[k] for k in full])))
            for k, doc_id in enumerate(batch.column(0).to_pylist()):
                a, b = found.pop(k, (None, None))
                want = (" " + texts[k]).encode() if a is not None else b""
                if (a is None or b"".join(map(enc.a_bytes.__getitem__, a.tolist())) != want
                        or b"".join(map(enc.b_bytes.__getitem__, b.tolist())) != want):
                    held.add(doc_id, 0, 0, np.zeros(0, np.int64), "")
                else:
                    ga, gb = align(np.cumsum(enc.a_size[a]), np.cumsum(enc.b_size[b]))
                    digest = hashlib.sha256()
                    for part in _spelled(enc, a, b, ga, gb):
                        digest.update(b"".join(part))
                    held.add(doc_id, len(a), len(b), b[gb] * len(enc.a_bytes) + a[ga], digest.hexdigest())
                if held.links >= run_links or len(held.rows) >= RUN_DOCS:
                    yield from held.spill(len(enc.a_bytes))
        if held:
            yield from held.spill(len(enc.a_bytes))
    return run


# ------------------------------------------------------------------- merging

def _in_order(runs: list[tuple[list[int], list[bytes]]]) -> Iterator[tuple[int, list[tuple[int, bytes]]]]:
    """Frames of runs by number, from a heap of the runs' next frames:
    number, then (run, frame) pairs."""
    heap = [(numbers[0], k, 0) for k, (numbers, _) in enumerate(runs) if numbers]
    heapq.heapify(heap)
    while heap:
        no, met = heap[0][0], []
        while heap and heap[0][0] == no:
            _, k, at = heap[0]
            numbers, payloads = runs[k]
            met.append((k, payloads[at]))
            if at + 1 < len(numbers):
                heapq.heapreplace(heap, (numbers[at + 1], k, at + 1))
            else:
                heapq.heappop(heap)
        yield no, met


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Consecutive rows with equal first ``keys`` columns."""
    key, rows = None, []
    for batch in row_slices(batches, 16):
        for row in zip(*[batch.column(i).to_pylist() for i in range(batch.num_columns)]):
            if row[:keys] != key:
                if rows:
                    yield key, rows
                key, rows = row[:keys], []
            rows.append(row[keys:])
    if rows:
        yield key, rows


def _merge_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``radix, grp, run, frame, payload``: the runs of a group as one."""
    press = zstandard.ZstdCompressor(level=3)
    for (radix, grp), rows in _grouped(batches, 2):
        numbers, payloads = [], []
        for no, met in _in_order([(r[1], r[2]) for r in rows]):
            parts = [_unpacked(frame, True) for _, frame in met]
            keys, inv = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            counts = np.zeros(len(keys), np.int64)
            np.add.at(counts, inv, np.concatenate([p[1] for p in parts]))
            numbers.append(no)
            payloads.append(_counts_packed(keys, counts, press))
        yield pa.RecordBatch.from_arrays([pa.array([radix], pa.int32()), pa.array([grp], pa.int64()),
                                          pa.array([numbers], pa.list_(pa.int32())), pa.array([payloads], pa.list_(pa.binary()))],
                                         names=["radix", "run", "frame", "payload"])


def _contributions(n_a_ids: int):
    """Rows ``radix, grp, counted, run, docs, frame, payload``, a group's
    counted frames before its runs: per run the sums of its documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _grouped(batches, 2):
            counted = [r for r in rows if r[0]]
            runs = [r for r in rows if not r[0]]
            sums = [(np.zeros(r[2], np.int64), np.zeros(r[2], np.int64)) for r in runs]
            # the counted frames are one run more in the heap
            for _, met in _in_order([(counted[0][3], counted[0][4]), *[(r[3], r[4]) for r in runs]]):
                keys, counts = _unpacked(met[0][1], True)
                first = np.flatnonzero(np.diff(keys // n_a_ids, prepend=-1))
                best = counts == np.repeat(np.maximum.reduceat(counts, first), np.diff(np.r_[first, len(keys)]))
                for k, frame in met[1:]:
                    key, doc, times = _unpacked(frame, False)
                    at = np.searchsorted(keys, key)
                    n_best, total = sums[k - 1]
                    np.add.at(n_best, doc, np.where(best[at], times, 0))
                    np.add.at(total, doc, times * counts[at])
            for r, (n_best, total) in zip(runs, sums):
                with_any = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(with_any), r[1], np.int64)), pa.array(with_any.astype(np.int32)),
                     pa.array(n_best[with_any]), pa.array(total[with_any])], names=["run", "doc", "n_best", "count_sum"])
    return run


def _dealt(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    n = shuffle_partitions(df.sparkSession)
    return df.repartition(n, *keys).sortWithinPartitions(*keys, *order)


def _group(groups: int):
    return F.pmod(F.xxhash64("run"), F.lit(groups)).cast("bigint")


def pair_counts(spilled: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """``radix, frame, payload``: one row a radix, its pairs with the counts
    of all runs, merged ``fan_in`` runs at a time."""
    runs = spilled.where("kind = 'count'").select("radix", "run", "frame", "payload")
    while True:
        most = runs.groupBy("radix").count().agg(F.max("count")).first()[0] or 0
        groups = -(-most // fan_in)
        rows = runs.select("radix", (_group(groups) if groups > 1 else F.lit(0).cast("bigint")).alias("grp"), "run", "frame", "payload")
        merged = _dealt(rows, ["radix", "grp"], ["run"]).mapInArrow(_merge_counts, _FRAMES)
        runs = scratch(merged)
        if groups <= 1:
            return runs.select("radix", "frame", "payload")


def align_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", files: tuple[str, str] | None = None,
                    run_links: int = RUN_LINKS, fan_in: int = FAN_IN) -> DataFrame:
    """One row a document: ``doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256``."""
    a_file, b_file = files or tokenizer_files()
    src = docs.select(column(id_col).alias("doc_id"), column(text_col).cast("string").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    spilled = scratch(src.mapInArrow(_spill(a_file, b_file, run_links), _SPILL.format(id=kind)), partition_by="kind")
    counted = pair_counts(spilled, fan_in)
    records = spilled.where("kind = 'record'")
    most = records.groupBy("radix").count().agg(F.max("count")).first()[0] or 0
    groups = max(1, -(-most // fan_in))
    both = records.select("radix", _group(groups).alias("grp"), F.lit(False).alias("counted"), "run", "docs", "frame", "payload").unionByName(
        counted.select("radix", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint"))).alias("grp"),
                       F.lit(True).alias("counted"), F.lit(-1).cast("bigint").alias("run"), F.lit(0).alias("docs"), "frame", "payload"))
    n_a_ids = max(Tokenizer.from_file(a_file).get_vocab().values()) + 1
    sums = (_dealt(both, ["radix", "grp"], ["counted", "run"])
            .mapInArrow(_contributions(n_a_ids), "run long, doc int, n_best long, count_sum long")
            .groupBy("run", "doc").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))
    rows = spilled.where("kind = 'doc'").select("run", "doc", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256")
    zero = F.lit(0).cast("bigint")
    return rows.join(sums, ["run", "doc"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tokenizers' alignment of every document."""
    return align_documents(table(spark, sf_dir, "documents"))
