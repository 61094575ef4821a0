"""Best-fit packing of tokenised documents into sequences of 4096 tokens.

A document is its token ids and an end id. Documents over a sequence's length
are cut into full pieces and a rest; others are never cut. Pieces are dealt by
hash into groups of about ``group_rows`` and each group is packed by itself:

1. *Fill greedily.* A bin takes the longest piece that still fits until none
   does.
2. *Best two fit.* The bin's smallest piece is taken out if two unpacked
   pieces fit the expanded gap more tightly than it does.

A group holds a multiset of lengths (4096 at most), so packing needs no more
memory than the lengths of the group. Groups only cost a partly filled bin
each.

The tokenizer splits at white space, so the ids of a text are those of its
words; words are remembered in a bounded cache and only new ones are encoded.
The strings of the tokenizer's special tokens are those tokens, as its plain
call has it.

Nulls and edge cases: a null or empty text is one piece of one token, the end
id. Rows with a null id or equal ids are packed like others; pieces are
numbered within a row. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import column, release_memory, shuffle_partitions, sorted_groups, table, text_slices

CAPACITY, END_ID, GROUP_ROWS = 4096, 1, 8192
#: Words of a generation of the cache (two are held, about 200 bytes a word),
#: bytes of text tokenised at a time.
CACHE_WORDS, SLICE_BYTES = 250_000, 2 << 20


def tokenizer_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


# How this tokenizer's file prepares text.
_NORMAL = ["NFC", "Replace", "Lowercase"]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: A word of Latin letters, with what may follow it.
_LETTERS = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)")


def _letters_encoder(path: str):
    """An encoder of words of lower-case Latin letters, several times faster
    than the file's own, made of its vocabulary; ``None`` for other files.

    Merges are in the order of ids, so ids serve as ranks. The last byte of a
    word is a symbol of its own there (``</w>``); here it is a byte that such
    words do not have: a capital, or one below 0x40."""
    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    model, normal, split = told["model"], told["normalizer"] or {}, told["pre_tokenizer"] or {}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
    ids = [model["vocab"].get(x + y, -1) for x, y in pairs]
    if not (model["type"] == "BPE" and model.get("end_of_word_suffix") == "</w>" and ids == sorted(set(ids)) and ids[:1] >= [0]
            and [n["type"] for n in normal.get("normalizers", [])] == _NORMAL
            and [n["type"] for n in split.get("pretokenizers", [])] == ["Split", "ByteLevel"]
            and split["pretokenizers"][0]["pattern"] == {"Regex": _SPLIT}):
        return None
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {chr(c): c for c in plain} | {chr(256 + k): c for k, c in enumerate(c for c in range(256) if c not in set(plain))}
    inner = {*range(0x61, 0x7B), *range(0x80, 0x100)}
    ranks = {}
    for token, i in model["vocab"].items():
        stem = token.removesuffix("</w>")
        raw = bytes(byte[c] for c in stem) if stem and all(c in byte for c in stem) else b""
        if raw and all(c in inner for c in raw):
            if stem == token:
                ranks[raw] = i
            elif raw[-1] < 0xC0:
                ranks[_ended(raw)] = i
    return tiktoken.Encoding("letters", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece


def _ended(raw: bytes) -> bytes:
    return raw[:-1] + bytes([raw[-1] - (0x20 if raw[-1] < 0x80 else 0x80)])


class WordTokens:
    """Ids of words as little-endian 32-bit bytes. Words are remembered in two
    generations of bounded size: when the young one is full it becomes the old
    one, and what is used again is taken over."""

    def __init__(self, path: str, words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"     # Spark runs a task on each core
        self.tokenizer = Tokenizer.from_file(path)
        self.letters, self.ends = _letters_encoder(path), {"": b""}
        self.words, self.young, self.old = words, {}, {}

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text. New words of all texts are encoded together."""
        split = [t.split() for t in texts]
        young, old = self.young, self.old
        new = set().union(*split) - young.keys()
        if len(young) + len(new) > self.words:
            self.old, self.young = old, young = young, {}
            new = set().union(*split)
        rest = []
        for w in new:
            ids = old.get(w)
            if ids is None:
                ids = self._simple(w)
            if ids is None:
                rest.append(w)
            else:
                young[w] = ids
        for at in range(0, len(rest), 512):
            self._learn(rest[at:at + 512])
        return [b"".join(map(young.__getitem__, words)) for words in split]

    def _simple(self, word: bytes) -> bytes | None:
        """Ids of a word of Latin letters, which the file's pattern cuts from
        the marks after it."""
        m = _LETTERS.fullmatch(word.decode()) if self.letters else None
        if not m:
            return None
        end = self.ends.get(m[2])
        if end is None:
            end = self.ends[m[2]] = self._ids(m[2])
        return array("I", self.letters(_ended(m[1].lower().encode()))).tobytes() + end

    def _ids(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _learn(self, words: list[bytes]) -> None:
        """Encode words as one text and cut the ids where words begin."""
        text = [w.decode() for w in words]
        found = self.tokenizer.encode(" ".join(text), add_special_tokens=False)
        ids = np.array(found.ids, "<u4")
        begins = np.cumsum([0] + [len(w) + 1 for w in text[:-1]])
        cuts = np.searchsorted(np.array([o[0] for o in found.offsets]), begins).tolist() + [len(ids)]
        for k, w in enumerate(words):
            self.young[w] = ids[cuts[k]:cuts[k + 1]].tobytes()


def _pieces(path: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, end = WordTokens(path), int(end_id).to_bytes(4, "little")
        for batch in text_slices(batches, 1, SLICE_BYTES):
            keep, cols = [], ([], [], [], [])
            for k, ids in enumerate(tokens([t or b"" for t in batch.column(1).to_pylist()])):
                ids += end
                for no, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    keep.append(k)
                    for c, v in zip(cols, (no, at // 4, len(part) // 4, zlib.crc32(part))):
                        c.append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep, pa.int64())), pa.array(cols[0], pa.int32()),
                 *[pa.array(c, pa.int64()) for c in cols[1:]]],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])
        del tokens
        release_memory()
    return run


def best_two_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of indices of ``lengths`` (each 1..capacity)."""
    stock: dict[int, list[int]] = {}
    for k in range(len(lengths) - 1, -1, -1):
        stock.setdefault(lengths[k], []).append(k)
    have = 0                                   # bit x: a piece of length x is left
    for x in stock:
        have |= 1 << x

    def longest(limit: int) -> int:
        return (have & ((1 << (limit + 1)) - 1)).bit_length() - 1 if limit > 0 else -1

    bins = []
    while have:
        gap, lens, which = capacity, [], []

        def take(x: int) -> int:
            nonlocal have
            left = stock[x]
            k = left.pop()
            if not left:
                have &= ~(1 << x)
            return k
        while (x := longest(gap)) > 0:
            lens.append(x)
            which.append(take(x))
            gap -= x
        if gap and have:
            small = lens[-1]                   # filled in descending order
            room = gap + small
            best = (small, 0, 0)
            a = longest(room - 1)
            while a > 0 and 2 * a > best[0]:   # a is the longer of the two
                b = longest(min(a, room - a))
                if b == a and len(stock[a]) < 2:
                    b = longest(b - 1)
                if b > 0 and a + b > best[0]:
                    best = (a + b, a, b)
                    if a + b == room:
                        break
                a = longest(a - 1)
            if best[1]:
                lens.pop()
                back = which.pop()
                which += [take(best[1]), take(best[2])]
                stock[small].append(back)
                have |= 1 << small
        bins.append(which)
    return bins


def _pack(capacity: int):
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = None
        for g in sorted_groups(_typed(batches), ["grp"]):
            seq, off = [0] * len(g["grp"]), [0] * len(g["grp"])
            for no, which in enumerate(best_two_fit(g["length"], capacity)):
                at = 0
                for k in which:
                    seq[k], off[k] = (g["grp"][0] << 32) + no, at
                    at += g["length"][k]
            g["sequence_id"], g["offset"] = seq, off
            types = [kind[0], pa.int32(), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(g[n], t) for n, t in zip(names, types)], names=names)

    kind: list = [pa.int64()]

    def _typed(batches):
        for b in batches:
            kind[0] = b.schema.field("doc_id").type
            yield b
    return run


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                   end_id: int = END_ID, path: str | None = None, group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row for each piece: ``doc_id, piece, start, length, ids_crc32,
    sequence_id, offset``."""
    src = docs.select(column(id_col).alias("doc_id"), column(text_col).cast("binary").alias("text"))
    groups = max(1, round(docs.count() / group_rows))
    kind = src.schema["doc_id"].dataType.simpleString()
    cols = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    pieces = src.mapInArrow(_pieces(path or tokenizer_file(), capacity, end_id), cols)
    # the task's number spreads rows of one id and text over the groups
    key = F.xxhash64("doc_id", "piece", "ids_crc32", F.spark_partition_id())
    pieces = pieces.withColumn("grp", F.pmod(key, F.lit(groups)))
    # sorted to the last column: a task that runs again numbers bins alike
    return (pieces.repartition(min(groups, shuffle_partitions(docs.sparkSession)), "grp").sortWithinPartitions("grp", "doc_id", "piece", "length", "ids_crc32")
            .mapInArrow(_pack(capacity), f"{cols}, sequence_id long, offset long"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their place in sequences of 4096 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"))
