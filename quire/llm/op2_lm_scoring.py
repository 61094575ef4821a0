"""LM scoring: log probability of whole documents under a gated recurrent
language model of words.

* Word counts of all training documents are one distributed aggregation. The
  ``head`` most frequent words (a bounded number) are known to every task.
* The network's tokens are the most frequent words, the end, and groups of
  other words (hash of the last letters, length, punctuation). It is
  trained by truncated backpropagation over all training documents: a start
  from a small sample on the driver, then rounds in which each shard goes on
  over its own whole documents of that round and the parameters of all shards
  are averaged, weighted by tokens. Each training document is in one round,
  so the tokens read grow with the input, while only one parameter vector of
  fixed size reaches the driver a round. A document's round, shard and place
  in it are hashes of its id and tokens, and the number of shards follows from
  the number of tokens, so the same rows train the same network however the
  table is cut into tasks. Scoring runs over every whole document in windows,
  with the state carried from window to window.
* A word of a group has the group's probability times a mixture of its count
  in the group and of a spelling model, which is counted over all distinct
  training words, so every byte string has a probability. Words are spelled
  from their ends, each byte given the three after it, the last four also
  given the group (which their tail decides). Each step is a distribution, so
  the probabilities of all words of a group sum to at most one, and with the
  network's softmax so do those of all words.
* Both this and the base score (smoothed unigram) need the exact count of
  every word: head words are looked up in the task, the rest of a document's
  words is joined with the table of counts.

Nulls and edge cases: a null text counts as empty, one end token. Null ids are
learnt from. Repeated rows count as often as they occur and are scored each;
equal ones are spread over shards by their copy number. Equally frequent head
words are taken all or not at all. Very long texts are read as ids of two bytes
a word and scored in windows.
Without training documents N and V are 0 and the network is untrained. An
empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc32_mod, discard, scratch, shuffle_partitions, table, text_slices
from .gru import Gru

END = b""                                  # no word is empty
HEAD, TOKENS, HIDDEN, WIDTH = 200_000, 1280, 16, 32
#: documents of the network's start on the driver, about
SAMPLE_DOCS = 600
#: rounds over all training documents, rate of the first one
ROUNDS, RATE = 4, 0.01
STEPS = 600
#: tokens of a shard, about, and shards of a round at most (then they are larger)
SHARD_TOKENS, MAX_SHARDS = 1 << 20, 4096
#: tokens that a shard lays out at once
SLICE_TOKENS = 1 << 18
_CONTEXTS_LOG2, _ENDS = 15, 256            # spelling: hashed contexts; end of word
_GROUPED = 4                               # symbols spelled given the group
_TAILS, _PUNCT = 64, b".,;:!?%$&*#|"
GROUPS = 4 * _TAILS


def words_of(raw: bytes | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased, split at ASCII white space."""
    return (raw or b"").lower().split()


def group_of(word: bytes) -> int:
    """Group of a word: hash of its last three bytes before punctuation,
    length, and whether it ends in a letter."""
    stem = word.rstrip(_PUNCT) or word
    tail = int.from_bytes(stem[-3:], "big") * 2654435761 >> 16 & (_TAILS - 1)
    return (tail * 2 + (len(stem) > 6)) * 2 + (len(stem) < len(word))


# ------------------------------------------------------------------ counts

def word_counts(train: DataFrame) -> DataFrame:
    """``word, c`` over the ``text`` of all rows; the end is the empty word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, 0, 32 << 20):
            c: Counter = Counter()
            texts = b.column(0).to_pylist()
            for t in texts:
                c.update(words_of(t))
            if texts:
                c[END] = len(texts)
            yield pa.RecordBatch.from_arrays([pa.array(list(c.keys()), pa.binary()), pa.array(list(c.values()), pa.int64())],
                                             names=["word", "c"])
    return train.select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def head_words(counts: DataFrame, head: int) -> list[tuple[bytes, int]]:
    """The words over the smallest count that leaves at most ``head`` of them
    (counts by steps of an eighth of an octave), most frequent first."""
    step = F.floor(F.log2("c") * 8)
    total, low = 0, None
    for s, n in sorted(((r[0], r[1]) for r in counts.groupBy(step.alias("s")).count().collect()), reverse=True):
        total += n
        if total > head:
            break
        low = s
    if low is None:
        return []
    return sorted(((bytes(r[0]), r[1]) for r in counts.where(step >= low).collect()), key=lambda r: (-r[1], r[0]))


def _spelling_keys(words: list[bytes], groups: list[int] | np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each byte from a word's last to its first, and then its end: the
    hashed context and the symbol; and where each word starts."""
    lens = np.array([len(w) + 1 for w in words])
    a = np.frombuffer(b"\0".join(words)[::-1] + b"\0", np.uint8).astype(np.int64)
    lens, group = lens[::-1], np.asarray(groups, np.int64)[::-1]
    ends = np.cumsum(lens) - 1
    symbol = a.copy()
    symbol[ends] = _ENDS
    first = ends - lens + 1
    start = np.repeat(first, lens)
    at = np.arange(len(a))
    # within the first symbols the group, then a mark of its own
    context = np.where(at - start < _GROUPED, np.repeat(group, lens) * _GROUPED + at - start, GROUPS * _GROUPED)
    for back in (3, 2, 1):
        inside = at - back >= start
        context = context * 257 + np.where(inside, a[np.maximum(at - back, 0)] + 1, 0)
    context = context.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - _CONTEXTS_LOG2)
    return context.astype(np.int64), symbol, first


def spelling(counts: DataFrame, own: set[bytes] = frozenset()) -> np.ndarray:
    """log10 probability of a symbol given a hashed context, counted over all
    distinct words but ``own``. At most 2^15 x 257 sums reach the driver."""
    shape = (1 << _CONTEXTS_LOG2, _ENDS + 1)

    def run(batches):
        total = np.zeros(shape[0] * shape[1], np.int64)
        for b in batches:
            words = [w for w in b.column(0).to_pylist() if w and w not in own]
            if words:
                c, s, _ = _spelling_keys(words, [group_of(w) for w in words])
                total += np.bincount(c * shape[1] + s, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["k", "n"])
    n = np.zeros(shape[0] * shape[1])
    sums = counts.select("word").mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    n[sums["k"].to_numpy()] = sums["n"].to_numpy()
    n = n.reshape(shape)
    plain = (n.sum(0) + 0.01) / (n.sum() + 0.01 * shape[1])
    all_of = n.sum(1, keepdims=True) + 2
    n += 2 * plain
    n /= all_of
    return np.log10(n, out=n).astype(np.float32)


# ------------------------------------------------------------------- model

class Model:
    """Network, head words and spelling: what scoring tasks need."""

    def __init__(self, head: list[tuple[bytes, int]], spell: np.ndarray, n: int, v: int, group_totals: np.ndarray):
        self.n, self.v, self.spell = n, v, spell
        own = [w for w, _ in head[:TOKENS - GROUPS - 1] if w != END]
        self.end = len(own) + GROUPS
        self.net = Gru(self.end + 1, HIDDEN, WIDTH)
        # frequent words first, so that classes hold words of like frequency
        self.id = {w: k + GROUPS for k, w in enumerate(own)}
        self.id[END] = self.end
        self.place = {w: k for k, (w, _) in enumerate(head)}
        self.counts = np.array([c for _, c in head], np.int64)
        group = np.array([-1 if w in self.id else group_of(w) for w, _ in head], np.int64)
        tokens, types = group_totals
        # of a group's probability its known words have c / (tokens + types)
        # each, what is left goes to the spelling model
        self.size = np.maximum(tokens + types, 1.0)
        self.left = np.log10((types + (types == 0)) / self.size)
        self.tokens = np.where(group < 0, [self.id.get(w, 0) for w, _ in head], group) if head else np.zeros(0, np.int64)
        rare = np.flatnonzero(group >= 0)
        g = group[rare]
        spelled = self.spell_log10([head[k][0] for k in rare], g) + self.left[g]
        self.extra = np.zeros(len(head))       # log10 of the word given its group
        self.extra[rare] = np.log10(self.counts[rare] / self.size[g] + 10.0 ** spelled)

    def spell_log10(self, words: list[bytes], groups: list[int] | np.ndarray) -> np.ndarray:
        """log10 probability of each word's spelling given its group."""
        if not words:
            return np.zeros(0)
        c, s, first = _spelling_keys(words, groups)
        return np.add.reduceat(self.spell[c, s].astype(float), first)[::-1]

    def base_log10(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1) / (self.n + self.v + 1))


class _Ids(dict):
    """Network id of each word; groups of a bounded number of other words are
    kept once worked out."""

    def __init__(self, own: dict[bytes, int]):
        super().__init__(own)
        self.own, self.left = own, 100_000

    def __missing__(self, word):
        k = group_of(word)
        if self.left:
            self.left -= 1
            self[word] = k
        return k


def network_ids(raw: bytes | None, ids: dict[bytes, int], end: int) -> np.ndarray:
    words = words_of(raw)
    out = np.full(len(words) + 1, end, np.int16)
    out[:-1] = np.fromiter(map((ids if isinstance(ids, _Ids) else _Ids(ids)).__getitem__, words), np.int16, len(words))
    return out


def encoded(train: DataFrame, model: Model, rounds: int) -> DataFrame:
    """``h, ids, n, round``: each different pair of an id's hash and a text's
    tokens, how often it occurs and its round."""
    own, end = model.id, model.end

    def run(batches):
        ids = _Ids(own)
        for b in text_slices(batches, 1):
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([network_ids(t, ids, end).tobytes() for t in b.column(1).to_pylist()], pa.binary())], names=["h", "ids"])
    rows = train.select(F.xxhash64(F.lit(2), "id").alias("h"), "text").mapInArrow(run, "h long, ids binary")
    return rows.groupBy("h", "ids").agg(F.count(F.lit(1)).alias("n")).select(
        "h", "ids", "n", F.pmod(F.xxhash64(F.lit(3), "h", "ids"), F.lit(max(rounds, 1))).cast("int").alias("round"))


_PIECES = 64                               # of a state, summed apart


def shard_slices(batches: Iterator[pa.RecordBatch], limit: int = SLICE_TOKENS) -> Iterator[tuple[int, list[np.ndarray]]]:
    """``shard, texts`` from rows ``shard, ids`` sorted by shard: whole texts of
    one shard, cut where ``limit`` tokens are passed, whatever the batches."""
    shard, texts, size = None, [], 0
    for b in batches:
        for k, raw in zip(b.column(0).to_pylist(), b.column(1)):
            if texts and (k != shard or size >= limit):
                yield shard, texts
                texts, size = [], 0
            shard = k
            texts.append(np.frombuffer(raw.as_py(), np.int16))
            size += len(texts[-1])
    if texts:
        yield shard, texts


def train_round(rows: DataFrame, model: Model, rate: float, shards: int = 1) -> int:
    """Training over all rows ``h, ids, n``, a network a shard, all from the
    model's; it becomes their average by tokens. Returns the tokens read."""
    net = model.net

    def run(batches):
        start, steps = net.state(), net.t
        for shard, part in itertools.groupby(shard_slices(batches), key=lambda s: s[0]):
            net.set_state(start)
            net.t = steps
            n = net.read((texts for _, texts in part), rate)
            pieces = np.array_split(net.state().astype(float) * n, _PIECES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(_PIECES), pa.int32()), pa.array([shard] * _PIECES, pa.int32()), pa.array([n] * _PIECES, pa.int64()),
                 pa.array([p.tobytes() for p in pieces], pa.binary())], names=["piece", "shard", "n", "sums"])

    def add(batches):
        sums: dict[int, list] = {}
        for b in batches:                      # sorted, so sums are the same in every run
            for k, n, raw in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                got = sums.setdefault(k, [0, 0.0])
                got[0], got[1] = got[0] + n, got[1] + np.frombuffer(raw)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v[0] for v in sums.values()], pa.int64()),
                                          pa.array([v[1].tobytes() for v in sums.values()], pa.binary())], names=["piece", "n", "sums"])
    # equal rows are told apart by the number of the copy
    copies = rows.select("h", "ids", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
    dealt = copies.select(F.pmod(F.xxhash64(F.lit(4), "h", "ids", "copy"), F.lit(shards)).cast("int").alias("shard"), "ids",
                          F.xxhash64(F.lit(5), "h", "copy").alias("at"))
    parts = min(shards, shuffle_partitions(rows.sparkSession))
    states = dealt.repartition(parts, "shard").sortWithinPartitions("shard", "at", "ids").select("shard", "ids").mapInArrow(
        run, "piece int, shard int, n long, sums binary")
    got = sorted(tuple(r) for r in states.repartition("piece").sortWithinPartitions("piece", "shard")
                 .mapInArrow(add, "piece int, n long, sums binary").collect())
    if not got:
        return 0
    net.set_state(np.concatenate([np.frombuffer(raw) for _, _, raw in got]) / got[0][1])
    return got[0][1]


def learn(train: DataFrame, counts: DataFrame, head: int = HEAD, sample_docs: int = SAMPLE_DOCS, steps: int = STEPS,
          rounds: int = ROUNDS, rate: float = RATE) -> Model:
    """Model of the rows ``id, text`` of ``train`` and their ``word_counts``."""
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    known = head_words(counts, head)
    own = {w for w, _ in known[:TOKENS - GROUPS - 1]}

    def groups(batches):
        t = np.zeros((GROUPS, 2), np.int64)
        for b in batches:
            for w, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if w and w not in own:
                    t[group_of(w)] += c, 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(GROUPS)), pa.array(t[:, 0]), pa.array(t[:, 1])],
                                         names=["g", "tokens", "types"])
    totals = np.zeros((2, GROUPS))
    for g, a, b in counts.mapInArrow(groups, "g long, tokens long, types long").groupBy("g").agg(F.sum("tokens"), F.sum("types")).collect():
        totals[:, g] = a, b
    model = Model(known, spelling(counts, own), int(total[0]), int(total[1]), totals)
    rows = scratch(encoded(train, model, rounds), partition_by="round")
    # the start: about so many of the documents, by a hash of id and tokens
    share = min(1.0, sample_docs / max(rows.count(), 1))
    picked = rows.where(F.pmod(F.xxhash64(F.lit(6), "h", "ids"), F.lit(1_000_000)) < share * 1_000_000)
    got = sorted((r[0], bytes(r[1])) for r in picked.select("h", "ids").collect())
    model.net.train([np.frombuffer(x, np.int16) for _, x in got], steps=steps)
    model.trained = 0
    shards = max(1, min(MAX_SHARDS, -(-model.n // (SHARD_TOKENS * max(rounds, 1)))))
    for k in range(rounds):
        model.trained += train_round(rows.where(F.col("round") == k), model, rate * (1 - k / rounds), shards)
    discard(rows)
    model.net.rest()
    return model


def _score(model: Model):
    names = ["doc_id", "held_out", "row", "n_tokens", "n_known", "base_score", "score", "rest"]
    rest_names = ["word", "k", "spelled", "size"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, end_at = model.base_log10(model.counts), model.place.get(END)
        end_base = base[end_at] if end_at is not None else float(model.base_log10(np.zeros(1))[0])
        cache: dict[bytes, tuple[int, float]] = {}

        def look_up(texts: list[list[bytes]]):
            """Of texts that are counted at once: network ids, number of
            known words, sums of the base and of the words given their groups;
            number of the other words of each, and those words' columns."""
            lens = np.fromiter(map(len, texts), np.int64, len(texts))
            words, of = list(itertools.chain.from_iterable(texts)), np.repeat(np.arange(len(texts)), lens)
            at = np.fromiter(map(model.place.get, words, itertools.repeat(-1)), np.int64, len(words))
            ok = at >= 0
            places, owner, missing = at[ok], of[ok], np.flatnonzero(~ok)
            sums = [np.bincount(owner, x, len(texts)) for x in (None, base[places], model.extra[places])]
            number: defaultdict[bytes, int] = defaultdict()
            number.default_factory = number.__len__
            no = np.fromiter(map(number.__getitem__, map(words.__getitem__, missing.tolist())), np.int64, len(missing))
            rare = list(number)
            new = [w for w in rare if w not in cache]
            if len(cache) + len(new) > 200_000:
                cache.clear()
                new = rare
            g = [group_of(w) for w in new]
            if new:
                cache.update(zip(new, zip(g, (model.spell_log10(new, g) + model.left[g]).tolist())))
            found = [cache[w] for w in rare]
            group, spelled = np.array([x[0] for x in found], np.int64), np.array([x[1] for x in found], np.float64)
            ids = np.empty(len(words) + len(texts), np.int16)
            ids[np.cumsum(lens + 1) - 1] = model.end
            tokens = np.empty(len(words), np.int16)
            tokens[ok], tokens[missing] = model.tokens[places], group[no]
            ids[np.arange(len(words)) + of] = tokens
            pairs, k = np.unique(of[missing] * max(len(rare), 1) + no, return_counts=True)
            owner, no = np.divmod(pairs, max(len(rare), 1))
            columns = [pa.array(rare, pa.binary()).take(pa.array(no)), pa.array(k, pa.int32()), pa.array(spelled[no]),
                       pa.array(model.size[group[no]])]
            return np.split(ids, np.cumsum(lens + 1)[:-1])[:len(texts)], *sums, np.bincount(owner, minlength=len(texts)), columns
        for batch in text_slices(batches, 3, 16 << 20):
            parts = [look_up([words_of(raw) for raw in b.column(3).to_pylist()]) for b in text_slices(iter([batch]), 3, 2 << 20)]
            seqs = [x for p in parts for x in p[0]]
            known, base_sums, extra, many = (np.concatenate([p[k] for p in parts]) for k in range(1, 5))
            score = model.net.score(seqs) / math.log(10) + extra
            listed = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(many)], pa.int32()), pa.StructArray.from_arrays(
                [pa.concat_arrays([p[5][k] for p in parts]) for k in range(4)], rest_names))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(list(map(len, seqs)), pa.int64()),
                 pa.array(known + (end_at is not None), pa.int64()), pa.array(base_sums + end_base), pa.array(score), listed], names=names)
    return run


def lm_score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held: int = 2, **options) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score`` of each row; rows of fold ``held`` are not learnt from."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"),
                      F.coalesce(crc32_mod(id_col, folds) == held, F.lit(False)).alias("held_out"))
    train = src.where("not held_out").select("id", "text")
    counts = scratch(word_counts(train))
    model = learn(train, counts, **options)
    kind = src.schema["id"].dataType.simpleString()
    # written once: the row numbers then name rows for good
    rows = scratch(src.select("id", "held_out", F.monotonically_increasing_id().alias("row"), "text").mapInArrow(
        _score(model), f"doc_id {kind}, held_out boolean, row long, n_tokens long, n_known long, base_score double, "
        "score double, rest array<struct<word: binary, k: int, spelled: double, size: double>>"))
    # the words outside the head: exact counts by a join (rare words only, so no hot key)
    rest = rows.select("row", F.inline("rest")).join(counts, "word", "left")
    c = F.coalesce("c", F.lit(0))
    sums = rest.groupBy("row").agg(F.sum(F.col("k") * F.log10((c + 1) / F.lit(float(model.n + model.v + 1)))).alias("b"),
                                   F.sum(F.when(c > 0, F.col("k")).otherwise(0)).alias("n"),
                                   F.sum(F.col("k") * F.when(c > 0, F.log10(c / F.col("size") + F.pow(F.lit(10.0), F.col("spelled"))))
                                         .otherwise(F.col("spelled"))).alias("s"))
    return rows.join(sums, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("n", F.lit(0))).cast("long").alias("n_known"),
        F.lit(model.n).cast("long").alias("train_tokens"), (F.col("base_score") + F.coalesce("b", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("s", F.lit(0.0))).alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model score of every document."""
    return lm_score(table(spark, sf_dir, "documents"))
