"""N-gram Jaccard join: documents whose sets of five-word shingles have a
Jaccard similarity of at least 0.8.

1. A scan gives each document the digest of its shingle set, band keys of its
   MinHash values and a short signature. Documents with equal sets collapse
   into one representative with a count of copies.
2. Representatives that share a band key are candidates. Inside each bucket
   the signatures are compared eight MinHash values at a time; after each
   step a pair is dropped if the posterior probability that its similarity
   reaches the threshold is below ``tolerance``. What survives is emitted as a
   spanning forest, never as all pairs. A bucket over ``bucket_block`` members
   is cut into blocks and each pair of blocks is a group of its own.
3. Connected candidates are verified exactly on their whole shingle sets, all
   pairs of a component in pairs of small blocks; links are counted, and the
   verified forest gives the classes.

Bands: 28 of 4 rows; a pair at similarity 0.8 shares none of them with
probability (1 - 0.8^4)^28 = 4e-7.

Nulls and edge cases: a null text counts as empty; a document without words
has no shingles and no links, and is its own class. Rows with a null id take
part as texts, but a class takes its smallest non-null id. Repeated rows are
copies of each other. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import (broadcast_if_small, by_sorted_keys, components, discard, mix64, scratch,
                     shingle_hashes, signed, sorted_groups, table, text_slices, word_hashes)

BANDS, ROWS, SIGNATURE, STEP = 28, 4, 64, 8


def _seeds(n: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    x = mix64(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt))
    x = (x >> np.uint64(32)).astype(np.uint32)
    return x[:n] | np.uint32(1), x[n:]


def minhash(shingles: np.ndarray, mul: np.ndarray, add: np.ndarray, rows: int = 256) -> np.ndarray:
    """Smallest value of each 32-bit linear permutation of the (already
    mixed) shingle hashes, in slices that stay in cache."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(mul), 0xFFFFFFFF, np.uint32)
    buf = np.empty((min(rows, len(x)), len(mul)), np.uint32)
    for at in range(0, len(x), rows):
        part = x[at:at + rows]
        part_buf = buf[:len(part)]
        np.multiply.outer(part, mul, out=part_buf)
        part_buf += add
        np.minimum(out, part_buf.min(0), out=out)
    return out


def set_digest(shingles: np.ndarray) -> bytes:
    """128-bit digest of a set of shingle hashes."""
    return np.array((mix64(shingles).sum(dtype=np.uint64),
                     mix64(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)), ">u8").tobytes()


def _describe(width: int):
    """Rows ``id, text`` -> ``id, rid, n_shingles, bands, sig``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mul, add = _seeds(BANDS * ROWS + SIGNATURE, 9)
        last: tuple = (None, None)
        for batch in text_slices(batches, 1):
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            rid, size, bands, sig = [], [], [], []
            for raw in texts:
                raw = raw or b""
                if last[0] != raw:
                    sh = np.unique(shingle_hashes(word_hashes(raw), width))
                    if len(sh):
                        mh = minhash(sh, mul, add).astype(np.uint64)
                        key = np.arange(1, BANDS + 1, dtype=np.uint64)
                        for r in range(ROWS):
                            key = mix64(key * np.uint64(0xD6E8FEB86659FD93) + mh[r:BANDS * ROWS:ROWS])
                        last = (raw, (set_digest(sh), len(sh), signed(key).tolist(),
                                      (mix64(mh[BANDS * ROWS:]) & np.uint64(255)).astype(np.uint8).tobytes()))
                    else:
                        last = (raw, (None, 0, None, None))
                a, b, c, d = last[1]
                rid.append(a), size.append(b), bands.append(c), sig.append(d)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(rid, pa.binary()), pa.array(size, pa.int64()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(sig, pa.binary())],
                names=["id", "rid", "n_shingles", "bands", "sig"])
    return run


def needed_matches(threshold: float, tolerance: float) -> dict[int, int]:
    """Fewest equal signature bytes after n compared ones that leave the
    posterior probability of similarity >= threshold at ``tolerance`` or
    more. Uniform prior; a byte also agrees by chance (1 in 256)."""
    grid = (np.arange(2000) + 0.5) / 2000
    p = grid + (1 - grid) / 256
    out = {}
    for n in range(STEP, SIGNATURE + 1, STEP):
        need = n + 1
        for k in range(n, -1, -1):
            log = k * np.log(p) + (n - k) * np.log1p(-p)
            like = np.exp(log - log.max())
            if like[grid >= threshold].sum() / like.sum() < tolerance:
                break
            need = k
        out[n] = need
    return out


def surviving_pairs(x: np.ndarray, y: np.ndarray, need: dict[int, int], same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of signature rows that no comparison step drops."""
    eq = np.zeros((len(x), len(y)), np.int16)
    for h in range(STEP):
        eq += x[:, h][:, None] == y[:, h][None, :]
    ok = eq >= need[STEP]
    if same:
        ok &= np.arange(len(x))[:, None] < np.arange(len(y))[None, :]
    i, j = np.nonzero(ok)
    got = eq[i, j]
    for n in range(STEP, SIGNATURE, STEP):
        if not len(i):
            break
        got = got + (x[i, n:n + STEP] == y[j, n:n + STEP]).sum(1)
        ok = got >= need[n + STEP]
        i, j, got = i[ok], j[ok], got[ok]
    return i, j


def forest(n: int, i: np.ndarray, j: np.ndarray) -> Iterator[tuple[int, int]]:
    """Star edges (node, smallest node) of the components of n nodes."""
    label = np.arange(n)
    while len(i):
        before = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            break
    for k in np.flatnonzero(label != np.arange(n)):
        yield int(k), int(label[k])


def _split(group: dict[str, list]) -> tuple[list[int], list[int], bool]:
    """Positions of the left and the right block of a block pair."""
    i, j = group["i"][0], group["j"][0]
    rows = range(len(group["rid"]))
    if i == j:
        return list(rows), list(rows), True
    return [k for k in rows if group["blk"][k] == i], [k for k in rows if group["blk"][k] == j], False


def _edges_schema(rows: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()),
                                       pa.array([r[1] for r in rows], pa.binary())], names=["a", "b"])


def _bucket_edges(threshold: float, tolerance: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        need = needed_matches(threshold, tolerance)
        out: list[tuple[bytes, bytes]] = []
        seen: set[tuple[bytes, bytes]] = set()
        for g in sorted_groups(batches, ["key", "i", "j"]):
            left, right, same = _split(g)
            if not left or not right:
                continue
            sig = np.frombuffer(b"".join(g["sig"]), np.uint8).reshape(-1, SIGNATURE)
            x, y = (sig, sig) if same else (sig[left], sig[right])
            i, j = surviving_pairs(x, y, need, same)
            if not len(i):
                continue
            i, j = (i, j) if same else (np.array(left)[i], np.array(right)[j])
            for a, b in forest(len(g["rid"]), i, j):
                e = (g["rid"][a], g["rid"][b])
                if e not in seen:
                    seen.add(e)
                    out.append(e)
            if len(seen) > 200_000:
                seen.clear()
            if len(out) >= 20_000:
                yield _edges_schema(out)
                out = []
        if out:
            yield _edges_schema(out)
    return run


def exact_overlaps(x: list[np.ndarray], y: list[np.ndarray], columns: int = 1 << 16) -> np.ndarray:
    """Sizes of all intersections of two lists of sorted sets, by products of
    membership matrices over slices of the common universe."""
    if len(x) == 1 and len(y) == 1:
        return np.array([[len(np.intersect1d(x[0], y[0], assume_unique=True))]])
    both = x if x is y else x + y
    flat, sizes = np.concatenate(both), [len(s) for s in both]
    universe, code = np.unique(flat, return_inverse=True)
    row = np.repeat(np.arange(len(both)), sizes)
    counts = np.bincount(code)
    shared = counts[code] > 1                     # a shingle of one set meets no other
    remap = np.cumsum(counts > 1) - 1
    code, row, width = remap[code[shared]], row[shared], int((counts > 1).sum())
    total = np.zeros((len(x), len(y)))
    for at in range(0, width, columns):
        m = (code >= at) & (code < at + columns)
        dense = np.zeros((len(both), min(columns, width - at)), np.float32)
        dense[row[m], code[m] - at] = 1
        total += dense[:len(x)] @ (dense if x is y else dense[len(x):]).T
    if x is y:
        np.fill_diagonal(total, [len(s) for s in x])
    return total


def _verify(threshold: float):
    """Block pairs of candidate components -> ``a, b, links``: for each
    member its links (b null), and forest edges (links 0)."""
    def batch(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary()),
             pa.array([r[2] for r in rows], pa.int64())], names=["a", "b", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for g in sorted_groups(batches, ["comp", "i", "j"]):
            left, right, same = _split(g)
            if not left or not right:
                continue
            sets = [np.frombuffer(s, np.uint64) for s in g["shingles"]]
            x = [sets[k] for k in left]
            y = x if same else [sets[k] for k in right]
            inter = exact_overlaps(x, y)
            nx, ny = np.array([len(s) for s in x]), np.array([len(s) for s in y])
            ok = inter >= threshold * (nx[:, None] + ny[None, :] - inter) - 1e-9
            if same:
                np.fill_diagonal(ok, False)
            copies = np.array(g["copies"])
            for k, n in zip(left, ok @ copies[right]):
                if n:
                    out.append((g["rid"][k], None, int(n)))
            if not same:
                for k, n in zip(right, copies[left] @ ok):
                    if n:
                        out.append((g["rid"][k], None, int(n)))
            i, j = np.nonzero(ok)
            for a, b in forest(len(sets), np.array(left)[i], np.array(right)[j]):
                out.append((g["rid"][a], g["rid"][b], 0))
            if len(out) >= 20_000:
                yield batch(out)
                out = []
        if out:
            yield batch(out)
    return run


def _block_pairs(df: DataFrame, size: str, block: int) -> DataFrame:
    """Give each member of a group of ``size`` rows its block and one row for
    each pair of blocks that it takes part in."""
    n = F.ceil(F.col(size) / block).cast("int")
    blk = F.pmod(F.xxhash64("rid"), n).cast("int")
    other = F.explode(F.sequence(F.lit(0), n - 1))
    return (df.withColumn("blk", blk).withColumn("_o", other)
            .withColumn("i", F.least("blk", "_o")).withColumn("j", F.greatest("blk", "_o")).drop("_o", size))


def _shingle_bytes(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, 2):
            sets = [np.unique(shingle_hashes(word_hashes(t or b""), width)) for t in b.column(2).to_pylist()]
            # ids need not be unique: a row whose set is another one is left out
            own = pa.array([set_digest(s) == r for s, r in zip(sets, b.column(0).to_pylist())], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([s.tobytes() for s in sets], pa.binary())],
                                             names=["rid", "comp", "shingles"]).filter(own)
    return run


def with_digests(rows: DataFrame, width: int = 5) -> DataFrame:
    """``rows``, one of whose columns is the binary ``text``, and the digest
    ``rid`` of their shingle sets."""
    at = rows.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, at):
            sets = [np.unique(shingle_hashes(word_hashes(t or b""), width)) for t in b.column(at).to_pylist()]
            rid = pa.array([set_digest(s) if len(s) else None for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns, rid], names=[*b.schema.names, "rid"])
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("rid", T.BinaryType())]))


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                 threshold: float = 0.8, tolerance: float = 1e-6, bucket_block: int = 512,
                 verify_block: int = 64, digests: bool = False) -> DataFrame:
    """``id, class_id, n_links, n_shingles``: one row for each input row.

    ``class_id``: smallest id among the documents connected by links;
    ``n_links``: other documents with similarity >= ``threshold``, copies
    included. Pairs of documents are never materialised. With ``digests`` also
    ``rid, root``: digests of the row's shingle set and of its class (null
    without words), which tell rows of one id apart.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    described = scratch(src.mapInArrow(
        _describe(width), f"id {src.schema['id'].dataType.simpleString()}, rid binary, n_shingles long, bands array<long>, sig binary"))
    reps = scratch(described.where("rid is not null").groupBy("rid").agg(
        F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies"),
        F.first("bands").alias("bands"), F.first("sig").alias("sig")))

    banded = reps.select("rid", F.explode("bands").alias("key"))
    sizes = banded.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    members = banded.join(sizes, "key").select("key", "rid", "members")
    blocks = _block_pairs(members, "members", bucket_block)
    blocks = blocks.join(reps.select("rid", "sig"), "rid")
    candidates = by_sorted_keys(blocks.select("key", "i", "j", "blk", "rid", "sig"), ["key", "i", "j"],
                                _bucket_edges(threshold, tolerance), "a binary, b binary")

    comp = scratch(components(candidates).select(F.col("node").alias("rid"), F.col("root").alias("comp")))
    # One text of each candidate: the document with the smallest id of those with its set.
    wanted = broadcast_if_small(described.select("id", "rid").join(broadcast_if_small(
        comp.join(reps.select("rid", "first_id"), "rid")), "rid").where("id <=> first_id")
        .select(F.col("id").alias("_id"), "rid", "comp").distinct())
    texts = src.join(wanted, src["id"].eqNullSafe(wanted["_id"])).select("rid", "comp", "text")
    sets = texts.mapInArrow(_shingle_bytes(width), "rid binary, comp binary, shingles binary")
    sets = scratch(sets.groupBy("rid").agg(F.first("comp").alias("comp"), F.first("shingles").alias("shingles")))
    comp_sizes = comp.groupBy("comp").agg(F.count(F.lit(1)).alias("members"))
    pairs = _block_pairs(sets.join(comp_sizes, "comp").join(reps.select("rid", "copies"), "rid"), "members", verify_block)
    verified = scratch(by_sorted_keys(pairs.select("comp", "i", "j", "blk", "rid", "copies", "shingles"),
                                      ["comp", "i", "j"], _verify(threshold), "a binary, b binary, links long"))
    links = verified.where("b is null").groupBy(F.col("a").alias("rid")).agg(F.sum("links").alias("links"))
    roots = components(verified.where("b is not null").select("a", "b")).select(
        F.col("node").alias("rid"), F.col("root").alias("root"))

    per_rep = (reps.select("rid", "first_id", "copies").join(roots, "rid", "left").join(links, "rid", "left")
               .withColumn("root", F.coalesce("root", "rid")))
    least = per_rep.groupBy("root").agg(F.min("first_id").alias("class_id"))
    per_rep = per_rep.join(least, "root").select(
        "rid", "root", "class_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    return described.select("id", "rid", "n_shingles").join(per_rep, "rid", "left").select(
        F.col("id").alias(id_col), F.coalesce("class_id", "id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "n_shingles",
        *(["rid", "root"] if digests else []))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``documents`` with its near-duplicate class and links."""
    return jaccard_join(table(spark, sf_dir, "documents"))
