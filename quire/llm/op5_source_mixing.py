"""Mixing sources to target weights, DataFrame operations only.

Source i holds a share s_i of the tokens. Its weight is s_i^t / sum s_j^t: at
exponent (inverse temperature) t = 1 the natural mix, at 0 equal weights. The
exponent is found by bisection, as the smallest in [0, 1] at which no source
is repeated more than ``max_repeats`` times, or as the largest at which the
entropy of the weights reaches ``target_entropy`` (a fraction of log n). With
``entropy_gain`` the target is that fraction of the way from the entropy of
the natural mix to log n, so on any shares that differ the exponent lies
strictly between 0 and 1.

With a budget of B tokens (or ``passes`` times the tokens of the input) source i gets B * w_i, realised as whole
permutations of its documents and a part of one: copies = floor(quota /
tokens), and one more for the documents that come first in the next
permutation while they fit the rest. Without ``budget`` B is the smallest for
which every document is taken at least once, so nothing is lost.

A permutation orders documents by a hash of (seed, epoch, id). The part of one
is cut without ordering a source in one task: token sums of hash buckets find
the bucket with the cut, and only that bucket is ordered. A source of n
documents has sqrt(n) buckets of about sqrt(n) documents.

The stream of a source is laid over ``blocks`` equal blocks of the budget, so
each block holds every source at its weight (``mix_block``, then
``mix_order`` inside it).

Nulls and edge cases: a null source is a source of its own; a null text has no
tokens. Documents without tokens are taken as often as whole permutations
occur. A source without tokens has weight 0 and its rows are taken once. Null
ids and repeated rows hash alike and are taken or left together. An empty
table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, scratch, table

MAX_REPEATS, BLOCKS, SEED = 2.0, 64, 5
#: The registered query: entropy half way to equal weights, two passes of tokens.
ENTROPY_GAIN, PASSES = 0.5, 2.0
_HALVINGS, _ROUNDS = 6, 5


def token_count(text: str):
    """Words without ASCII white space; 0 for null."""
    words = F.regexp_count(F.col(text), F.lit("[^\\x20\\x09-\\x0D]+"))
    return F.coalesce(words, F.lit(0)).cast("long")


def find_exponent(shares: DataFrame, max_repeats: float | None, target_entropy: float | None) -> float:
    """Bisect the exponent; ``shares(s)`` has a row for each source with
    tokens. One aggregation evaluates the 63 points that six halvings can
    visit; only their sums reach the driver."""
    low, high = 0.0, 1.0
    n = 1 << _HALVINGS
    for _ in range(_ROUNDS):
        points = [low + (high - low) * k / n for k in range(1, n)]
        aggs = [F.count(F.lit(1)).alias("n"), F.min("s").alias("lo"), F.max("s").alias("hi")]
        for k, t in enumerate(points):
            aggs += [F.sum(F.pow("s", F.lit(t))).alias(f"z{k}"),
                     F.sum(F.pow("s", F.lit(t)) * F.log("s")).alias(f"e{k}")]
        r = shares.agg(*aggs).first()
        if not r["n"] or r["n"] == 1:
            return 1.0

        def fits(k: int) -> bool:
            """Is the exponent large enough (mix natural enough)?"""
            t = points[k]
            if target_entropy is not None:
                entropy = math.log(r[f"z{k}"]) - t * r[f"e{k}"] / r[f"z{k}"]
                return entropy < target_entropy * math.log(r["n"])
            return (r["hi"] / r["lo"]) ** (1 - t) <= max_repeats
        a, b = 0, n                            # grid positions of low and high
        while b - a > 1:
            mid = (a + b) // 2
            a, b = (a, mid) if fits(mid - 1) else (mid, b)
        low, high = low + (high - low) * a / n, low + (high - low) * b / n
    return low if target_entropy is not None else high


def entropy_between(shares: DataFrame, gain: float) -> float:
    """The entropy, as a fraction of log n, that lies ``gain`` of the way from
    that of the shares to log n."""
    r = shares.agg(F.count(F.lit(1)).alias("n"), F.sum(-F.col("s") * F.log("s")).alias("h")).first()
    if not r["n"] or r["n"] == 1:
        return 1.0
    natural = r["h"] / math.log(r["n"])
    return natural + gain * (1 - natural)


def source_plan(docs: DataFrame, source_col: str, id_col: str, text_col: str, budget: float | None = None,
                max_repeats: float | None = MAX_REPEATS, target_entropy: float | None = None, seed: int = SEED,
                passes: float | None = None, entropy_gain: float | None = None) -> DataFrame:
    """A row for each source: ``src, n_docs, tokens, share, exponent, weight,
    quota, whole`` (permutations) and ``cut`` (documents whose hash is at most this
    are taken once more; null: none)."""
    counted = scratch(docs.select(F.col(source_col).alias("src"), F.col(id_col).alias("id"),
                                  token_count(text_col).alias("n_tokens")))
    per = counted.groupBy("src").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("tokens"))
    per = scratch(per)
    tokens = per.agg(F.sum("tokens")).first()[0] or 0
    per = per.withColumn("share", F.col("tokens") / F.lit(float(tokens or 1)))
    shares = per.where("tokens > 0").select(F.col("share").alias("s"))
    if entropy_gain is not None:
        target_entropy = entropy_between(shares, entropy_gain)
    t = find_exponent(shares, max_repeats, target_entropy)
    power = F.when(F.col("tokens") > 0, F.pow("share", F.lit(t))).otherwise(0.0)
    total = per.agg(F.sum(power), F.max("share")).first()
    z, top = total[0] or 1.0, total[1] or 1.0
    if passes is not None:
        budget = passes * tokens
    size = float(budget) if budget is not None else tokens * top ** (1 - t) * z
    plan = (per.withColumn("exponent", F.lit(t)).withColumn("weight", power / z).withColumn("quota", F.col("weight") * size)
            .withColumn("whole", F.when(F.col("tokens") > 0, F.floor(F.col("quota") / F.col("tokens") + 1e-9)).otherwise(1))
            .withColumn("rest", F.col("quota") - F.col("whole") * F.col("tokens"))
            .withColumn("buckets", F.ceil(F.sqrt(F.col("n_docs")))))

    # Where the next permutation stops: first the bucket, then the document.
    # The hash is 62 bits wide; a bucket is a range of it.
    wide = float(1 << 62)
    keyed = counted.join(broadcast_if_small(plan.select(F.col("src").alias("p"), "whole", "rest", "buckets")),
                         F.col("src").eqNullSafe(F.col("p"))).select(
        "src", "id", "n_tokens", "rest", "whole", "buckets", order_hash("id", "whole", seed).alias("h"))
    keyed = keyed.withColumn("bucket", F.floor(F.col("h") / F.lit(wide) * F.col("buckets")))
    sums = keyed.groupBy("src", "bucket").agg(F.sum("n_tokens").alias("bt"), F.first("rest").alias("rest"))
    before = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    cut = (sums.withColumn("base", F.coalesce(F.sum("bt").over(before), F.lit(0)))
           .where("base <= rest and base + bt > rest").select(F.col("src").alias("c"), F.col("bucket").alias("cb"), "base"))
    inside = keyed.join(broadcast_if_small(cut), F.col("src").eqNullSafe(F.col("c")) & (F.col("bucket") == F.col("cb")))
    # equal hashes are peers of the range frame: taken or left together
    running = F.sum("n_tokens").over(Window.partitionBy("src").orderBy("h"))
    edge = (inside.withColumn("run", F.col("base") + running)
            .groupBy("src").agg(F.max(F.when(F.col("run") <= F.col("rest"), F.col("h"))).alias("last"),
                                F.min("h").alias("lowest")))
    edge = edge.select(F.col("src").alias("e"), F.coalesce("last", F.col("lowest") - 1).alias("cut"))
    # a source whose buckets all fit the rest has no cut inside (only by rounding)
    return plan.join(broadcast_if_small(edge), F.col("src").eqNullSafe(F.col("e")), "left").drop("e", "buckets")


def order_hash(id_col: str, epoch, seed: int):
    """62-bit place of a document in the permutation of an epoch."""
    epoch = F.col(epoch) if isinstance(epoch, str) else epoch
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), epoch.cast("long"), F.col(id_col)), 2)


def mix(docs: DataFrame, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text",
        blocks: int = BLOCKS, seed: int = SEED, **options) -> DataFrame:
    """All columns of ``docs`` in a struct ``row``, one row for each time a
    document is taken, with ``epoch, mix_block, mix_order, weight, quota, exponent``.
    ``options`` go to :func:`source_plan`."""
    plan = source_plan(docs, source_col, id_col, text_col, seed=seed, **options).select(
        F.col("src").alias("p"), "whole", "cut", "weight", "quota", "exponent", "tokens")
    packed = docs.select(F.struct("*").alias("row"), F.col(source_col).alias("src"), F.col(id_col).alias("id"))
    taken = packed.join(broadcast_if_small(plan), F.col("src").eqNullSafe(F.col("p")))
    extra = (order_hash("id", "whole", seed) <= F.col("cut")).cast("int")
    copies = F.col("whole").cast("int") + F.coalesce(extra, F.lit(0))
    taken = taken.withColumn("copies", copies).where("copies > 0").withColumn(
        "epoch", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    place = (F.col("epoch") + order_hash("id", "epoch", seed) / F.lit(float(1 << 62))) * F.col("tokens")
    part = F.coalesce(place / F.nullif("quota", F.lit(0.0)), F.lit(0.0))
    return taken.select(
        "row", "epoch", F.least(F.floor(part * blocks), F.lit(blocks - 1)).cast("int").alias("mix_block"),
        F.xxhash64(F.lit(seed + 1), "epoch", "id").alias("mix_order"), "weight", "quota", "exponent")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every time a document is taken: its source's weight, the exponent, the
    epoch and the place in the mix. The mix has ``PASSES`` times the tokens of
    the table."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs, entropy_gain=ENTROPY_GAIN, passes=PASSES).select("row.doc_id", "row.source", token_count("row.text").alias("n_tokens"),
                            "epoch", "mix_block", "mix_order", "weight", "exponent")
