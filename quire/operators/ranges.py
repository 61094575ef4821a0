"""Runs of an ordered table: the base of segmented scans and as-of joins.

Rows are dealt by *runs* of their (term, id) order instead of by term, so that a
term that every document has is as many groups as its share of the rows asks
for, and a rare one is a single group. The borders between runs are quantiles
of a sample of all rows that take part (for a join: of both sides together), so
they balance whatever the ids or the skew are; as literals of the plan they do
not change when a task runs again. Borders only decide where a row is worked
on, never the result.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import MAX_BROADCAST_ROWS, MAX_LITERAL_BORDERS, MIN_RUN_ROWS, RUNS_PER_PARTITION, SAMPLES_PER_RUN, TASK_ROWS
from ..functions.batches import picked_ids, split_lists


def tasks(rows: int, spark: SparkSession) -> int:
    """Tasks for so many posting rows: in proportion to them once each has its
    fill, else the shuffle partitions, none with under ``MIN_RUN_ROWS``."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-rows // TASK_ROWS), min(partitions, rows // MIN_RUN_ROWS))


@dataclass
class Ranges:
    """Borders ``(term, id)`` in ascending order; run ``r`` holds the rows at
    or after border ``r - 1`` and before border ``r``."""

    borders: list[tuple[str, int]]
    rows: int = 0              # of the table that was sampled, if counted

    @classmethod
    def of(cls, table: DataFrame, term: str, key: str, runs: int | None = None, weight: str | None = None,
           per_partition: int = RUNS_PER_PARTITION, many: str | None = None) -> Ranges:
        """Borders of ``table``, which should be written already: it is
        counted and sampled. ``runs`` are by default a few for each shuffle
        partition, but none of under ``MIN_RUN_ROWS`` rows. With a ``weight``
        column runs are even by its sum, not by rows. ``many``: a row is a
        stretch of a list that holds so many keys, and counts as so many rows."""
        if weight is not None and runs is not None:
            return cls._weighted(table, term, key, runs, weight)
        rows = table.agg(F.sum(many)).first()[0] or 0 if many else table.count()
        if runs is None:
            partitions = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            runs = min(max(per_partition * partitions, rows // TASK_ROWS), rows // MIN_RUN_ROWS)
        if runs <= 1 or not rows:
            return cls([], rows)
        # the sample is a few rows a run
        share = min(1.0, SAMPLES_PER_RUN * runs / rows)
        if many:
            # of each stretch as many as its share
            taken = table.select(F.col(term).alias("t"), F.col(key).alias("doc_ids"), F.col(many).alias("n"), F.rand(seed=8).alias("r"),
                                 F.floor(F.col(many) * share + F.rand(seed=7)).cast("int").alias("picks")).where("t is not null and picks > 0")
            found = taken.mapInArrow(picked_ids, "t string, k bigint")
        else:
            found = table.select(F.col(term).alias("t"), F.col(key).alias("k")).where("t is not null and k is not null")
            found = found if share == 1.0 else found.sample(share, seed=7)
        sample = sorted(((r["t"], r["k"]) for r in found.collect()), key=lambda r: (r[0].encode(), r[1]))
        borders = [sample[len(sample) * i // runs] for i in range(1, runs)] if sample else []
        return cls(list(dict.fromkeys(borders)), rows)

    @classmethod
    def _weighted(cls, table: DataFrame, term: str, key: str, runs: int, weight: str) -> Ranges:
        """A row is sampled with a chance in proportion to its weight, and
        stands for as many others; heavy rows are always in the sample."""
        total = table.agg(F.sum(weight)).first()[0]
        if runs <= 1 or not total:
            return cls([])
        chance = F.least(F.lit(1.0), F.col(weight) * (SAMPLES_PER_RUN * runs / total))
        found = table.select(F.col(term).alias("t"), F.col(key).alias("k"), (F.col(weight) / chance).alias("w"), chance.alias("p")).where(
            (F.col("p") > 0) & (F.rand(seed=7) < F.col("p")))
        sample = sorted(((r["t"], r["k"], r["w"]) for r in found.collect()), key=lambda r: (r[0].encode(), r[1]))
        borders, at, step = [], 0.0, sum(w for _, _, w in sample) / runs
        for t, k, w in sample:
            # a border stands before the row whose middle passes the next share
            if len(borders) < runs - 1 and at + w / 2 > step * (len(borders) + 1):
                borders.append((t, k))
            at += w
        return cls(list(dict.fromkeys(borders)))

    def run(self, term: str, key: str) -> Column:
        """Number of a row's run: a binary search in the borders, as a tree of
        comparisons if they are few; else of terms for each distinct term of a
        batch, of ids for all rows of a term that has borders."""
        known = F.col(term).isNotNull() & F.col(key).isNotNull()
        if not self.borders:
            return F.lit(0)
        if len(self.borders) <= MAX_LITERAL_BORDERS:
            return F.when(known, self._search(F.col(term), F.col(key), 0, len(self.borders))).otherwise(F.lit(0))
        terms = sorted({t.encode() for t, _ in self.borders})
        ids: dict[bytes, list[int]] = {t: [] for t in terms}
        for t, k in self.borders:
            ids[t.encode()].append(k)
        starts = np.cumsum([0, *(len(ids[t]) for t in terms)])        # borders of terms before
        inside = {t: np.array(ids[t], np.int64) for t in terms}

        @F.pandas_udf("int")
        def number(t: pd.Series, k: pd.Series) -> pd.Series:
            codes, words = pd.factorize(t)
            found = [bisect.bisect_left(terms, w.encode()) for w in words]
            runs = starts[found][codes]
            for code, (at, w) in enumerate(zip(found, words)):
                if at < len(terms) and terms[at] == w.encode():
                    rows = np.flatnonzero(codes == code)
                    runs[rows] += np.searchsorted(inside[terms[at]], k.to_numpy()[rows], side="right")
            return pd.Series(runs.astype(np.int32))
        return F.when(known, number(F.coalesce(F.col(term), F.lit("")), F.coalesce(F.col(key), F.lit(0).cast("bigint")))).otherwise(F.lit(0))

    def _search(self, t: Column, k: Column, low: int, high: int) -> Column:
        """Borders at or before a row, of which there are ``low`` to ``high``."""
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        word, number = self.borders[middle]
        after = (t > F.lit(word)) | ((t == F.lit(word)) & (k >= F.lit(number)))
        return F.when(after, self._search(t, k, middle + 1, high)).otherwise(self._search(t, k, low, middle))

    def of_spanning(self, rows: DataFrame, term: str = "term") -> DataFrame:
        """Rows of the terms that a border lies in: only they can have several
        runs."""
        terms = sorted({t for t, _ in self.borders})
        if not terms:
            return rows.limit(0)
        return rows.where(F.col(term).isin(terms))

    def spanning_runs(self, rows: DataFrame, term: str, key: str) -> DataFrame:
        """``of_spanning`` with the column ``run``, looked up by term: few
        borders lie in one list."""
        spark, terms = rows.sparkSession, {}
        for at, (t, k) in enumerate(self.borders):
            terms.setdefault(t, (at, []))[1].append(k)
        table = spark.createDataFrame([(t, at, ks) for t, (at, ks) in terms.items()], f"`{term}` STRING, _at INT, _ids ARRAY<BIGINT>")
        joined = self.of_spanning(rows, term).join(F.broadcast(table), term) if terms else rows.limit(0).join(table, term)
        return joined.withColumn("run", F.col("_at") + F.size(F.filter("_ids", lambda k: k <= F.col(key)))).drop("_at", "_ids")

    def spanning_lists(self, rows: DataFrame) -> DataFrame:
        """``spanning_runs`` of stretches of lists ``term, n, doc_ids, tfs``,
        which are cut at the borders."""
        borders: dict[str, tuple[int, list[int]]] = {}
        for at, (t, k) in enumerate(self.borders):
            borders.setdefault(t, (at, []))[1].append(k)
        return self.of_spanning(rows).select("term", "n", "doc_ids", "tfs").mapInArrow(
            lambda batches: split_lists(batches, borders), "term string, run int, n int, last bigint, doc_ids binary, tfs binary")

    def of_others(self, rows: DataFrame, term: str = "term") -> DataFrame:
        """Rows of all other terms: each list is in one run."""
        terms = sorted({t for t, _ in self.borders})
        return rows.where(F.coalesce(~F.col(term).isin(terms), F.lit(True))) if terms else rows

    def with_carries(self, rows: DataFrame, carried: DataFrame) -> DataFrame:
        """``rows`` with the columns of ``carried(term, run, ...)``, NULL for
        terms in one run. There is at most one carry for each border and
        spanning term, so twice the number of borders bounds the broadcast."""
        if not self.borders:
            extra = [f for f in carried.schema if f.name not in ("term", "run")]
            return rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in extra])
        small = F.broadcast(carried) if 2 * len(self.borders) <= MAX_BROADCAST_ROWS else carried
        return rows.join(small, ["term", "run"], "left")
