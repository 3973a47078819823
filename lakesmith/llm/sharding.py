"""Uniform shuffle into shards of exact sizes (operator 5).

The rows lie in source partitions of known sizes.  A communication matrix says
how many rows each partition sends to each shard; its law is the multivariate
hypergeometric distribution with the partition sizes as row sums and the shard
sizes as column sums.  Given its row of the matrix, a partition deals its rows
by a local random permutation, the rows are exchanged, and every shard is
permuted again.  The result is a uniform random permutation cut into shards
whose sizes differ by one row at most.

Scale.  The partitions' sizes (one number per partition, which the scheduler
tracks anyway) come to the driver; the matrix does not.  The driver draws only
a coarse matrix of about sqrt(partitions) partition groups times shards; a
task draws the rows of its own group from it.  Everything random derives from
``seed`` and stored row numbers, so a recomputed task repeats its draw.  The
second permutation splits a shard into bins of about ``BIN_ROWS`` rows by the
high bits of each row's random key, so no task holds a shard.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakesmith.llm.common import col, kept_columns, staged

#: Mean rows of a bin of the second permutation.
BIN_ROWS = 200_000
ADDED = ["shard", "slot"]


def shard_sizes(total: int, shards: int) -> np.ndarray:
    """Rows of each shard: equal, the first ones larger by one."""
    return np.array([total // shards + (s < total % shards) for s in range(shards)], dtype=np.int64)


def draw_matrix(rng: np.random.Generator, row_sums: np.ndarray, column_sums: np.ndarray) -> np.ndarray:
    """A random matrix with these margins, as a uniform random permutation gives it."""
    left = column_sums.astype(np.int64).copy()
    out = np.zeros((len(row_sums), len(left)), dtype=np.int64)
    for i, n in enumerate(row_sums):
        out[i] = _hypergeometric(rng, left, int(n))
        left -= out[i]
    return out


def _hypergeometric(rng: np.random.Generator, left: np.ndarray, n: int) -> np.ndarray:
    """n rows drawn without replacement from shards with ``left`` free places."""
    out = np.zeros(len(left), dtype=np.int64)
    rest = int(left.sum())
    for j, places in enumerate(left):
        rest -= int(places)
        if n == 0:
            break
        out[j] = _one_cell(rng, int(places), rest, n)
        n -= int(out[j])
    return out


#: Standard deviations around the mode that a large draw looks at; what lies outside has a mass below 1e-30.
FAR = 12
#: Urn size from which the generator's own draw is not available.
GENERATOR_LIMIT = 1_000_000_000


def _one_cell(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    if good + bad < GENERATOR_LIMIT:
        return int(rng.hypergeometric(good, bad, n)) if good else 0
    return _by_inversion(rng, good, bad, n)


def _by_inversion(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """A hypergeometric draw from an urn of any size.

    The ratio of neighbouring probabilities is a quotient of whole numbers, so
    their running product gives the law up to a factor, which its sum removes:
    no factorial is approximated, only rounded.
    """
    total, low, high = good + bad, max(0, n - bad), min(n, good)
    mode = (n + 1) * (good + 1) // (total + 2)
    spread = math.sqrt(n / total * good * (bad / total) * ((total - n) / max(1, total - 1)))
    reach = int(FAR * spread) + 60
    first, last = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(first, last, dtype=np.float64)
    steps = np.log((good - k) / (k + 1)) + np.log((n - k) / (bad - n + k + 1))
    law = np.cumsum(np.r_[0.0, steps], dtype=np.longdouble)
    upto = np.cumsum(np.exp(law - law.max()))
    return first + int(np.searchsorted(upto, rng.random() * upto[-1], side="right"))


class Dealer:
    """Deals the rows of numbered partitions to shards, the same way every time."""

    def __init__(self, sizes: dict[int, int], shards: int, seed: int):
        self.seed, self.parts = seed, sorted(sizes)
        self.sizes = np.array([sizes[p] for p in self.parts], dtype=np.int64)
        self.width = max(1, math.isqrt(len(self.parts)))
        groups = [self.sizes[i:i + self.width].sum() for i in range(0, len(self.parts), self.width)]
        self.coarse = draw_matrix(np.random.default_rng([seed, 0]), np.array(groups, dtype=np.int64),
                                  shard_sizes(int(self.sizes.sum()), shards))
        self.group, self.matrix = -1, None
        self.part, self.dealt = -1, None

    def shards_of(self, part: int, positions: np.ndarray) -> np.ndarray:
        """Shards of the rows at ``positions`` of partition ``part``."""
        if part != self.part:
            at = int(np.searchsorted(self.parts, part))
            group = at // self.width
            if group != self.group:
                rows = self.sizes[group * self.width:(group + 1) * self.width]
                self.matrix = draw_matrix(np.random.default_rng([self.seed, 1, group]), rows, self.coarse[group])
                self.group = group
            dealt = np.repeat(np.arange(self.matrix.shape[1], dtype=np.int32), self.matrix[at % self.width])
            np.random.default_rng([self.seed, 2, part]).shuffle(dealt)
            self.part, self.dealt = part, dealt
        return self.dealt[positions]


def shuffle_into_shards(docs: DataFrame, shards: int = 40, seed: int = 20240501,
                        bin_rows: int = BIN_ROWS) -> DataFrame:
    """All rows and columns of ``docs`` plus ``shard`` (0 to shards-1) and ``slot``
    (place inside the shard, gapless from 0).

    Shard row counts differ by one at most.  Rows count as rows: repeated rows,
    null ids and empty texts are dealt like any other.  Fewer rows than shards
    leave the last shards empty; an empty table gives an empty result.  Input
    columns named shard or slot are replaced.
    """
    keep = kept_columns(docs, ADDED)
    fixed = staged(docs.select(*[col(c).alias(f"c{i}") for i, c in enumerate(keep)],
                               F.monotonically_increasing_id().alias("__rid")), "shard-rows")
    part, position = F.shiftright("__rid", 33), F.col("__rid").bitwiseAND((1 << 33) - 1)
    # partitions hold consecutive row numbers from 0, so the last one gives the size
    sizes = {r["p"]: r["n"] for r in fixed.groupBy(part.alias("p")).agg((F.max(position) + 1).alias("n")).collect()}
    total = sum(sizes.values())
    dealer = Dealer(sizes, shards, seed)

    @F.pandas_udf("int")
    def deal(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:  # only the row numbers travel to Python
            rid = batch.to_numpy(np.int64)
            parts, shard = rid >> 33, np.zeros(len(rid), np.int32)
            for p in np.unique(parts):
                here = parts == p
                shard[here] = dealer.shards_of(int(p), rid[here] & ((1 << 33) - 1))
            yield pd.Series(shard)

    dealt = fixed.withColumn("__shard", deal("__rid"))
    bins = max(1, math.ceil(total / shards / bin_rows))
    key = F.xxhash64(F.lit(seed), "__rid")  # the row's random place: the second permutation
    binned = dealt.withColumn("__key", key).withColumn(
        "__bin", F.floor((F.shiftrightunsigned("__key", 32).cast("double") / 2.0 ** 32) * bins).cast("long"))
    # the counts deal the row numbers once more: cheaper than another copy of the rows
    placed = binned.repartition("__shard", "__bin")
    counts = placed.groupBy("__shard", "__bin").agg(F.count(F.lit(1)).alias("__n"))
    first = counts.withColumn("__first", F.coalesce(F.sum("__n").over(
        Window.partitionBy("__shard").orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    within = F.row_number().over(Window.partitionBy("__shard", "__bin").orderBy("__key", "__rid"))
    numbered = placed.withColumn("__within", within).join(first.drop("__n"), ["__shard", "__bin"])
    return numbered.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], F.col("__shard").alias("shard"),
                           (F.col("__first") + F.col("__within") - 1).alias("slot"))
