"""Fill statistics that do not fit one plain aggregate: exact median and mode.

Both are computed without gathering a column into one task:

* median: an approximate quantile with a known rank error gives two values that
  the median lies between; one grouped count of the few values between them, and
  of what lies below, finds the exact rank.
* mode: one grouped count per (column, value), combined map-side, then a
  per-column minimum of ``(-count, value)``, so ties go to the smallest value.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesmith.functions.casts import kind_of

#: Accuracy of the quantile sketch: its rank error is at most rows / this.
_ACCURACY = 2_000
#: Different values between two bounds that the driver may look at.
_LOOKED_AT = 100_000


@dataclass
class _Band:
    """Where the middle values of a column lie: ``low`` to ``high`` (both
    included, None: open), ``below`` values under it, ``inside`` in it."""
    key: str
    total: int = 0
    inside: int = 0
    below: int = 0
    low: float | None = None
    high: float | None = None

    def ranks(self) -> tuple[int, int]:
        return (self.total - 1) // 2, self.total // 2

    def holds(self) -> Column:
        x = F.col(self.key)
        bounds = [x.isNotNull()] + ([x >= self.low] if self.low is not None else []) + (
            [x <= self.high] if self.high is not None else [])
        return reduce(lambda a, b: a & b, bounds)

    def bounds(self) -> Column:
        """Values of the band at ranks that surely enclose both middle ranks."""
        if self.inside:
            slack = self.inside // _ACCURACY + 1
            low, high = ((r - self.below + d) / self.inside for r, d in zip(self.ranks(), (-slack, 1 + slack)))
        else:  # nothing is counted yet
            low, high = 0.5 - 2 / _ACCURACY, 0.5 + 2 / _ACCURACY
        return F.percentile_approx(F.when(self.holds(), F.col(self.key)), F.array(F.lit(max(0.0, low)), F.lit(min(1.0, high))), F.lit(_ACCURACY))

    def median(self, counts: list[tuple[float, int]]) -> float:
        """From the different values of the band and how often each occurs."""
        found, seen, wanted = [], self.below, list(self.ranks())
        for value, n in sorted(counts):
            seen += n
            while wanted and wanted[0] < seen:
                found.append(value)
                wanted.pop(0)
        return sum(found) / 2.0


def exact_medians(df: DataFrame, exprs: dict[str, Column]) -> dict[str, float | None]:
    """Median of the non-null values of every expression (the mean of the two
    middle values for an even count), exactly.

    One scan sketches all columns, one counts what lies between the sketched
    bounds.  Where more than ``_LOOKED_AT`` different values do (the bounds
    shrink the rows about a thousandfold), the bounds are sketched again inside.
    """
    if not exprs:
        return {}
    columns = df.select(*[F.nanvl(e.cast("double"), F.lit(None).cast("double")).alias(k) for k, e in exprs.items()])
    medians: dict[str, float | None] = dict.fromkeys(exprs)
    bands = [_Band(k) for k in exprs]
    while bands:
        found = columns.agg(*[c for b in bands for c in (F.count(F.col(b.key)), b.bounds())]).first()
        bands = [_Band(b.key, found[2 * i], b.inside, b.below, *found[2 * i + 1]) for i, b in enumerate(bands) if found[2 * i]]
        if not bands:
            break
        # a value under its band counts under the null of its column
        cells = [F.when(F.col(b.key) <= b.high, F.struct(F.lit(i).alias("i"), F.when(F.col(b.key) >= b.low, F.col(b.key)).alias("v")))
                 for i, b in enumerate(bands)]
        counted = columns.select(F.explode(F.array(*cells)).alias("c")).where("c is not null").groupBy("c.i", "c.v").count()
        rows = counted.orderBy("i", F.col("v").asc_nulls_first()).limit(_LOOKED_AT + 1).collect()
        if len(rows) > _LOOKED_AT:
            inside = F.when(F.col("v").isNotNull(), F.col("count")).otherwise(0)
            bands = [replace(bands[r["i"]], inside=r["inside"], below=r["all"] - r["inside"]) for r in
                     counted.groupBy("i").agg(F.sum(inside).alias("inside"), F.sum("count").alias("all")).collect()]
            continue
        for i, b in enumerate(bands):
            own = [(r["v"], r["count"]) for r in rows if r["i"] == i]
            medians[b.key] = replace(b, below=sum(n for v, n in own if v is None)).median([x for x in own if x[0] is not None])
        break
    return medians


def exact_median(df: DataFrame, expr: Column) -> float | None:
    return exact_medians(df, {"x": expr})["x"]


def _sort_key(c: Column, dt: T.DataType) -> Column:
    k = kind_of(dt)
    if k in ("integer", "wide", "float", "boolean"):
        return c.cast("double")
    if k == "datetime":
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return F.lit(None).cast("double")


def modes(df: DataFrame, cols: dict[str, tuple[Column, T.DataType]]) -> dict[str, str | None]:
    """Most frequent non-null value per column, as text (None if all null).

    One pass: every row yields one ``(column, value)`` pair per requested
    column, pairs are counted with map-side combining, and each column keeps
    the pair with the highest count (smallest value on ties).
    """
    if not cols:
        return {}
    names = list(cols)
    pairs = [F.struct(F.lit(i).alias("k"), c.cast("string").alias("s"), _sort_key(c, dt).alias("o"))
             for i, (c, dt) in enumerate(cols.values())]
    exploded = df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").where(F.col("s").isNotNull())
    counts = exploded.groupBy("k", "o", "s").count()
    best = counts.groupBy("k").agg(F.min(F.struct((-F.col("count")).alias("nc"), "o", "s")).alias("m"))
    found = {r["k"]: r["m"]["s"] for r in best.collect()}
    return {name: found.get(i) for i, name in enumerate(names)}
