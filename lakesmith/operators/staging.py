"""Compiling an ordered rule list into few Spark jobs (section 4.2 of the plan).

Rules are sequential, and several need a statistic of the column as it is
at that point (mean, median, mode, date format, integer guard).  A naive
translation would run one job per rule.  ``Stage`` keeps every column as a
lazy expression over one base DataFrame and collects statistic requests;
they are all answered by one aggregate (plus the grouped mode pass and the
median passes) when a later rule needs a value that depends on them, when a
row-removing rule arrives, or at the end.  A default rule set therefore
costs one statistics pass and one projection per table.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesmith.functions.stats import exact_medians, modes
from lakesmith.sources.tables import ROW_ORDER

Step = Callable[[Column, T.DataType, dict], tuple[Column, T.DataType]]


class Stage:
    def __init__(self, df: DataFrame):
        self._reset(df)
        self._keys = itertools.count()
        self.jobs = 0

    def _reset(self, df: DataFrame) -> None:
        self.base = df
        self.cols: dict[str, tuple[Column, T.DataType]] = {
            f.name: (F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields if f.name != ROW_ORDER}
        self.chains: dict[str, list[Step]] = {}
        self.aggs: list[Column] = []
        self.medians: dict[str, Column] = {}
        self.modes: dict[str, tuple[Column, T.DataType]] = {}

    # -- column bookkeeping -------------------------------------------------
    def has(self, name: str) -> bool:
        return bool(name) and name in self.cols

    def dtype(self, name: str) -> T.DataType:
        return self.cols[name][1]

    def names(self) -> list[str]:
        return list(self.cols)

    def new_key(self) -> str:
        return f"s{next(self._keys)}"

    def rename(self, src: str, dst: str) -> None:
        if dst in self.cols and dst != src:
            self.drop(dst)
        self.cols = {(dst if k == src else k): v for k, v in self.cols.items()}
        if src in self.chains:
            self.chains[dst] = self.chains.pop(src)

    def drop(self, name: str) -> None:
        self.cols.pop(name, None)
        self.chains.pop(name, None)

    def set(self, name: str, col: Column, dt: T.DataType) -> None:
        """Replace (or append) a column with a fresh expression."""
        self.chains.pop(name, None)
        self.cols[name] = (col, dt)

    # -- transformations ----------------------------------------------------
    def map(self, name: str, step: Step) -> None:
        """A statistic-free step, composed lazily after any pending ones."""
        if name in self.chains:
            self.chains[name].append(step)
        else:
            c, dt = self.cols[name]
            self.cols[name] = step(c, dt, {})

    def map_with_stats(self, name: str, request: Callable[[Column, T.DataType, str], None],
                       step: Step, on_input: bool = False) -> None:
        """A step needing statistics of the column.

        ``request`` registers what to compute (via ``add_agg`` etc.) on the
        column expression.  With ``on_input`` the statistics are taken on the
        expression before the column's pending steps (valid when those steps
        cannot change the answer); otherwise pending steps are resolved first.
        """
        if name in self.chains and not on_input:
            self.flush()
        c, dt = self.cols[name]
        key = self.new_key()
        request(c, dt, key)
        wrapped = lambda col, t, stats, _k=key, _s=step: _s(col, t, {"key": _k, **stats})
        self.chains.setdefault(name, []).append(wrapped)

    def add_agg(self, agg: Column) -> None:
        self.aggs.append(agg)

    def add_median(self, key: str, col: Column) -> None:
        self.medians[key] = col

    def add_mode(self, key: str, col: Column, dt: T.DataType) -> None:
        self.modes[key] = (col, dt)

    def flush(self) -> None:
        """Answer every pending statistic, then resolve pending steps."""
        if not self.chains:
            return
        stats: dict = {}
        # medians and modes only fill gaps, so columns without any need none
        gaps = [F.count_if(c.isNull()).alias(f"{key}_gaps")
                for key, c in [*self.medians.items(), *((k, c) for k, (c, _) in self.modes.items())]]
        if self.aggs or gaps:
            row = self.base.agg(*self.aggs, *gaps).first()
            stats.update(row.asDict())
            self.jobs += 1
        wanted = {k: c for k, c in self.medians.items() if stats[f"{k}_gaps"]}
        if wanted:
            stats.update(exact_medians(self.base, wanted))
            self.jobs += 1
        asked = {k: v for k, v in self.modes.items() if stats[f"{k}_gaps"]}
        if asked:
            stats.update(modes(self.base, asked))
            self.jobs += 1
        for name, chain in self.chains.items():
            c, dt = self.cols[name]
            for step in chain:
                c, dt = step(c, dt, stats)
            self.cols[name] = (c, dt)
        self.chains, self.aggs, self.medians, self.modes = {}, [], {}, {}

    # -- rows ---------------------------------------------------------------
    def frame(self) -> DataFrame:
        """The current table as a DataFrame (``_row_order`` kept last)."""
        self.flush()
        out = [c.alias(n) for n, (c, _) in self.cols.items()]
        if ROW_ORDER in self.base.columns:
            out.append(F.col(ROW_ORDER))
        return self.base.select(*out)

    def replace_rows(self, fn: Callable[[DataFrame], DataFrame]) -> None:
        """Apply a row-removing operation; later statistics see its result."""
        self._reset(fn(self.frame()))
