"""Silver layer (V1-V18): cleansing by ordered rules.

Per rule the order is rename -> dedup (ends the rule) -> null handling ->
type -> case -> strip.  Statistics are batched by ``Stage``; row removal
(dedup, drop null) starts a new stage.  Keep-first dedup takes the first row of
each key in row order; Spark limits every task to its own first row of a key
before the one shuffle, so a very frequent key is one row a task by then.

Tables come as a ``Layer``: they are numbered when asked for by name, and not
at all by consumers that need no key.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesmith.functions import casts, text, vocab
from lakesmith.functions.casts import kind_of
from lakesmith.operators.bronze import date_step, float_step, integer_step, rules_for_table, text_step, wide_step
from lakesmith.operators.keys import number_in_row_order
from lakesmith.operators.layers import Layer, Table
from lakesmith.operators.profile import ID_PATTERN
from lakesmith.operators.rules import collect_rules
from lakesmith.operators.staging import Stage
from lakesmith.sources.tables import ROW_ORDER, with_row_order


def keep_first(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop duplicate rows (on ``subset`` or the whole row), keeping the first.

    Nulls compare equal, as in a plain drop-duplicates.
    """
    df = with_row_order(df)
    types = {f.name: f.dataType for f in df.schema.fields}
    keys = [_comparable(F.col(f"`{k}`"), types[k]) for k in subset or [c for c in df.columns if c != ROW_ORDER]]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(ROW_ORDER))
    return df.select("*", place.alias("__place")).where("__place <= 1").drop("__place")


def _comparable(c: Column, dt: T.DataType) -> Column:
    """A column as a grouping key; a map by its sorted entries."""
    return F.array_sort(F.map_entries(c)) if isinstance(dt, T.MapType) else c


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN counts as missing, like null."""
    return df.withColumns({f.name: F.nanvl(F.col(f"`{f.name}`"), F.lit(None).cast(f.dataType)) for f in df.schema.fields
                           if isinstance(f.dataType, (T.DoubleType, T.FloatType))})


def _fill_value_step(how: str):
    def step(c, dt, stats):
        v = stats.get(f"{stats['key']}_v")
        if v is None:
            return c, dt
        k = kind_of(dt)
        if how == "mode":
            fill = F.lit(v) if k == "text" else F.lit(v).cast(dt)
            return F.coalesce(c, fill), dt
        v = float(v)
        if k == "integer":
            if v.is_integer():
                return F.coalesce(c, F.lit(int(v)).cast(dt)), dt
            return F.coalesce(c.cast("double"), F.lit(v)), T.DoubleType()  # promote (Q4)
        if k == "wide":  # the nearest whole number: the column keeps its digits
            return F.coalesce(c, F.lit(Decimal(round(v))).cast(dt)), dt
        if k == "float":
            return F.coalesce(c, F.lit(v).cast(dt)), dt
        if k == "text":
            return F.coalesce(c, F.lit(repr(v))), dt
        return c, dt
    return step


def fill_nulls(stage: Stage, name: str, how: str) -> None:
    """V5-V8: mean / median / mode / blank fill of missing values."""
    if how == "blank":
        stage.map(name, lambda c, dt, _: ((F.coalesce(c, F.lit("")), dt) if kind_of(dt) == "text" else (c, dt)))
        return

    def request(c, dt, key):
        if how == "mean":
            stage.add_agg(F.avg(casts.to_double(c, dt)).alias(f"{key}_v"))
        elif how == "median":
            stage.add_median(f"{key}_v", casts.to_double(c, dt))
        else:
            stage.add_mode(f"{key}_v", c, dt)
    stage.map_with_stats(name, request, _fill_value_step(how))


def _not_missing(name: str, dt: T.DataType):
    c = F.col(f"`{name}`")
    return c.isNotNull() & ~F.isnan(c) if kind_of(dt) == "float" else c.isNotNull()


def silver_table(df: DataFrame, name: str, rules: list[dict]) -> Table:
    id_re = re.compile(ID_PATTERN)
    stage = Stage(nan_to_null(with_row_order(df)))
    table_rules = rules_for_table(rules, name)
    for rule in table_rules:
        src, tgt = rule["source_column"].strip(), rule["target_column"].strip()
        ops = vocab.silver_ops(rule["transformation_logic"].lower())
        if src and tgt and stage.has(src) and src != tgt:
            stage.rename(src, tgt)
        work = tgt if stage.has(tgt) else src
        if ops.dedup:
            subset = [work] if stage.has(work) else None
            stage.replace_rows(lambda d, s=subset: keep_first(d, s))
            continue
        if not stage.has(work):
            continue
        if ops.nulls == "drop":
            dt = stage.dtype(work)
            stage.replace_rows(lambda d, w=work, t=dt: d.where(_not_missing(w, t)))
        elif ops.nulls:
            fill_nulls(stage, work, ops.nulls)
        # a mode or blank fill only copies existing values, so the date format
        # choice can be read from the unfilled column in the same pass
        same_values = ops.nulls in (None, "drop", "mode", "blank")
        if ops.cast == "date":
            date_step(stage, work, on_input=same_values)
        elif ops.cast == "integer":
            integer_step(stage, work)
        elif ops.cast == "wide":
            wide_step(stage, work)
        elif ops.cast == "float":
            float_step(stage, work)
        elif ops.cast == "text":
            text_step(stage, work, integral_as_int=bool(id_re.search(work.lower())))
        if ops.case:
            fn = {"lower": text.lower, "upper": text.upper, "title": text.title_case}[ops.case]
            stage.map(work, lambda c, dt, _, f=fn: (f(casts.to_text(c, dt)), T.StringType()))
        if ops.strip:
            stage.map(work, lambda c, dt, _: (text.strip_ws(casts.to_text(c, dt)), T.StringType()))
    out = stage.frame()
    pk = next((r["target_column"].strip() for r in table_rules
               if r["target_column"].strip().startswith("pk_") and r["target_column"].strip() not in out.columns
               and not (r["source_column"].strip() and r["source_column"].strip() in out.columns)), None)
    pk = pk or f"pk_{name}_silver_id"
    approved = {r["target_column"].strip() for r in table_rules}
    keep = [c for c in out.columns if c != pk and (c in approved or c.startswith("_") or c.startswith("pk_"))]
    if pk in out.columns:
        return Table.keyed(lambda: out.select(*[F.col(f"`{c}`") for c in [pk] + keep]))
    return Table(pk, lambda: out.select(*[F.col(f"`{c}`") for c in keep]), lambda: number_in_row_order(out, pk, keep))


def execute_silver(bronze: Mapping[str, DataFrame], rules: DataFrame) -> Layer:
    """Every Bronze table -> ``<stem>_silver``."""
    rule_rows = collect_rules(rules)
    out = Layer()
    for name, df in bronze.items():
        stem = name[: -len("_bronze")] if name.endswith("_bronze") else name
        out.add(f"{stem}_silver", silver_table(df, name, rule_rows))
    return out
