"""Bronze layer (B1-B10): rename, cast and lineage, never dropping rows or columns.

Each table becomes one ``select`` over its source; the only extra job is one
aggregate when an integer cast needs its whole-number guard or a date cast
needs its column-wide format choice.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesmith.functions import casts, dates, vocab
from lakesmith.operators.rules import collect_rules
from lakesmith.operators.staging import Stage
from lakesmith.sources.tables import ROW_ORDER


def rules_for_table(rules: list[dict], name: str) -> list[dict]:
    """B1: rules whose source table is blank or names this table."""
    names = {"", name, f"{name}.csv", f"{name}.parquet"}
    return [r for r in rules if r["source_table"].strip() in names]


def integer_step(stage: Stage, name: str, on_input: bool = False) -> None:
    """Cast to integer unless the column holds a fraction (then unchanged, Q3)."""
    if casts.kind_of(stage.dtype(name)) == "integer" and name not in stage.chains:
        stage.map(name, lambda c, dt, _: (c.cast("long"), T.LongType()))  # whole numbers already
        return

    def request(c, dt, key):
        stage.add_agg(casts.fraction_count(c, dt).alias(f"{key}_frac"))

    def step(c, dt, stats):
        if stats.get(f"{stats['key']}_frac"):
            return c, dt
        return casts.to_long(c, dt), T.LongType()
    stage.map_with_stats(name, request, step, on_input)


def wide_step(stage: Stage, name: str, on_input: bool = False) -> None:
    """Cast to whole numbers of up to 38 digits unless the column holds others (then unchanged)."""
    if casts.kind_of(stage.dtype(name)) in ("integer", "wide") and name not in stage.chains:
        stage.map(name, lambda c, dt, _: (casts.to_wide(c, dt), casts.WIDE))
        return

    def request(c, dt, key):
        stage.add_agg(casts.wide_misfits(c, dt).alias(f"{key}_misfits"))

    def step(c, dt, stats):
        if stats.get(f"{stats['key']}_misfits"):
            return c, dt
        return casts.to_wide(c, dt), casts.WIDE
    stage.map_with_stats(name, request, step, on_input)


def date_step(stage: Stage, name: str, on_input: bool = False) -> None:
    """Column-wide date format choice, then parse."""
    if not dates.needs_format_choice(stage.dtype(name)):
        stage.map(name, lambda c, dt, _: (dates.parse_dates(c, dt, None), dates.parsed_type(dt)))
        return

    def request(c, dt, key):
        stage.add_agg(dates.first_format_agg(c, f"{key}_format"))

    def step(c, dt, stats):
        return dates.parse_dates(c, dt, stats.get(f"{stats['key']}_format")), dates.parsed_type(dt)
    stage.map_with_stats(name, request, step, on_input)


def float_step(stage: Stage, name: str) -> None:
    stage.map(name, lambda c, dt, _: (casts.to_double(c, dt), T.DoubleType()))


def text_step(stage: Stage, name: str, integral_as_int: bool = False) -> None:
    stage.map(name, lambda c, dt, _: (casts.to_text(c, dt, integral_as_int), T.StringType()))


def _source_path(df: DataFrame, name: str):
    if ROW_ORDER in df.columns:
        return F.col(f"{ROW_ORDER}.file")
    return F.lit(name)


def bronze_table(df: DataFrame, name: str, rules: list[dict], load_time: str) -> DataFrame:
    stage = Stage(df)
    source = _source_path(df, name)
    for rule in rules_for_table(rules, name):
        src, tgt = rule["source_column"].strip(), rule["target_column"].strip()
        logic = rule["transformation_logic"].lower()
        if tgt and tgt.lower() in vocab.LOAD_TIME_TARGETS:
            stage.set(tgt, F.lit(load_time), T.StringType())
            continue
        if tgt and tgt.lower() in vocab.SOURCE_FILE_TARGETS:
            stage.set(tgt, source, T.StringType())
            continue
        if src and tgt and stage.has(src) and src != tgt:
            stage.rename(src, tgt)
        work = tgt if stage.has(tgt) else src
        if not stage.has(work):
            continue
        kind = vocab.bronze_cast(logic)
        if kind == "text":
            text_step(stage, work)
        elif kind == "integer":
            integer_step(stage, work)
        elif kind == "wide":
            wide_step(stage, work)
        elif kind == "float":
            float_step(stage, work)
        elif kind == "date":
            date_step(stage, work)
    names = set(stage.names())
    if not names & vocab.LOAD_TIME_TARGETS:
        stage.set("_load_timestamp", F.lit(load_time), T.StringType())
    if not names & vocab.SOURCE_FILE_TARGETS:
        stage.set("_source_file", source, T.StringType())
    return stage.frame()


def execute_bronze(sources: Mapping[str, DataFrame], rules: DataFrame,
                   load_time: str | None = None) -> dict[str, DataFrame]:
    """Every source table -> ``<name>_bronze`` (lazy DataFrames)."""
    load_time = load_time or datetime.now(timezone.utc).isoformat()
    rule_rows = collect_rules(rules)
    return {f"{name}_bronze": bronze_table(df, name, rule_rows, load_time) for name, df in sources.items()}
