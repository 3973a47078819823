"""Run-log queries (L1-L5) as columns over a run-log DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Status spellings per class, and the default reason.
FAILED = ["failed", "error"]
SUCCESS = ["success", "completed"]
IN_PROGRESS = ["in_progress", "started", "running"]
NO_REASON = "No rationale captured"


def status_class(status: Column, action: Column) -> Column:
    """L1: is-failed / is-success / is-progress / is-neutral."""
    s = F.lower(F.trim(F.coalesce(status, F.lit(""))))
    a = F.lower(F.trim(F.coalesce(action, F.lit(""))))
    return (F.when(s.isin(FAILED) | a.contains("failed") | a.contains("error"), F.lit("is-failed"))
            .when(s.isin(SUCCESS), F.lit("is-success"))
            .when(s.isin(IN_PROGRESS), F.lit("is-progress"))
            .otherwise(F.lit("is-neutral")))


def reason(details: Column) -> Column:
    """L2: rationale -> decision_basis -> detail -> default (blank counts as missing)."""
    pick = [F.nullif(details.getItem(k), F.lit("")) for k in ("rationale", "decision_basis", "detail")]
    return F.coalesce(*pick, F.lit(NO_REASON))


def clock_text(timestamp: Column) -> Column:
    """HH:MM:SS out of an ISO timestamp text, or --:--:-- when too short."""
    ts = F.coalesce(timestamp, F.lit(""))
    return F.when(F.length(ts) >= 19, F.substring(ts, 12, 8)).otherwise(F.lit("--:--:--"))


def annotate(log: DataFrame) -> DataFrame:
    """Run-log rows with status class, reason and clock text."""
    return log.select("*", status_class(F.col("status"), F.col("action")).alias("status_class"),
                      reason(F.col("details")).alias("reason"), clock_text(F.col("timestamp")).alias("clock"))


def history(log: DataFrame) -> DataFrame:
    """L3: latest first (a range-partitioned global sort)."""
    return log.orderBy(F.col("timestamp").desc())


def latest_per_run(log: DataFrame) -> DataFrame:
    """L3: the newest event of each run, as a grouped max (combined map-side,
    so one very long run does not end up whole in one task).  Events of one
    time are ordered by their other columns, so the choice is always the same."""
    other = [f for f in log.schema.fields if f.name not in ("run_id", "timestamp")]
    order = F.struct("timestamp", *[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, T.MapType) else F.col(f.name)
                                    for f in other])
    best = F.max_by(F.struct("timestamp", *[F.col(f.name) for f in other]), order).alias("__e")
    return log.groupBy("run_id").agg(best).select("run_id", "__e.*")


def step_durations(traces: DataFrame) -> DataFrame:
    """L4: duration (3 decimals) and status per agent and run."""
    return traces.select("agent", "run_id", F.round("duration_seconds", 3).alias("duration_seconds"), "status")
