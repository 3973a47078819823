"""Run-log and trace sources/sinks.

Events are produced on the driver (a handful per phase) and appended as
JSON partitioned by ``run_id``, so reading one run prunes to its folder.
"""

from __future__ import annotations

import time
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUNLOG_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("agent", T.StringType()),
    T.StructField("action", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("phase", T.StringType()),
    T.StructField("details", T.MapType(T.StringType(), T.StringType())),
    T.StructField("run_id", T.StringType()),
])

TRACE_SCHEMA = T.StructType([
    T.StructField("agent", T.StringType()),
    T.StructField("started_at", T.StringType()),
    T.StructField("input", T.MapType(T.StringType(), T.StringType())),
    T.StructField("plan", T.StringType()),
    T.StructField("steps", T.ArrayType(T.StringType())),
    T.StructField("output", T.MapType(T.StringType(), T.StringType())),
    T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("run_id", T.StringType()),
])


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


class RunLog:
    """Append-only run log (S6) with a per-run reader."""

    def __init__(self, spark: SparkSession, root: str, run_id: str):
        self.spark, self.root, self.run_id = spark, root, run_id
        self._pending: list[tuple] = []

    def log(self, agent: str, action: str, status: str | None = None, phase: str | None = None, **details) -> None:
        det = {k: str(v) for k, v in details.items()}
        self._pending.append((_now(), agent, action, status, phase, det, self.run_id))

    def flush(self) -> None:
        if not self._pending:
            return
        df = self.spark.createDataFrame(self._pending, RUNLOG_SCHEMA)
        df.coalesce(1).write.mode("append").partitionBy("run_id").json(self.root)
        self._pending = []

    def read(self, run_id: str | None = None) -> DataFrame:
        return read_runlog(self.spark, self.root, run_id or self.run_id)


def _read_json(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """JSON rows below ``root``; a folder that does not exist holds none.  Any
    other failure is raised: it is not the same as an empty log."""
    try:
        return spark.read.schema(schema).json(root)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_runlog(spark: SparkSession, root: str, run_id: str | None = None) -> DataFrame:
    """Events of one run (or all); a missing log reads as empty."""
    df = _read_json(spark, root, RUNLOG_SCHEMA)
    return df.where(F.col("run_id") == run_id) if run_id else df


class Trace:
    """Per-agent trace (S8): input, plan, steps, output, duration and status."""

    def __init__(self, agent: str, run_id: str):
        self.agent, self.run_id = agent, run_id
        self.started = time.time()
        self.record = {"agent": agent, "started_at": _now(), "input": {}, "plan": "", "steps": [],
                       "output": {}, "duration_seconds": 0.0, "status": "started", "error": None,
                       "run_id": run_id}

    def set_input(self, **kw) -> "Trace":
        self.record["input"] = {k: str(v) for k, v in kw.items()}
        return self

    def set_plan(self, plan: str) -> "Trace":
        self.record["plan"] = plan
        return self

    def step(self, text: str) -> "Trace":
        self.record["steps"].append(text)
        return self

    def set_output(self, **kw) -> "Trace":
        self.record["output"] = {k: str(v) for k, v in kw.items()}
        return self

    def complete(self, status: str = "success", error: str | None = None) -> dict:
        self.record["duration_seconds"] = round(time.time() - self.started, 3)
        self.record["status"] = status
        self.record["error"] = error
        return self.record


def write_traces(spark: SparkSession, traces: list[dict], root: str) -> None:
    if not traces:
        return
    rows = [tuple(t.get(f.name) for f in TRACE_SCHEMA.fields) for t in traces]
    spark.createDataFrame(rows, TRACE_SCHEMA).coalesce(1).write.mode("append").partitionBy("run_id").json(root)


def read_traces(spark: SparkSession, root: str) -> DataFrame:
    return _read_json(spark, root, TRACE_SCHEMA)
