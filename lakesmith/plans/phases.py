"""The four phases and the end-to-end run.

Each phase is a plain function over lazy DataFrames.  With ``root`` given,
every layer is written (run-scoped) and read back before the next phase,
which both cuts lineage and records row counts for the run log; without it
the layers stay lazy plans (used by the query catalog and tests).

Rule tables may be reviewed between phases: pass a ``decisions`` table per
layer (``rule_no``, ``selected`` and edited cells), see ``rules.approve``.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.errors.exceptions.captured import CapturedException as SparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesmith.functions import vocab
from lakesmith.operators import bronze, docs, gold, profile, question, rules, silver
from lakesmith.sources.csv import read_csv_table
from lakesmith.sources.runlog import RunLog, Trace, write_traces
from lakesmith.sources.tables import ROW_ORDER, read_layer, read_table, table_name, write_layer


@dataclass
class RunState:
    run_id: str
    question: str
    sources: dict[str, DataFrame]
    profile: DataFrame | None = None
    bronze_rules: DataFrame | None = None
    silver_rules: DataFrame | None = None
    gold_rules: DataFrame | None = None
    bronze: Mapping[str, DataFrame] = field(default_factory=dict)
    silver: Mapping[str, DataFrame] = field(default_factory=dict)
    gold: Mapping[str, DataFrame] = field(default_factory=dict)
    result: DataFrame | None = None
    answer: dict | None = None
    paths: dict[str, dict[str, str]] = field(default_factory=dict)
    shapes: dict[str, dict[str, int]] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)
    analysis: dict[str, DataFrame] = field(default_factory=dict)
    traces: list[dict] = field(default_factory=list)


@dataclass(frozen=True)
class CsvSource:
    """A CSV file or folder; see ``csv.read_raw_csv`` for ``multi_line``."""
    path: str
    multi_line: bool | str = "auto"
    schema: Mapping[str, str] | None = None

    def read(self, spark: SparkSession) -> DataFrame:
        return read_csv_table(spark, self.path, dict(self.schema) if self.schema else None, self.multi_line)


def load_sources(spark: SparkSession, sources, log: RunLog | None = None) -> dict[str, DataFrame]:
    """Tables by name from DataFrames, ``CsvSource``s, or paths: ``*.csv`` is
    CSV, anything else Parquet.  A source that cannot be read is reported and
    left out; without ``log`` it raises."""
    if not isinstance(sources, Mapping):
        sources = {table_name(s.path if isinstance(s, CsvSource) else s): s for s in sources}
    out = {}
    for name, src in sources.items():
        try:
            if isinstance(src, DataFrame):
                out[name] = src
            elif isinstance(src, CsvSource):
                out[name] = src.read(spark)
            else:
                out[name] = CsvSource(str(src)).read(spark) if str(src).endswith(".csv") else read_table(spark, src)
        except (AnalysisException, SparkException, Py4JJavaError) as e:
            if log is None:
                raise
            log.log("profiler", "source_skipped", status="failed", phase="profile", table=name, detail=str(e).split("\n")[0])
    return out


def _stem(name: str) -> str:
    return name.removesuffix("_bronze").removesuffix("_silver")


def _width(fields) -> int:
    return len([f for f in fields if f.name != ROW_ORDER])


def _materialise(spark, state: RunState, layer: str, tables: Mapping[str, DataFrame], inputs: Mapping[str, DataFrame],
                 root: str | None, log: RunLog | None) -> Mapping[str, DataFrame]:
    """Write a layer and read it back; log what went in and came out of each table.

    No row is counted for the log alone: the writes observe what they write,
    and what goes in is what the layer before wrote (or the profile counted).
    """
    if root is None:
        return tables
    paths, rows_out = write_layer(tables, root, state.run_id, layer)
    state.paths[layer] = paths
    back = read_layer(spark, paths, ordered=layer != "gold")
    before = {_stem(n): (state.rows[n], _width(inputs[n].schema.fields)) for n in inputs}
    for name, df in back.items():
        # a Gold table is fed by all Silver tables
        feeding = [before[_stem(name)]] if _stem(name) in before else list(before.values())
        rows, rows_in = rows_out[name], sum(r for r, _ in feeding)
        state.shapes[name] = {"rows_in": rows_in, "rows_out": rows, "columns_in": sum(c for _, c in feeding),
                              "columns_out": _width(df.schema.fields)}
        if log is not None:
            change = {"rows_removed": rows_in - rows} if layer == "silver" else {"fan_out": round(rows / rows_in, 4) if rows_in else 0} \
                if layer == "gold" else {}
            log.log(f"{layer}_agent", "table_written", status="success", phase=layer, table=name, path=paths[name],
                    **state.shapes[name], **change)
    state.rows.update(rows_out)
    return back


def report_rules(layer: str, approved: DataFrame, log: RunLog | None) -> list[dict]:
    """Rules whose text the layer does not know: they change nothing, and say so in the log."""
    unknown = [r for r in rules.collect_rules(approved)
               if vocab.rule_status(layer, r["target_column"].strip(), r["transformation_logic"].lower()) == "unrecognised"]
    if log is not None:
        for r in unknown:
            log.log(f"{layer}_agent", "rule_unrecognised", status="skipped", phase=layer, table=r["source_table"],
                    column=r["target_column"], detail=r["transformation_logic"])
    return unknown


@contextmanager
def _traced(state: RunState, agent: str, plan: str, **given):
    """Collect a trace of one phase; a failure is recorded and raised."""
    trace = Trace(agent, state.run_id).set_input(**given).set_plan(plan)
    try:
        yield trace
    except Exception as e:
        state.traces.append(trace.complete("failed", str(e).split("\n")[0]))
        raise
    state.traces.append(trace.complete())


def phase_profile(spark: SparkSession, state: RunState, root: str | None = None) -> RunState:
    """Profile -> Bronze rules.

    The rules depend on column names and types only, so they come from the
    schema part of the profile.  With ``root`` the statistics are computed and
    written, and with them the labels, join keys and notes they lead to.
    """
    with _traced(state, "profiler", "profile, analyse, generate Bronze rules", tables=sorted(state.sources)) as trace:
        if root is not None:
            state.profile = profile.profile_tables(state.sources)
            profile.write_profile(state.profile, f"{root}/profiles/{state.run_id}")
            state.rows = dict.fromkeys(state.sources, 0) | {r["dataset"]: r["rows"] for r in
                                                            state.profile.select("dataset", "rows").distinct().collect()}
            state.analysis = {"semantic_labels": profile.semantic_labels(state.profile),
                              "join_keys": profile.join_keys(state.profile).drop("ln", "rn"),
                              "quality_notes": profile.quality_notes(state.profile)}
            for name, df in state.analysis.items():
                profile.write_profile(df, f"{root}/analysis/{state.run_id}/{name}")
                trace.step(f"wrote {name}")
        state.bronze_rules = rules.bronze_rules(profile.schema_profile(state.sources))
    return state


def phase_bronze(spark, state: RunState, decisions=None, root=None, log=None) -> RunState:
    """Bronze -> Silver rules."""
    with _traced(state, "bronze_agent", "rename, cast, add lineage", tables=sorted(state.sources)) as trace:
        approved = rules.approve(state.bronze_rules, decisions)
        trace.step(f"{len(report_rules('bronze', approved, log))} unrecognised rules")
        made = bronze.execute_bronze(state.sources, approved)
        state.bronze = _materialise(spark, state, "bronze", made, state.sources, root, log)
        state.silver_rules = rules.silver_rules(spark, state.bronze)
        trace.set_output(tables=sorted(state.bronze))
    return state


def phase_silver(spark, state: RunState, decisions=None, root=None, log=None) -> RunState:
    """Silver -> Gold rules."""
    with _traced(state, "silver_agent", "clean by ordered rules", tables=sorted(state.bronze)) as trace:
        approved = rules.approve(state.silver_rules, decisions)
        trace.step(f"{len(report_rules('silver', approved, log))} unrecognised rules")
        made = silver.execute_silver(state.bronze, approved)
        state.silver = _materialise(spark, state, "silver", made, state.bronze, root, log)
        state.gold_rules = rules.gold_rules(spark, state.silver)
        trace.set_output(tables=sorted(state.silver))
    return state


def phase_gold(spark, state: RunState, decisions=None, root=None, log=None, k: int = 10) -> RunState:
    """Gold -> answer."""
    with _traced(state, "gold_agent", "join, aggregate, answer", tables=sorted(state.silver)) as trace:
        approved = rules.approve(state.gold_rules, decisions)
        trace.step(f"{len(report_rules('gold', approved, log))} unrecognised rules")
        made = gold.execute_gold(state.silver, approved)
        state.gold = _materialise(spark, state, "gold", made, state.silver, root, log)
        state.result, state.answer = question.answer(state.gold, state.question, k, log)
        trace.set_output(tables=sorted(state.gold), answer=state.answer["answer"])
        if root is not None:
            question.write_answer(spark, state.answer, f"{root}/answers/{state.run_id}")
            _remember(spark, state, root)
    return state


def _remember(spark: SparkSession, state: RunState, root: str) -> None:
    """K1: the question and its answer as documents of the run's store."""
    rows = [(f"{state.run_id}-question", state.question, "intent", 0), (f"{state.run_id}-answer", state.answer["answer"], "report", 1)]
    made = spark.createDataFrame(rows, "doc_id string, text string, kind string, no long")
    made = made.withColumn(ROW_ORDER, F.struct(F.lit("").alias("file"), F.col("no").alias("pos")))
    docs.as_store(made, "doc_id", "text", ["kind"]).coalesce(1).write.mode("overwrite").parquet(f"{root}/documents/{state.run_id}")


def run(spark: SparkSession, sources, question_text: str, decisions: Mapping[str, DataFrame] | None = None,
        root: str | None = None, run_id: str | None = None) -> RunState:
    """E5: sources + question -> every layer and the answer.  With ``root`` the
    layers, profile, analysis, answer, run log and traces are written below it."""
    decisions = decisions or {}
    run_id = run_id or str(uuid.uuid4())
    log = RunLog(spark, f"{root}/runlog", run_id) if root is not None else None
    if log is not None:
        log.log("orchestrator", "pipeline_started", status="started", phase="upload", intent=question_text)
    state = RunState(run_id, question_text, load_sources(spark, sources, log))
    try:
        phase_profile(spark, state, root)
        phase_bronze(spark, state, decisions.get("bronze"), root, log)
        phase_silver(spark, state, decisions.get("silver"), root, log)
        phase_gold(spark, state, decisions.get("gold"), root, log)
    except Exception as e:
        if log is not None:
            log.log("orchestrator", "pipeline_failed", status="failed", phase="report", detail=str(e).split("\n")[0])
        raise
    else:
        if log is not None:
            log.log("orchestrator", "pipeline_completed", status="completed", phase="report")
    finally:
        if log is not None:
            log.flush()
            write_traces(spark, state.traces, f"{root}/traces")
    return state
