"""Mapping-rule tables.

A rule table is a DataFrame of eight text columns plus ``rule_no`` (rules
run in that order).  Bronze rules are computed from the profile table,
Silver and Gold rules from layer schemas only (no data scan).  Rule tables
are as small as the set of columns, so executors read them on the driver.
"""

from __future__ import annotations

import re
import weakref
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesmith.functions.casts import kind_of
from lakesmith.operators.layers import fields_of
from lakesmith.operators.profile import DATE_PATTERN, ID_PATTERN
from lakesmith.sources.tables import ROW_ORDER

RULE_COLUMNS = ["source_schema", "source_table", "source_column", "target_schema", "target_table",
                "target_column", "transformation_type", "transformation_logic"]
RULE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RULE_COLUMNS]
                           + [T.StructField("rule_no", T.LongType())])

# Rule texts written by the generators.
BRONZE_INT = "Convert to integer whole number"
BRONZE_WIDE = "Convert to wide whole number, every digit kept"
BRONZE_FLOAT = "Convert to float decimal numeric"
BRONZE_DATE = "Convert to date format"
BRONZE_TEXT = "Convert to text format"
LOAD_TIME_TEXT = "Current UTC timestamp injected at load time"
SOURCE_FILE_TEXT = "Source file path injected at load time"
PK_TEXT = "Auto-generated sequential surrogate primary key starting from 1"
SILVER_ID = "Cast to text/string type; no null handling (identifier column)"
SILVER_DATE = "Fill null with mode then standardise date format to YYYY-MM-DD"
SILVER_WIDE = "Cast to wide whole number; no null handling, every digit kept"
SILVER_NUMERIC = "Fill null values with mean; cast to numeric type"
SILVER_TEXT = "Fill null values with mode; strip whitespace and standardise text format"
DEDUP_TEXT = "Deduplicate rows based on {}"
GOLD_TABLE = "gold_output"
GOLD_PK = "pk_gold_id"

_ID_RE = re.compile(ID_PATTERN)
_DATE_RE = re.compile(DATE_PATTERN)


# Rule tables built here keep their rows next to the DataFrame, so reading
# them back (selection, review, execution) needs no Spark job.
_ROWS: "weakref.WeakKeyDictionary[DataFrame, list[dict]]" = weakref.WeakKeyDictionary()


def rule_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """A rule table from ``RULE_SCHEMA`` tuples."""
    df = spark.createDataFrame(rows, RULE_SCHEMA)
    names = RULE_COLUMNS + ["rule_no"]
    _ROWS[df] = sorted((dict(zip(names, r)) for r in rows), key=lambda r: r["rule_no"])
    return df


def _rule(source_table="", source_column="", target_table="", target_column="",
          ttype="Indirect", logic="", rule_no=0) -> tuple:
    return ("", source_table, source_column, "", target_table, target_column, ttype, logic, rule_no)


def bronze_logic(kind: str, column: str) -> str:
    """G1: the Bronze cast rule for one column."""
    if kind == "integer":
        return BRONZE_INT
    if kind == "wide":
        return BRONZE_WIDE
    if kind == "float":
        return BRONZE_FLOAT
    return BRONZE_DATE if _DATE_RE.search(column.lower()) else BRONZE_TEXT


def bronze_rules(profile: DataFrame) -> DataFrame:
    """G1 + G2: one cast rule per profiled column, two lineage rules per dataset.

    The profile has one row per column; the rules are built from its rows.
    """
    columns: dict[str, list] = {}
    for p in profile.orderBy("dataset_no", "ordinal").collect():
        columns.setdefault(p["dataset"], []).append(p)
    rows: list[tuple] = []
    for name, own in columns.items():  # numbered in order, whatever the number of columns
        rows += [_rule(name, p["column_name"], name, p["column_name"], logic=bronze_logic(p["kind"], p["column_name"]),
                       rule_no=len(rows) + i) for i, p in enumerate(own)]
        rows += [_rule(name, "", name, target, logic=text, rule_no=len(rows) + i) for i, (target, text) in enumerate(
            (("_load_timestamp", LOAD_TIME_TEXT), ("_source_file", SOURCE_FILE_TEXT)))]
    return rule_table(profile.sparkSession, rows)


def _schema_of(tables: Mapping[str, DataFrame], name: str) -> list[tuple[str, T.DataType]]:
    return [(f.name, f.dataType) for f in fields_of(tables, name) if f.name != ROW_ORDER]


def silver_rules(spark: SparkSession, bronze: Mapping[str, DataFrame]) -> DataFrame:
    """G3-G5 from Bronze schemas: key rule first, column rules, dedup rule last."""
    rows, n = [], 0
    for name in bronze:
        target = name[: -len("_bronze")] if name.endswith("_bronze") else name
        schema = _schema_of(bronze, name)
        rows.append(_rule(name, "", target, f"pk_{target}_silver_id", logic=PK_TEXT, rule_no=n))
        n += 1
        for col, dt in schema:
            if col.startswith("_"):
                continue
            low = col.lower()
            if _ID_RE.search(low):
                logic = SILVER_ID
            elif _DATE_RE.search(low):
                logic = SILVER_DATE
            elif kind_of(dt) == "wide":
                logic = SILVER_WIDE
            elif kind_of(dt) in ("integer", "float"):
                logic = SILVER_NUMERIC
            else:
                logic = SILVER_TEXT
            rows.append(_rule(name, col, target, col, logic=logic, rule_no=n))
            n += 1
        key = next((c for c, _ in schema if _ID_RE.search(c.lower())), None)
        if key:
            rows.append(_rule(name, key, target, key, logic=DEDUP_TEXT.format(key), rule_no=n))
            n += 1
    return rule_table(spark, rows)


def gold_rules(spark: SparkSession, silver: Mapping[str, DataFrame]) -> DataFrame:
    """Key rule plus a passthrough of every Silver column into one table."""
    rows = [_rule("", "", GOLD_TABLE, GOLD_PK, logic=PK_TEXT, rule_no=0)]
    for name in silver:
        stem = name[: -len("_silver")] if name.endswith("_silver") else name
        for col, _ in _schema_of(silver, name):
            rows.append(_rule(stem, col, GOLD_TABLE, col, "Direct", "Passthrough", len(rows)))
    return rule_table(spark, rows)


def approve(rules: DataFrame, decisions: DataFrame | None) -> DataFrame:
    """Keep selected rules (default: all) and apply edited cells.

    ``decisions`` has ``rule_no`` and optional ``selected`` (boolean) and
    edited text columns named like the rule columns (null: unchanged).
    Both tables are rule-sized.  An empty result is an error.
    """
    current = collect_rules(rules)
    if decisions is not None:
        edits = {r["rule_no"]: r.asDict() for r in decisions.collect()}
        kept = []
        for rule in current:
            d = edits.get(rule["rule_no"], {})
            if d.get("selected") is False:
                continue
            kept.append({c: (d[c] if d.get(c) is not None else rule[c]) for c in RULE_COLUMNS}
                        | {"rule_no": rule["rule_no"]})
        current = kept
    if not current:
        raise ValueError("no rule selected: approve at least one rule")
    return rule_table(rules.sparkSession, [tuple(r[c] for c in RULE_COLUMNS) + (r["rule_no"],) for r in current])


def normalize(rules: DataFrame) -> DataFrame:
    """Accept shorter rule tables: absent columns read as blank, nulls as blank."""
    cols = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in rules.columns
            else F.lit("").alias(c) for c in RULE_COLUMNS]
    if "rule_no" in rules.columns:
        order = F.col("rule_no").cast("long")
    elif ROW_ORDER in rules.columns:
        order = F.row_number().over(Window.orderBy(ROW_ORDER)).cast("long")  # rule tables are tiny
    else:
        order = F.monotonically_increasing_id()
    return rules.select(*cols, order.alias("rule_no"))


def collect_rules(rules: DataFrame) -> list[dict]:
    """Rule rows in execution order (rule tables are schema-sized)."""
    known = _ROWS.get(rules)
    if known is not None:
        return [dict(r) for r in known]
    return sorted((r.asDict() for r in normalize(rules).collect()), key=lambda r: r["rule_no"])


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rule-table source (S4): CSV with header, all text, blanks as ''."""
    from lakesmith.sources.csv import read_raw_csv
    return normalize(read_raw_csv(spark, path))


def write_rules(rules: DataFrame, path: str) -> None:
    """Rule-table sink (S4): one CSV file, header, in rule order."""
    (normalize(rules).orderBy("rule_no").coalesce(1).write.mode("overwrite")
     .option("header", True).option("escape", '"').csv(path))


def rules_from_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Rule table from plain dicts (tests, hand-written rules); order = list order."""
    data = [tuple(str(r.get(c, "") or "") for c in RULE_COLUMNS) + (i,) for i, r in enumerate(rows)]
    return rule_table(spark, data)
