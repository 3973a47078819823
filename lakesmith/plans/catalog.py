"""Registered queries: one per operator group, each with a DuckDB oracle.

Every query reads whole driver tables (or tables Spark derives from them)
and runs the library operators on them; the oracle states the expected
result in plain SQL over the same tables.  Column names match on both sides
and computed doubles are rounded identically, because results are compared
by value hash.

The test tables name keys ``c_custkey`` and so on, which none of the id
conventions recognise, so most queries first give the columns conventional
names (``customer_id`` ...), exactly as a user would through rename rules.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesmith.operators import bronze, docs, gold, profile, question, rules, runlog, silver
from lakesmith.operators.rules import BRONZE_DATE, BRONZE_FLOAT, BRONZE_INT, BRONZE_TEXT, DEDUP_TEXT
from lakesmith.plans import phases
from lakesmith.session import discard_at_exit, scratch_path
from lakesmith.sources.csv import read_csv_table
from lakesmith.sources.tables import ROW_ORDER, read_table

# Fixed values (our own choice): conventional column names per test table.
CONVENTIONAL = {
    "region": {"r_regionkey": "region_id", "r_name": "region_name"},
    "nation": {"n_nationkey": "nation_id", "n_name": "nation_name", "n_regionkey": "region_id"},
    "customer": {"c_custkey": "customer_id", "c_name": "customer_name", "c_nationkey": "nation_id",
                 "c_acctbal": "account_balance", "c_mktsegment": "segment"},
    "supplier": {"s_suppkey": "supplier_id", "s_name": "supplier_name", "s_nationkey": "nation_id",
                 "s_acctbal": "account_balance"},
    "part": {"p_partkey": "part_id", "p_name": "part_name", "p_brand": "brand", "p_type": "part_type",
             "p_size": "size", "p_retailprice": "price"},
    "orders": {"o_orderkey": "order_id", "o_custkey": "customer_id", "o_orderstatus": "order_status",
               "o_totalprice": "total_amount", "o_orderdate": "order_date", "o_orderpriority": "order_priority"},
    "lineitem": {"l_orderkey": "order_id", "l_partkey": "part_id", "l_suppkey": "supplier_id",
                 "l_linenumber": "line_number", "l_quantity": "quantity", "l_extendedprice": "extended_price",
                 "l_discount": "discount", "l_tax": "tax", "l_returnflag": "return_flag",
                 "l_linestatus": "line_status", "l_shipdate": "ship_date"},
}

# Column types of the test tables (Spark spelling), used to write oracle SQL.
SCHEMAS = {
    "customer": [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"),
                 ("c_acctbal", "double"), ("c_mktsegment", "string")],
    "supplier": [("s_suppkey", "bigint"), ("s_name", "string"), ("s_nationkey", "int"), ("s_acctbal", "double")],
    "orders": [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
               ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")],
    "lineitem": [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
                 ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
                 ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
                 ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")],
    "events": [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"), ("event_type", "string"),
               ("value", "double"), ("props", "string")],
}
# table -> its key in file order (every table used for ordered results is stored sorted by it)
FILE_ORDER = {"customer": "c_custkey", "orders": "o_orderkey", "events": "event_id", "supplier": "s_suppkey",
              "part": "p_partkey", "region": "r_regionkey", "nation": "n_nationkey", "documents": "doc_id"}

NUMERIC = ("bigint", "int", "double")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# -- helpers ----------------------------------------------------------------

def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, os.path.join(sf, f"{name}.parquet"))


def conventional(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A test table with conventional column names (row order kept)."""
    df = table(spark, sf, name)
    return df.select(*[F.col(old).alias(new) for old, new in CONVENTIONAL[name].items()], ROW_ORDER)


def sql_conventional(name: str) -> str:
    cols = ", ".join(f"{old} AS {new}" for old, new in CONVENTIONAL[name].items())
    return f"(SELECT {cols} FROM {name})"


def rename_decisions(spark: SparkSession, bronze_rule_table: DataFrame, names: list[str]) -> DataFrame:
    """Edited target names for generated Bronze rules (a rule review, G8)."""
    renames = {(t, old): new for t in names for old, new in CONVENTIONAL[t].items()}
    edits = [(r["rule_no"], renames[(r["source_table"], r["source_column"])])
             for r in rules.collect_rules(bronze_rule_table) if (r["source_table"], r["source_column"]) in renames]
    return spark.createDataFrame(edits, "rule_no long, target_column string")


def conventional_bronze(spark: SparkSession, sf: str, names: list[str]) -> dict[str, DataFrame]:
    """Profile -> generated Bronze rules -> renames approved -> Bronze tables."""
    sources = {n: table(spark, sf, n) for n in names}
    generated = rules.bronze_rules(profile.schema_profile(sources))
    approved = rules.approve(generated, rename_decisions(spark, generated, names))
    return bronze.execute_bronze(sources, approved)


def public(df: DataFrame) -> DataFrame:
    """Drop lineage and internal columns before comparing results."""
    return df.select(*[c for c in df.columns if c not in (ROW_ORDER, "_load_timestamp", "_source_file")])


def gold_rule_rows(spec: list[tuple[str, str, str, str, str]], target: str = "gold_output") -> list[dict]:
    return [{"source_table": s, "source_column": c, "target_table": target, "target_column": t,
             "transformation_type": ty, "transformation_logic": lg} for s, c, t, ty, lg in spec]


def passthrough(table_name: str, cols: list[str]) -> list[tuple]:
    return [(table_name, c, c, "Direct", "Passthrough") for c in cols]


# -- profiling --------------------------------------------------------------

def _profile_sql(tables: list[str]) -> str:
    parts = []
    for t in tables:
        for i, (c, ty) in enumerate(SCHEMAS[t]):
            num = ty in NUMERIC
            lo = f"MIN({c})::DOUBLE" if num else "NULL::DOUBLE"
            hi = f"MAX({c})::DOUBLE" if num else "NULL::DOUBLE"
            av = f"ROUND(AVG({c}::DOUBLE), 4)" if num else "NULL::DOUBLE"
            parts.append(
                f"SELECT '{t}' AS dataset, '{c}' AS column_name, {i}::INTEGER AS ordinal, '{ty}' AS dtype, "
                f"COUNT(*) AS rows, COUNT(*) - COUNT({c}) AS null_count, "
                f"ROUND(100.0::DOUBLE * (COUNT(*) - COUNT({c})) / COUNT(*), 2) AS null_pct, "
                f"COUNT(DISTINCT {c}) AS unique_count, {lo} AS min_value, {hi} AS max_value, {av} AS mean_value "
                f"FROM {t}")
    return "\nUNION ALL ".join(parts)


@register("p_profile_stats", _profile_sql(["customer", "orders", "lineitem"]))
def p_profile_stats(spark, sf):
    """Column statistics of three whole tables."""
    prof = profile.profile_tables({n: table(spark, sf, n) for n in ("customer", "orders", "lineitem")})
    return prof.select("dataset", "column_name", "ordinal", "dtype", "rows", "null_count", "null_pct",
                       "unique_count", "min_value", "max_value", F.round("mean_value", 4).alias("mean_value"))


def _samples_sql(tables: list[str]) -> str:
    parts = []
    for t in tables:
        key = FILE_ORDER[t]
        for c, ty in SCHEMAS[t]:
            if ty in NUMERIC:
                continue
            parts.append(
                f"SELECT '{t}' AS dataset, '{c}' AS column_name, rn AS sample_rank, v AS sample_value FROM "
                f"(SELECT CAST({c} AS VARCHAR) AS v, row_number() OVER (ORDER BY {key}) AS rn "
                f"FROM {t} WHERE {c} IS NOT NULL) WHERE rn <= 5")
    return "\nUNION ALL ".join(parts)


@register("p_sample_values", _samples_sql(["customer", "orders", "events"]))
def p_sample_values(spark, sf):
    """First five non-null values (file order) of every non-numeric column."""
    prof = profile.first_values({n: table(spark, sf, n) for n in ("customer", "orders", "events")})
    return (prof
            .select("dataset", "column_name", F.posexplode("sample_values").alias("pos", "sample_value"))
            .select("dataset", "column_name", (F.col("pos") + 1).cast("long").alias("sample_rank"), "sample_value"))


LABEL_TABLES = ["customer", "orders", "lineitem", "part", "supplier", "nation", "region", "events"]


# Expected labels of the test tables' columns, written out by hand.
LABELS = {
    "Unique identifier column": ["event_id", "user_id"],
    "Date/time column": ["o_orderdate", "l_shipdate"],
    "Monetary value column": ["o_totalprice", "l_extendedprice", "p_retailprice"],
    "Quantity/count column": ["l_quantity", "l_discount"],
    "Descriptive name column": ["c_name", "p_name", "s_name", "n_name", "r_name"],
    "Geographic/location column": ["n_regionkey", "r_regionkey"],
    "Categorical grouping column": ["c_mktsegment", "o_orderstatus", "l_linestatus", "p_type", "event_type"],
    "Descriptive text column": ["o_orderpriority", "l_returnflag", "p_brand", "ts", "props"],
}
_LABEL_CASE = "CASE " + " ".join(f"WHEN column_name IN ({', '.join(repr(c) for c in cols)}) THEN '{label}'"
                                 for label, cols in LABELS.items()) + " ELSE 'Numeric measure column' END"


_DESCRIBE = "\nUNION ALL ".join(
    f"SELECT '{t}' AS dataset, column_name, column_type FROM (DESCRIBE {t})" for t in LABEL_TABLES)

@register("p_semantic_labels", f"""
SELECT dataset, column_name, {_LABEL_CASE} AS semantic_label
FROM ({_DESCRIBE})""")
def p_semantic_labels(spark, sf):
    """Semantic label of every profiled column."""
    prof = profile.schema_profile({n: table(spark, sf, n) for n in LABEL_TABLES})
    return profile.semantic_labels(prof).select("dataset", "column_name", "semantic_label")


JOIN_TABLES = ["customer", "orders", "lineitem", "part", "supplier", "nation", "region"]
_CONV_VALUES = ", ".join(f"('{t}', {i}, '{new}')" for i, t in enumerate(JOIN_TABLES)
                         for new in CONVENTIONAL[t].values())


@register("p_join_keys", f"""
WITH cols(dataset, dataset_no, column_name) AS (VALUES {_CONV_VALUES})
SELECT l.dataset AS left_dataset, l.column_name AS left_column, r.dataset AS right_dataset,
       r.column_name AS right_column,
       CASE WHEN l.column_name IN ('region_id', 'nation_id', 'customer_id', 'order_id', 'part_id', 'supplier_id') THEN 'high' ELSE 'medium' END AS confidence
FROM cols l JOIN cols r ON l.column_name = r.column_name AND l.dataset_no < r.dataset_no""")
def p_join_keys(spark, sf):
    """Candidate join keys between seven tables with conventional names."""
    prof = profile.schema_profile({n: conventional(spark, sf, n) for n in JOIN_TABLES})
    return profile.join_keys(prof).drop("ln", "rn")


def documents_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with their (partial) labels: unlabelled ones have nulls."""
    d = table(spark, sf, "documents").select("doc_id", "lang", "source", ROW_ORDER)
    lab = table(spark, sf, "labels").select("doc_id", "quality", "toxic")
    j = d.join(lab, "doc_id", "left")
    label = F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")
    return j.select("doc_id", "lang", "source", "quality", "toxic", label.alias("quality_label"), ROW_ORDER)


_DOCS_LABELS_SQL = ("(SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic, "
                    "CASE WHEN l.quality = 1 THEN 'good' WHEN l.quality = 0 THEN 'poor' END AS quality_label "
                    "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)")


def _quality_sql() -> str:
    parts = []
    for t in ("customer", "supplier", "orders"):
        for c, ty in SCHEMAS[t]:
            if ty in NUMERIC:
                parts.append(f"SELECT '{t}' AS dataset, '{c}' AS column_name, "
                             f"'{t}.{c}: contains negative values (min=' || CAST(MIN({c})::DOUBLE AS VARCHAR) || ')' "
                             f"AS note FROM {t} HAVING MIN({c}) < 0")
            parts.append(f"SELECT '{t}' AS dataset, '{c}' AS column_name, '{t}.{c}: ' || "
                         f"CAST(ROUND(100.0::DOUBLE * (COUNT(*) - COUNT({c})) / COUNT(*), 2) AS VARCHAR) "
                         f"|| '% null values' AS note FROM {t} HAVING COUNT(*) > COUNT({c})")
    for c in ("doc_id", "lang", "source", "quality", "toxic", "quality_label"):
        parts.append(f"SELECT 'documents_labels' AS dataset, '{c}' AS column_name, 'documents_labels.{c}: ' || "
                     f"CAST(ROUND(100.0::DOUBLE * (COUNT(*) - COUNT({c})) / COUNT(*), 2) AS VARCHAR) "
                     f"|| '% null values' AS note FROM {_DOCS_LABELS_SQL} HAVING COUNT(*) > COUNT({c})")
    return "\nUNION ALL ".join(parts)


@register("p_quality_notes", _quality_sql())
def p_quality_notes(spark, sf):
    """Null and negative-value notes (natural nulls from partial labels)."""
    tabs = {n: table(spark, sf, n) for n in ("customer", "supplier", "orders")}
    tabs["documents_labels"] = documents_labels(spark, sf)
    return profile.quality_notes(profile.profile_tables(tabs)).select("dataset", "column_name", "note")


# -- rule generation --------------------------------------------------------

# Expected rule texts, written out by hand (the oracles share nothing with the generators).
INT_RULE, FLOAT_RULE = "Convert to integer whole number", "Convert to float decimal numeric"
DATE_RULE, TEXT_RULE = "Convert to date format", "Convert to text format"
LOAD_RULE, FILE_RULE = "Current UTC timestamp injected at load time", "Source file path injected at load time"
KEY_RULE = "Auto-generated sequential surrogate primary key starting from 1"
ID_CLEAN = "Cast to text/string type; no null handling (identifier column)"
DATE_CLEAN = "Fill null with mode then standardise date format to YYYY-MM-DD"
NUMBER_CLEAN = "Fill null values with mean; cast to numeric type"
TEXT_CLEAN = "Fill null values with mode; strip whitespace and standardise text format"

DATE_COLUMNS = ("o_orderdate", "l_shipdate")


def _bronze_rules_sql(tables: list[str], where: str = "", logic_override: str = "") -> str:
    parts = []
    for t in tables:
        for c, ty in SCHEMAS[t]:
            logic = INT_RULE if ty in ("bigint", "int") else FLOAT_RULE if ty == "double" else DATE_RULE if c in DATE_COLUMNS else TEXT_RULE
            parts.append(f"('{t}', '{c}', '{t}', '{c}', '{logic}')")
        parts.append(f"('{t}', '', '{t}', '_load_timestamp', '{LOAD_RULE}')")
        parts.append(f"('{t}', '', '{t}', '_source_file', '{FILE_RULE}')")
    logic = logic_override or "transformation_logic"
    return (f"SELECT source_table, source_column, target_table, target_column, 'Indirect' AS transformation_type, "
            f"{logic} AS transformation_logic FROM (VALUES {', '.join(parts)}) "
            f"r(source_table, source_column, target_table, target_column, transformation_logic) {where}")


RULE_OUT = ["source_table", "source_column", "target_table", "target_column", "transformation_type",
            "transformation_logic"]


@register("g_bronze_rules", f"""
WITH d AS ({'UNION ALL '.join(f"SELECT '{t}' AS t, column_name AS c, column_type AS ty FROM (DESCRIBE {t}) " for t in ('customer', 'orders', 'lineitem'))})
SELECT t AS source_table, c AS source_column, t AS target_table, c AS target_column, 'Indirect' AS transformation_type,
  CASE WHEN ty IN ('BIGINT', 'INTEGER') THEN '{INT_RULE}' WHEN ty IN ('DOUBLE', 'FLOAT') THEN '{FLOAT_RULE}'
       WHEN c IN {DATE_COLUMNS} THEN '{DATE_RULE}' ELSE '{TEXT_RULE}' END AS transformation_logic FROM d
UNION ALL SELECT t, '', t, '_load_timestamp', 'Indirect', '{LOAD_RULE}' FROM (VALUES ('customer'), ('orders'), ('lineitem')) v(t)
UNION ALL SELECT t, '', t, '_source_file', 'Indirect', '{FILE_RULE}' FROM (VALUES ('customer'), ('orders'), ('lineitem')) v(t)""")
def g_bronze_rules(spark, sf):
    """Bronze rules of three tables (names and types are enough)."""
    prof = profile.schema_profile({n: table(spark, sf, n) for n in ("customer", "orders", "lineitem")})
    return rules.bronze_rules(prof).select(*RULE_OUT)


@register("g_approved", _bronze_rules_sql(
    ["customer", "orders"], where="WHERE source_column NOT LIKE '%priority'",
    logic_override=f"CASE WHEN source_column = 'o_totalprice' THEN '{TEXT_RULE}' ELSE transformation_logic END"))
def g_approved(spark, sf):
    """A review drops the priority rule and edits one rule's text."""
    prof = profile.schema_profile({n: table(spark, sf, n) for n in ("customer", "orders")})
    generated = rules.bronze_rules(prof)
    decisions = generated.select(
        "rule_no", (~F.col("source_column").endswith("priority")).alias("selected"),
        F.when(F.col("source_column") == "o_totalprice", F.lit(BRONZE_TEXT)).alias("transformation_logic"))
    # (a review table computed from the rules themselves)
    return rules.approve(generated, decisions).select(*RULE_OUT)


def _silver_rules_sql(tables: list[str]) -> str:
    rows, pk, dedup = [], [], []
    for t in tables:
        pk.append(f"SELECT '{t}_bronze', '', '{t}', 'pk_{t}_silver_id', 'Indirect', '{KEY_RULE}'")
        typed = dict(SCHEMAS[t])
        first_id = None
        for old, new in CONVENTIONAL[t].items():
            if new.endswith("_id"):
                logic = ID_CLEAN
                first_id = first_id or new
            elif new.endswith("_date"):
                logic = DATE_CLEAN
            else:
                logic = NUMBER_CLEAN if typed[old] in NUMERIC else TEXT_CLEAN
            rows.append(f"SELECT '{t}_bronze', '{new}', '{t}', '{new}', 'Indirect', '{logic}'")
        if first_id:
            dedup.append(f"SELECT '{t}_bronze', '{first_id}', '{t}', '{first_id}', 'Indirect', "
                         f"'Deduplicate rows based on {first_id}'")
    body = "\nUNION ALL ".join(pk + rows + dedup)
    return f"SELECT * FROM ({body}) r({', '.join(RULE_OUT)})"


@register("g_silver_rules", _silver_rules_sql(["customer", "orders"]))
def g_silver_rules(spark, sf):
    """Silver rules from the Bronze schemas (after a rename review)."""
    prof = profile.schema_profile({n: table(spark, sf, n) for n in ("customer", "orders")})
    generated = rules.bronze_rules(prof)
    approved = rules.approve(generated, rename_decisions(spark, generated, ["customer", "orders"]))
    b = bronze.execute_bronze({n: table(spark, sf, n) for n in ("customer", "orders")}, approved)
    return rules.silver_rules(spark, b).select(*RULE_OUT)


def _gold_rules_sql(tables: list[str]) -> str:
    rows = [f"SELECT '', '', 'gold_output', 'pk_gold_id', 'Indirect', '{KEY_RULE}'"]
    for t in tables:
        for c in [f"pk_{t}_silver_id", *CONVENTIONAL[t].values(), "_load_timestamp", "_source_file"]:
            rows.append(f"SELECT '{t}', '{c}', 'gold_output', '{c}', 'Direct', 'Passthrough'")
    return f"SELECT * FROM ({chr(10).join(['UNION ALL ' + r if i else r for i, r in enumerate(rows)])}) r({', '.join(RULE_OUT)})"


@register("g_gold_rules", _gold_rules_sql(["customer", "orders"]))
def g_gold_rules(spark, sf):
    """Gold passthrough rules from the Silver schemas."""
    b = conventional_bronze(spark, sf, ["customer", "orders"])
    s = silver.execute_silver(b, rules.silver_rules(spark, b))
    return rules.gold_rules(spark, s).select(*RULE_OUT)


# -- raw text files -----------------------------------------------------------

@register("s_csv_ingest", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""")
def s_csv_ingest(spark, sf):
    """S1 + B10: a whole table exported as CSV text, read back with null tokens
    and type inference, then loaded to Bronze with the generated rules."""
    path = scratch_path(spark, "csv")
    (table(spark, sf, "orders").drop(ROW_ORDER).write.option("header", True)
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))
    discard_at_exit(spark, path)
    raw = {"orders": read_csv_table(spark, path)}
    generated = rules.bronze_rules(profile.schema_profile(raw))
    return public(bronze.execute_bronze(raw, generated)["orders_bronze"])


# -- Bronze -----------------------------------------------------------------

def as_text(df: DataFrame) -> DataFrame:
    """A table as a raw text file would give it: every value as text."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns if c != ROW_ORDER], ROW_ORDER)


@register("b_bronze_casts", """
SELECT TRY_CAST(CAST(o_orderkey AS VARCHAR) AS BIGINT) AS order_id,
       TRY_CAST(CAST(o_custkey AS VARCHAR) AS BIGINT) AS customer_id,
       CAST(o_orderstatus AS VARCHAR) AS order_status,
       TRY_CAST(CAST(o_totalprice AS VARCHAR) AS DOUBLE) AS total_amount,
       try_strptime(CAST(o_orderdate AS VARCHAR), '%Y-%m-%d %H:%M:%S') AS order_date,
       o_orderpriority
FROM orders""")
def b_bronze_casts(spark, sf):
    """Rename and integer/float/date/text casts of a text-typed table."""
    raw = as_text(table(spark, sf, "orders"))
    r = rules.rules_from_rows(spark, [
        {"source_table": "orders", "source_column": "o_orderkey", "target_column": "order_id",
         "transformation_logic": BRONZE_INT},
        {"source_table": "orders", "source_column": "o_custkey", "target_column": "customer_id",
         "transformation_logic": BRONZE_INT},
        {"source_table": "orders", "source_column": "o_orderstatus", "target_column": "order_status",
         "transformation_logic": BRONZE_TEXT},
        {"source_table": "orders", "source_column": "o_totalprice", "target_column": "total_amount",
         "transformation_logic": BRONZE_FLOAT},
        {"source_table": "orders", "source_column": "o_orderdate", "target_column": "order_date",
         "transformation_logic": BRONZE_DATE},
    ])
    return public(bronze.execute_bronze({"orders": raw}, r)["orders_bronze"])


@register("b_integer_guard", """
SELECT TRY_CAST(CAST(l_orderkey AS VARCHAR) AS BIGINT) AS order_id,
       TRY_CAST(CAST(l_linenumber AS VARCHAR) AS BIGINT) AS line_number,
       CAST(TRY_CAST(CAST(l_quantity AS VARCHAR) AS DOUBLE) AS BIGINT) AS quantity,
       CAST(l_discount AS VARCHAR) AS discount,
       TRY_CAST(CAST(l_extendedprice AS VARCHAR) AS DOUBLE) AS extended_price,
       try_strptime(CAST(l_shipdate AS VARCHAR), '%Y-%m-%d %H:%M:%S') AS ship_date,
       l_returnflag AS return_flag
FROM lineitem""")
def b_integer_guard(spark, sf):
    """Integer casts; a column holding fractions is left unchanged."""
    raw = as_text(table(spark, sf, "lineitem")).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_extendedprice", "l_shipdate",
        "l_returnflag", ROW_ORDER)
    spec = [("l_orderkey", "order_id", BRONZE_INT), ("l_linenumber", "line_number", BRONZE_INT),
            ("l_quantity", "quantity", BRONZE_INT), ("l_discount", "discount", BRONZE_INT),
            ("l_extendedprice", "extended_price", BRONZE_FLOAT), ("l_shipdate", "ship_date", BRONZE_DATE),
            ("l_returnflag", "return_flag", BRONZE_TEXT)]
    r = rules.rules_from_rows(spark, [{"source_table": "lineitem", "source_column": s, "target_column": t,
                                       "transformation_logic": lg} for s, t, lg in spec])
    return public(bronze.execute_bronze({"lineitem": raw}, r)["lineitem_bronze"])


# -- Silver -----------------------------------------------------------------

def silver_rule_rows(table_name: str, spec: list[tuple[str, str]]) -> list[dict]:
    return [{"source_table": table_name, "source_column": c, "target_column": c, "transformation_logic": lg}
            for c, lg in spec]


def run_silver(spark, df: DataFrame, name: str, spec: list[tuple[str, str]]) -> DataFrame:
    r = rules.rules_from_rows(spark, silver_rule_rows(name, spec))
    return public(silver.execute_silver({name: df}, r)[f"{name[:-len('_bronze')] if name.endswith('_bronze') else name}_silver"])


_DL_PK = "pk_documents_labels_silver_id"


@register("v_drop_null", f"""
SELECT row_number() OVER (ORDER BY doc_id) AS {_DL_PK}, doc_id, quality
FROM {_DOCS_LABELS_SQL} WHERE quality IS NOT NULL""")
def v_drop_null(spark, sf):
    """V4 + V16: drop rows with a missing label, then number the rest."""
    return run_silver(spark, documents_labels(spark, sf), "documents_labels",
                      [("doc_id", "Keep"), ("quality", "Drop null values")])


@register("v_fill_mean", f"""
SELECT row_number() OVER (ORDER BY doc_id) AS {_DL_PK}, doc_id,
       ROUND(COALESCE(quality::DOUBLE, AVG(quality) OVER ()), 9) AS quality
FROM {_DOCS_LABELS_SQL}""")
def v_fill_mean(spark, sf):
    """V5 (+Q4): mean fill of an integer column with a fractional mean."""
    out = run_silver(spark, documents_labels(spark, sf), "documents_labels",
                     [("doc_id", "Keep"), ("quality", "Fill null values with mean")])
    return out.withColumn("quality", F.round(F.col("quality").cast("double"), 9))


@register("v_fill_median", f"""
SELECT row_number() OVER (ORDER BY doc_id) AS {_DL_PK}, doc_id,
       COALESCE(toxic::DOUBLE, MEDIAN(toxic) OVER ()) AS toxic
FROM {_DOCS_LABELS_SQL}""")
def v_fill_median(spark, sf):
    """V6: exact median fill."""
    out = run_silver(spark, documents_labels(spark, sf), "documents_labels",
                     [("doc_id", "Keep"), ("toxic", "Fill null with median")])
    return out.withColumn("toxic", F.col("toxic").cast("double"))


@register("v_fill_mode", f"""
WITH dl AS {_DOCS_LABELS_SQL},
m AS (SELECT quality_label FROM dl WHERE quality_label IS NOT NULL GROUP BY quality_label
      ORDER BY COUNT(*) DESC, quality_label LIMIT 1)
SELECT row_number() OVER (ORDER BY doc_id) AS {_DL_PK}, doc_id,
       COALESCE(dl.quality_label, (SELECT quality_label FROM m)) AS quality_label
FROM dl""")
def v_fill_mode(spark, sf):
    """V7: mode fill, ties to the smallest value."""
    return run_silver(spark, documents_labels(spark, sf), "documents_labels",
                      [("doc_id", "Keep"), ("quality_label", "Fill null values with mode")])


@register("v_fill_default", f"""
SELECT row_number() OVER (ORDER BY doc_id) AS {_DL_PK}, doc_id, COALESCE(quality_label, '') AS quality_label,
       quality
FROM {_DOCS_LABELS_SQL}""")
def v_fill_default(spark, sf):
    """V8 (+Q9): blank fill applies to text; a numeric column is left as is."""
    return run_silver(spark, documents_labels(spark, sf), "documents_labels",
                      [("doc_id", "Keep"), ("quality_label", "Fill null with default"),
                       ("quality", "Fill null with default")])


@register("v_dedup_first", """
SELECT row_number() OVER (ORDER BY event_id) AS pk_events_silver_id, user_id, event_id, event_type
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events) WHERE rn = 1""")
def v_dedup_first(spark, sf):
    """V2: keep the first event of every user."""
    ev = table(spark, sf, "events").select("user_id", "event_id", "event_type", ROW_ORDER)
    return run_silver(spark, ev, "events", [("event_id", "Keep"), ("event_type", "Keep"),
                                            ("user_id", DEDUP_TEXT.format("user_id"))])


@register("v_dedup_row", """
SELECT row_number() OVER (ORDER BY first_event) AS pk_events_silver_id, user_id, event_type
FROM (SELECT user_id, event_type, MIN(event_id) AS first_event FROM events GROUP BY user_id, event_type)""")
def v_dedup_row(spark, sf):
    """V3: whole-row dedup (the rule names no existing column)."""
    ev = table(spark, sf, "events").select("user_id", "event_type", ROW_ORDER)
    r = rules.rules_from_rows(spark, silver_rule_rows("events", [("user_id", "Keep"), ("event_type", "Keep")])
                              + [{"source_table": "events", "transformation_logic": "Deduplicate rows"}])
    return public(silver.execute_silver({"events": ev}, r)["events_silver"])


@register("v_dates", """
SELECT row_number() OVER (ORDER BY o_orderkey) AS pk_orders_silver_id, o_orderkey AS order_id,
       try_strptime(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN strftime(o_orderdate, '%d/%m/%Y')
                         ELSE strftime(o_orderdate, '%Y%m%d') END, '%d/%m/%Y') AS order_date
FROM orders""")
def v_dates(spark, sf):
    """V9: mixed date texts; the first format that parses any row wins for all."""
    o = table(spark, sf, "orders")
    text_date = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"),
                       F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    df = o.select(F.col("o_orderkey").alias("order_id"), text_date.alias("order_date"), ROW_ORDER)
    return run_silver(spark, df, "orders", [("order_id", "Keep"),
                                            ("order_date", "Standardise date format to YYYY-MM-DD")])


_TITLE_SQL = ("array_to_string(list_transform(regexp_extract_all(lower(p_name), '(\\pL+|[^\\pL]+)'), "
              "lambda t: upper(t[1]) || t[2:]), '')")


@register("v_case", f"""
SELECT row_number() OVER (ORDER BY p_partkey) AS pk_part_silver_id, p_partkey AS part_id,
       {_TITLE_SQL} AS part_name, lower(p_brand) AS brand, upper(p_type) AS part_type
FROM part""")
def v_case(spark, sf):
    """Lower, upper and title case."""
    p = conventional(spark, sf, "part").select("part_id", "part_name", "brand", "part_type", ROW_ORDER)
    return run_silver(spark, p, "part", [("part_id", "Keep"), ("part_name", "Convert to title case"),
                                         ("brand", "Convert to lowercase"), ("part_type", "Convert to uppercase")])


_WS = r"[\t\n\x0b\x0c\r\x1c-\x1f\x85\p{Z}]"


@register("v_strip", f"""
SELECT row_number() OVER (ORDER BY doc_id) AS pk_documents_silver_id, doc_id,
       regexp_replace(text, '^{_WS}+|{_WS}+$', '', 'g') AS text
FROM documents""")
def v_strip(spark, sf):
    """Strip all surrounding whitespace of whole documents."""
    d = table(spark, sf, "documents").select("doc_id", "text", ROW_ORDER)
    return run_silver(spark, d, "documents", [("doc_id", "Keep"), ("text", "Strip whitespace")])


@register("v_silver_customer", """
SELECT row_number() OVER (ORDER BY c_custkey) AS pk_customer_silver_id, CAST(c_custkey AS VARCHAR) AS customer_id,
       c_name AS customer_name, CAST(c_nationkey AS VARCHAR) AS nation_id, c_acctbal AS account_balance,
       c_mktsegment AS segment
FROM customer""")
def v_silver_customer(spark, sf):
    """The generated Silver rules end to end."""
    b = conventional_bronze(spark, sf, ["customer"])
    return public(silver.execute_silver(b, rules.silver_rules(spark, b))["customer_silver"])


@register("v_silver_orders", """
SELECT row_number() OVER (ORDER BY o_orderkey) AS pk_orders_silver_id, CAST(o_orderkey AS VARCHAR) AS order_id,
       CAST(o_custkey AS VARCHAR) AS customer_id, o_orderstatus AS order_status, o_totalprice AS total_amount,
       o_orderdate AS order_date, o_orderpriority AS order_priority
FROM orders""")
def v_silver_orders(spark, sf):
    """Generated Silver rules on a fact table (date column already typed)."""
    b = conventional_bronze(spark, sf, ["orders"])
    return public(silver.execute_silver(b, rules.silver_rules(spark, b))["orders_silver"])


# -- Gold -------------------------------------------------------------------

def run_gold(spark, sources: dict[str, DataFrame], spec: list[tuple]) -> DataFrame:
    r = rules.rules_from_rows(spark, gold_rule_rows(spec))
    return public(gold.execute_gold(sources, r)["gold_output"])


@register("o_full_outer", f"""
SELECT row_number() OVER (ORDER BY COALESCE(c.customer_id, o.customer_id) NULLS LAST, c.customer_id, o.order_id) AS pk_gold_id,
       COALESCE(c.customer_id, o.customer_id) AS customer_id, c.customer_name, c.segment, o.order_id, o.total_amount
FROM {sql_conventional('customer')} c FULL JOIN {sql_conventional('orders')} o
  ON c.customer_id IS NOT DISTINCT FROM o.customer_id""")
def o_full_outer(spark, sf):
    """O3: full outer join on the shared id column."""
    src = {"customer": conventional(spark, sf, "customer"), "orders": conventional(spark, sf, "orders")}
    return run_gold(spark, src, passthrough("customer", ["customer_id", "customer_name", "segment"])
                    + passthrough("orders", ["order_id", "total_amount"]))


@register("o_left_wins", f"""
SELECT row_number() OVER (ORDER BY COALESCE(c.customer_id, o.customer_id) NULLS LAST, o.order_id) AS pk_gold_id,
       COALESCE(c.customer_id, o.customer_id) AS customer_id, c.account_balance, o.order_id
FROM {sql_conventional('customer')} c FULL JOIN {sql_conventional('orders')} o
  ON c.customer_id IS NOT DISTINCT FROM o.customer_id""")
def o_left_wins(spark, sf):
    """On the clashing column the left copy wins."""
    orders = conventional(spark, sf, "orders").withColumn("account_balance", F.col("total_amount"))
    src = {"customer": conventional(spark, sf, "customer"), "orders": orders}
    return run_gold(spark, src, passthrough("customer", ["customer_id", "account_balance"])
                    + passthrough("orders", ["order_id", "account_balance"]))


@register("o_multi_pass", f"""
WITH rn AS (SELECT COALESCE(r.region_id, n.region_id) AS region_id, r.region_name, n.nation_id, n.nation_name
            FROM {sql_conventional('region')} r FULL JOIN {sql_conventional('nation')} n
            ON r.region_id IS NOT DISTINCT FROM n.region_id)
SELECT row_number() OVER (ORDER BY COALESCE(rn.nation_id, c.nation_id) NULLS LAST, rn.region_id NULLS LAST, c.customer_id)
         AS pk_gold_id,
       rn.region_id, rn.region_name, COALESCE(rn.nation_id, c.nation_id) AS nation_id, rn.nation_name,
       c.customer_id, c.customer_name
FROM rn FULL JOIN {sql_conventional('customer')} c ON rn.nation_id IS NOT DISTINCT FROM c.nation_id""")
def o_multi_pass(spark, sf):
    """Region shares no key with customer yet; nation joins first, then customer."""
    src = {n: conventional(spark, sf, n) for n in ("region", "customer", "nation")}
    return run_gold(spark, src, passthrough("region", ["region_id", "region_name"])
                    + passthrough("customer", ["customer_id", "customer_name", "nation_id"])
                    + passthrough("nation", ["nation_id", "nation_name", "region_id"]))


@register("o_union", f"""
SELECT row_number() OVER (ORDER BY part_no, k) AS pk_gold_id, region_id, region_name, part_id, part_name
FROM (SELECT 0 AS part_no, region_id AS k, region_id, region_name, NULL::BIGINT AS part_id, NULL::VARCHAR AS part_name
      FROM {sql_conventional('region')}
      UNION ALL
      SELECT 1, part_id, NULL::INTEGER, NULL::VARCHAR, part_id, part_name FROM {sql_conventional('part')})""")
def o_union(spark, sf):
    """Tables with no shared id are stacked by column name."""
    src = {"region": conventional(spark, sf, "region"), "part": conventional(spark, sf, "part")}
    return run_gold(spark, src, passthrough("region", ["region_id", "region_name"])
                    + passthrough("part", ["part_id", "part_name"]))


def _gold_agg_query(fn_text: str, measure: str, out_expr):
    def q(spark, sf):
        li = conventional(spark, sf, "lineitem")
        spec = [("lineitem", "return_flag", "return_flag", "Indirect", "Group by"),
                ("lineitem", "line_status", "line_status", "Indirect", "Group by"),
                ("lineitem", measure, measure, "Indirect", fn_text)]
        out = run_gold(spark, {"lineitem": li}, spec)
        return out.withColumn(measure, out_expr(F.col(measure)))
    return q


def _gold_agg_sql(agg_sql: str, measure: str) -> str:
    return (f"SELECT row_number() OVER (ORDER BY return_flag NULLS LAST, line_status NULLS LAST) AS pk_gold_id, "
            f"return_flag, line_status, {agg_sql} AS {measure} FROM {sql_conventional('lineitem')} "
            f"GROUP BY return_flag, line_status")


register("o_sum", _gold_agg_sql("ROUND(COALESCE(SUM(quantity), 0), 2)", "quantity"))(
    _gold_agg_query("Sum of quantity", "quantity", lambda c: F.round(c, 2)))
register("o_avg", _gold_agg_sql("ROUND(AVG(extended_price), 4)", "extended_price"))(
    _gold_agg_query("Average extended price", "extended_price", lambda c: F.round(c, 4)))
register("o_count", _gold_agg_sql("COUNT(order_id)", "order_id"))(
    _gold_agg_query("Count of orders", "order_id", lambda c: c))
register("o_max", _gold_agg_sql("MAX(discount)", "discount"))(
    _gold_agg_query("Maximum discount", "discount", lambda c: c))
register("o_min", _gold_agg_sql("MIN(tax)", "tax"))(
    _gold_agg_query("Minimum tax", "tax", lambda c: c))


@register("o_rename", """
SELECT row_number() OVER (ORDER BY o_orderstatus NULLS LAST) AS pk_gold_id, o_orderstatus AS status,
       ROUND(COALESCE(SUM(o_totalprice), 0), 2) AS revenue
FROM orders GROUP BY o_orderstatus""")
def o_rename(spark, sf):
    """Renamed group and measure columns; aggregates follow the rename."""
    o = table(spark, sf, "orders")
    spec = [("orders", "o_orderstatus", "status", "Indirect", "Group by status"),
            ("orders", "o_totalprice", "revenue", "Indirect", "Sum of revenue")]
    out = run_gold(spark, {"orders": o}, spec)
    return out.withColumn("revenue", F.round("revenue", 2))


# -- questions --------------------------------------------------------------

def customer_orders_gold(spark, sf) -> dict[str, DataFrame]:
    src = {"customer": conventional(spark, sf, "customer"), "orders": conventional(spark, sf, "orders")}
    spec = (passthrough("customer", ["customer_id", "customer_name", "account_balance", "segment"])
            + passthrough("orders", ["order_id", "order_status", "total_amount", "order_date", "order_priority"]))
    return gold.execute_gold(src, rules.rules_from_rows(spark, gold_rule_rows(spec)))


def _question_query(text: str, rounding: int | None):
    def q(spark, sf):
        g = question.union_gold(customer_orders_gold(spark, sf))
        spec = question.plan(g, text)
        result = question.grouped_top_k(g, spec)
        v = spec.value_col
        return result if rounding is None else result.withColumn(v, F.round(F.col(v), rounding))
    return q


_CO = (f"(SELECT c.segment, c.account_balance, o.order_status, o.total_amount, o.order_priority "
       f"FROM {sql_conventional('customer')} c FULL JOIN {sql_conventional('orders')} o "
       f"ON c.customer_id IS NOT DISTINCT FROM o.customer_id)")

register("r_sum", f"""
SELECT segment, ROUND(SUM(total_amount), 2) AS total_amount FROM {_CO} GROUP BY segment
ORDER BY SUM(total_amount) DESC NULLS LAST, segment ASC NULLS LAST LIMIT 10""")(
    _question_query("What is the total revenue by segment?", 2))
register("r_avg", f"""
SELECT order_priority, ROUND(AVG(total_amount), 4) AS total_amount FROM {_CO} GROUP BY order_priority
ORDER BY AVG(total_amount) DESC NULLS LAST, order_priority ASC NULLS LAST LIMIT 10""")(
    _question_query("What is the average order value by order priority?", 4))
register("r_count", f"""
SELECT order_status, COUNT(*) AS record_count FROM {_CO} GROUP BY order_status
ORDER BY COUNT(*) DESC NULLS LAST, order_status ASC NULLS LAST LIMIT 10""")(
    _question_query("How many orders are there per order status?", None))
register("r_max", f"""
SELECT segment, MAX(total_amount) AS total_amount FROM {_CO} GROUP BY segment
ORDER BY MAX(total_amount) DESC NULLS LAST, segment ASC NULLS LAST LIMIT 10""")(
    _question_query("What is the maximum value of total amount by segment?", None))
register("r_min", f"""
SELECT segment, MIN(account_balance) AS account_balance FROM {_CO} GROUP BY segment
ORDER BY MIN(account_balance) ASC NULLS LAST, segment ASC NULLS LAST LIMIT 10""")(
    _question_query("What is the minimum value of account balance by segment?", None))
register("r_lowest", f"""
SELECT segment, ROUND(SUM(total_amount), 2) AS total_amount FROM {_CO} GROUP BY segment
ORDER BY SUM(total_amount) ASC NULLS LAST, segment ASC NULLS LAST LIMIT 10""")(
    _question_query("Which segment has the lowest total sales?", 2))


@register("r_fallback_dim", f"""
SELECT discount, ROUND(SUM(extended_price), 2) AS extended_price FROM {sql_conventional('lineitem')}
GROUP BY discount ORDER BY SUM(extended_price) DESC NULLS LAST, discount ASC NULLS LAST LIMIT 10""")
def r_fallback_dim(spark, sf):
    """No text column, so a low-cardinality numeric column is the dimension."""
    li = conventional(spark, sf, "lineitem")
    g = gold.execute_gold({"lineitem": li}, rules.rules_from_rows(spark, gold_rule_rows(passthrough(
        "lineitem", ["order_id", "line_number", "quantity", "extended_price", "discount", "tax"]))))
    result, _ = question.answer(g, "What is the total extended price by discount?")
    return result.withColumn("extended_price", F.round("extended_price", 2))


# -- documents --------------------------------------------------------------

SEARCH_TEXT = "the of and to le la de et des der die und el los"
_WORDS = ", ".join(f"'{w}'" for w in docs.query_words(SEARCH_TEXT))


@register("k_search", f"""
SELECT CAST(doc_id AS VARCHAR) AS id,
       len(list_intersect(list_distinct(string_split_regex(lower(text), '{_WS}+')), [{_WORDS}]))::INTEGER AS score
FROM documents ORDER BY score DESC, doc_id LIMIT 5""")
def k_search(spark, sf):
    """K2: top five whole documents by shared distinct words."""
    store = docs.as_store(table(spark, sf, "documents"), "doc_id", "text", ["lang", "source"])
    return docs.search(store, SEARCH_TEXT, 5).select("id", F.col("score").cast("int").alias("score"))


@register("k_upsert", """
SELECT CAST(d.doc_id AS VARCHAR) AS id, 0::BIGINT AS stored_batch, NULL::VARCHAR AS quality FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
UNION ALL
SELECT CAST(d.doc_id AS VARCHAR), 1::BIGINT, CAST(l.quality AS VARCHAR) FROM documents d JOIN labels l ON l.doc_id = d.doc_id""")
def k_upsert(spark, sf):
    """K1: labelled documents are stored again; they replace the old copies."""
    d = table(spark, sf, "documents")
    store = docs.as_store(d, "doc_id", "text", ["lang", "source"])
    labelled = d.join(table(spark, sf, "labels").select("doc_id", "quality", "toxic"), "doc_id")
    new = docs.as_store(labelled, "doc_id", "text", ["lang", "quality", "toxic"], batch=1)
    out = docs.upsert(store, new)
    return out.select("id", "stored_batch", F.col("metadata")["quality"].alias("quality"))


# -- run logs ---------------------------------------------------------------

def events_as_runlog(spark, sf) -> DataFrame:
    ev = table(spark, sf, "events")
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
    return ev.select(F.col("event_id"), iso.alias("timestamp"), F.concat(F.lit("run-"), F.col("user_id")).alias("run_id"),
                     F.lit("events").alias("agent"), F.col("event_type").alias("action"),
                     F.lit(None).cast("string").alias("status"), F.lit(None).cast("string").alias("phase"),
                     F.create_map(F.lit("props"), F.col("props")).alias("details"))


@register("l_status", """
SELECT event_id, 'run-' || user_id AS run_id, event_type AS action,
       CASE WHEN event_type LIKE '%failed%' OR event_type LIKE '%error%' THEN 'is-failed' ELSE 'is-neutral' END
         AS status_class,
       'No rationale captured' AS reason, strftime(ts, '%H:%M:%S') AS clock
FROM events""")
def l_status(spark, sf):
    """Status class, reason fallback and clock text per event."""
    return runlog.annotate(events_as_runlog(spark, sf)).select("event_id", "run_id", "action", "status_class",
                                                               "reason", "clock")


@register("l_latest", """
SELECT 'run-' || user_id AS run_id, strftime(MAX(ts), '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS timestamp,
       arg_max(event_type, ts) AS action
FROM events GROUP BY user_id""")
def l_latest(spark, sf):
    """L3: the newest event of every run."""
    return runlog.latest_per_run(events_as_runlog(spark, sf)).select("run_id", "timestamp", "action")


# -- end to end -------------------------------------------------------------

QUESTION = "What is the total revenue by segment?"


@register("e_end_to_end", f"""
SELECT c.c_mktsegment AS segment, ROUND(SUM(o.o_totalprice), 2) AS total_amount
FROM customer c FULL JOIN orders o ON c.c_custkey = o.o_custkey
GROUP BY c.c_mktsegment ORDER BY SUM(o.o_totalprice) DESC NULLS LAST, segment LIMIT 10""")
def e_end_to_end(spark, sf):
    """E5: profile, rules (with a rename review), Bronze, Silver, Gold, answer."""
    names = ["customer", "orders"]
    sources = {n: table(spark, sf, n) for n in names}
    # the review edits rule cells by rule number; numbers depend on the schema only
    generated = rules.bronze_rules(profile.schema_profile(sources))
    decisions = {"bronze": rename_decisions(spark, generated, names)}
    state = phases.run(spark, sources, QUESTION, decisions)
    return state.result.withColumn("total_amount", F.round("total_amount", 2))
