"""Profiling.

Counts, nulls, minimum, maximum and mean of a table come from one map-side
aggregate.  Exact distinct counts read one typed column at a time (values of a
column are compared as what they are, so 0.0 and -0.0 are one), combined
map-side before their shuffle.  Sample values use one per-column top-5 window on
the row order, which Spark limits inside each task before the shuffle.  The
result has one row per column.

A profile can also be kept as states that merge (``profile_state``,
``merge_states``, ``profile_of_state``): counts, sums, extremes, first samples
and a distinct-value sketch of each column, so the profile of new files joins
that of the old ones without reading those again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesmith.functions.casts import kind_of
from lakesmith.sources.tables import ROW_ORDER, with_row_order

# Name patterns and their labels, first match wins.
ID_PATTERN = r"(^|_)id$"
DATE_PATTERN = r"date|_dt$|timestamp"
SEMANTIC_PATTERNS = [
    (ID_PATTERN, "Unique identifier column"),
    (DATE_PATTERN, "Date/time column"),
    (r"price|amount|revenue|total|cost|sales", "Monetary value column"),
    (r"quantity|qty|count", "Quantity/count column"),
    (r"name", "Descriptive name column"),
    (r"region|city|state|country|zone", "Geographic/location column"),
    (r"category|segment|type|method|status", "Categorical grouping column"),
]
NUMERIC_LABEL = "Numeric measure column"
TEXT_LABEL = "Descriptive text column"
NO_ISSUES = "No data quality issues detected."


def _data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != ROW_ORDER]


def _missing(c: Column, dt) -> Column:
    """Missing values: null, and NaN for floating columns (as a plain reader counts them)."""
    return c.isNull() | F.isnan(c) if kind_of(dt) == "float" else c.isNull()


def _plain_stats(tables: dict[str, DataFrame], approx_distinct: bool) -> list[DataFrame]:
    """P1-P5 per table in one aggregate (map-side combined, one row out), keyed
    by ``(t, i)``; distinct counts only where they may be approximate."""
    outs = []
    for number, df in enumerate(tables.values()):
        aggs, structs = [F.count(F.lit(1)).alias("__rows")], []
        for i, f in enumerate(f for f in df.schema.fields if f.name != ROW_ORDER):
            value = F.col(f"`{f.name}`")
            miss = _missing(value, f.dataType)
            d = F.when(~miss, value.cast("double")) if kind_of(f.dataType) in ("integer", "float") else F.lit(None).cast("double")
            aggs += [F.count_if(miss).alias(f"m{i}"), F.min(d).alias(f"lo{i}"), F.max(d).alias(f"hi{i}"), F.avg(d).alias(f"av{i}")]
            if approx_distinct:
                aggs.append(F.approx_count_distinct(F.when(~miss, value)).alias(f"u{i}"))
            structs.append(F.struct(F.lit(i).alias("i"), F.col("__rows").alias("rows"), F.col(f"m{i}").alias("null_count"),
                                    *[F.col(f"u{i}").alias("unique_count")] * approx_distinct,
                                    F.col(f"lo{i}").alias("min_value"), F.col(f"hi{i}").alias("max_value"),
                                    F.col(f"av{i}").alias("mean_value")))
        if structs:
            outs.append(df.agg(*aggs).select(F.lit(number).alias("t"), F.inline(F.array(*structs))))
    return outs


def _groupable(c: Column, dt: T.DataType) -> Column:
    """A column as a grouping key; a map by its sorted entries."""
    return F.array_sort(F.map_entries(c)) if isinstance(dt, T.MapType) else c


def _distinct_counts(tables: dict[str, DataFrame]) -> list[DataFrame]:
    """Exact distinct counts: one branch per column, which reads that column only."""
    out = []
    for number, df in enumerate(tables.values()):
        for i, f in enumerate(f for f in df.schema.fields if f.name != ROW_ORDER):
            value = F.col(f"`{f.name}`")
            present = df.select(F.when(~_missing(value, f.dataType), _groupable(value, f.dataType)).alias("v"))
            out.append(present.where("v is not null").agg(F.count_distinct("v").alias("unique_count"))
                       .select(F.lit(number).alias("t"), F.lit(i).alias("i"), "unique_count"))
    return out


def _column_stats(tables: dict[str, DataFrame], approx_distinct: bool = False) -> DataFrame:
    """P1-P5 of every column of every table, keyed by ``(t, i)``."""
    plain = _plain_stats(tables, approx_distinct)
    if not plain:
        return next(iter(tables.values())).sparkSession.createDataFrame(
            [], "t int, i int, rows long, null_count long, unique_count long, min_value double, "
                "max_value double, mean_value double")
    stats = reduce(DataFrame.unionByName, plain)
    if approx_distinct:
        return stats
    counts = reduce(DataFrame.unionByName, _distinct_counts(tables))
    return stats.join(F.broadcast(counts), ["t", "i"], "left")  # one row per column


def first_values(tables: dict[str, DataFrame], size: int = 5) -> DataFrame | None:
    """The first ``size`` non-null values (row order) of every
    non-numeric column, as ``(dataset, column_name, sample_values)``.

    One window over all tables; Spark limits it to ``size`` rows per column
    inside each task before the shuffle, so only that many rows per column
    per task move.
    """
    parts, names = [], []
    for number, (name, df) in enumerate(tables.items()):
        fields = {f.name: f.dataType for f in df.schema.fields}
        cols = [c for c in _data_columns(df) if kind_of(fields[c]) not in ("integer", "float")]
        if not cols:
            continue
        names += [(name, c) for c in cols]
        df = with_row_order(df)
        pairs = [F.struct(F.lit(name).alias("dataset"), F.lit(c).alias("column_name"),
                          F.col(f"`{c}`").cast("string").alias("v")) for c in cols]
        parts.append(df.select(F.col(ROW_ORDER), F.explode(F.array(*pairs)).alias("p"))
                     .select("p.*", ROW_ORDER))
    if not parts:
        return None
    long = reduce(DataFrame.unionByName, parts).where(F.col("v").isNotNull())
    w = Window.partitionBy("dataset", "column_name").orderBy(ROW_ORDER)
    first = long.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= size)
    return (first.groupBy("dataset", "column_name")
            .agg(F.sort_array(F.collect_list(F.struct("rn", "v"))).alias("s"))
            .select("dataset", "column_name", F.transform("s", lambda x: x["v"]).alias("sample_values")))


def profile_tables(tables: dict[str, DataFrame], sample_size: int = 5,
                   approx_distinct: bool = False, materialize: bool = True) -> DataFrame:
    """Long profile: one row per (dataset, column) with P1-P6.

    The profile has one row per column, so by default it is computed once
    and kept as a small local table; labels, join keys, notes and rules
    derived from it then cost nothing more.  ``materialize=False`` keeps it
    lazy (computed when written or read).
    """
    stats = _column_stats(tables, approx_distinct)
    meta = schema_profile(tables).withColumnRenamed("dataset_no", "t").withColumn("i", F.col("ordinal"))
    joined = meta.join(F.broadcast(stats), ["t", "i"], "left")  # stats: one row per column
    rows = F.coalesce(F.max("rows").over(Window.partitionBy("t")), F.lit(0)).cast("long")
    nulls = F.coalesce(F.col("null_count"), F.lit(0)).cast("long")
    out = joined.select(
        "dataset", F.col("t").alias("dataset_no"), rows.alias("rows"), "columns", "column_name", "ordinal",
        "dtype", "kind", nulls.alias("null_count"),
        F.when(rows > 0, F.round(nulls * 100.0 / rows, 2)).alias("null_pct"),
        F.coalesce(F.col("unique_count"), F.lit(0)).cast("long").alias("unique_count"),
        "min_value", "max_value", "mean_value")
    samples = first_values(tables, sample_size)
    if samples is not None:
        out = out.join(F.broadcast(samples), ["dataset", "column_name"], "left")  # one row per column
    else:
        out = out.withColumn("sample_values", F.lit(None).cast("array<string>"))
    if not materialize:
        return out
    return out.sparkSession.createDataFrame(out.collect(), out.schema)


# -- profiles that merge -----------------------------------------------------------

#: Precision of the distinct-value sketch: 2^this registers, about 0.8 % relative error.
SKETCH_PRECISION = 14


def _sketchable(c: Column, dt: T.DataType) -> Column:
    """Equal values, and only they, get equal texts: zeros of both signs are
    one, instants do not depend on the session's zone."""
    kind = kind_of(dt)
    if kind == "float":
        return F.when(c == 0, F.lit("0")).otherwise(c.cast("string"))
    if kind == "datetime":
        return F.unix_micros(c.cast("timestamp")).cast("string")
    if isinstance(dt, (T.MapType, T.ArrayType, T.StructType)):
        return F.to_json(F.struct(_groupable(c, dt).alias("v")))
    return c.cast("string")


def profile_state(tables: dict[str, DataFrame], sample_size: int = 5) -> DataFrame:
    """One row per (dataset, column) whose fields merge: see ``merge_states``."""
    outs = []
    for name, df in tables.items():
        df = with_row_order(df)
        aggs, structs = [F.count(F.lit(1)).alias("__rows")], []
        for i, f in enumerate(f for f in df.schema.fields if f.name != ROW_ORDER):
            value, kind = F.col(f"`{f.name}`"), kind_of(f.dataType)
            miss = _missing(value, f.dataType)
            d = F.when(~miss, value.cast("double")) if kind in ("integer", "float") else F.lit(None).cast("double")
            aggs += [F.count_if(miss).alias(f"m{i}"), F.min(d).alias(f"lo{i}"), F.max(d).alias(f"hi{i}"), F.sum(d).alias(f"s{i}"),
                     F.hll_sketch_agg(F.when(~miss, _sketchable(value, f.dataType)), SKETCH_PRECISION).alias(f"u{i}")]
            structs.append(F.struct(
                F.lit(f.name).alias("column_name"), F.lit(i).alias("ordinal"), F.lit(f.dataType.simpleString()).alias("dtype"),
                F.lit(kind).alias("kind"), F.col("__rows").alias("rows"), F.col(f"m{i}").alias("null_count"),
                F.col(f"lo{i}").alias("min_value"), F.col(f"hi{i}").alias("max_value"), F.col(f"s{i}").alias("sum_value"),
                F.col(f"u{i}").alias("distinct_sketch")))
        if structs:
            outs.append(df.agg(*aggs).select(F.lit(name).alias("dataset"), F.inline(F.array(*structs))))
    state = reduce(DataFrame.unionByName, outs)
    samples = first_values(tables, sample_size)
    if samples is None:
        return state.withColumn("sample_values", F.lit(None).cast("array<string>"))
    return state.join(F.broadcast(samples), ["dataset", "column_name"], "left")  # one row per column


def merge_states(*states: DataFrame, sample_size: int = 5) -> DataFrame:
    """The state of all rows of several states; earlier ones hold the earlier
    rows.  A column that a state lacks is missing in all of that state's rows."""
    numbered = reduce(DataFrame.unionByName, [s.withColumn("__no", F.lit(i)) for i, s in enumerate(states)])
    rows = numbered.groupBy("dataset", "__no").agg(F.max("rows").alias("rows")).groupBy("dataset").agg(F.sum("rows").alias("__all"))
    first = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("__no", F.coalesce("sample_values", F.array().cast("array<string>")).alias("v")))),
                                  lambda x: x["v"]))
    merged = numbered.groupBy("dataset", "column_name").agg(
        F.min_by("ordinal", "__no").alias("ordinal"), F.min_by("dtype", "__no").alias("dtype"), F.min_by("kind", "__no").alias("kind"),
        F.sum(F.col("rows") - F.col("null_count")).alias("__present"), F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"), F.sum("sum_value").alias("sum_value"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"), F.slice(first, 1, sample_size).alias("sample_values"))
    return merged.join(F.broadcast(rows), "dataset").select(  # one row per table
        "dataset", "column_name", "ordinal", "dtype", "kind", F.col("__all").alias("rows"),
        (F.col("__all") - F.col("__present")).alias("null_count"), "min_value", "max_value", "sum_value", "distinct_sketch",
        F.when(~F.col("kind").isin("integer", "float"), F.col("sample_values")).alias("sample_values"))


def profile_of_state(state: DataFrame) -> DataFrame:
    """The profile that a state stands for; distinct counts are estimates."""
    present = F.col("rows") - F.col("null_count")
    return state.select(
        "dataset", "column_name", "ordinal", "dtype", "kind", "rows", "null_count",
        F.when(F.col("rows") > 0, F.round(F.col("null_count") * 100.0 / F.col("rows"), 2)).alias("null_pct"),
        F.coalesce(F.hll_sketch_estimate("distinct_sketch"), F.lit(0)).alias("unique_count"), "min_value", "max_value",
        F.when(present > 0, F.col("sum_value") / present).alias("mean_value"), "sample_values")


def write_profile(profile: DataFrame, path: str) -> None:
    """Profile sink (S5): one JSON document per column row, one file per run."""
    profile.coalesce(1).write.mode("overwrite").json(path)


def schema_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """The schema part of the profile only (no data scan): enough for rule generation."""
    spark = next(iter(tables.values())).sparkSession
    rows = []
    for number, (name, df) in enumerate(tables.items()):
        cols = [f for f in df.schema.fields if f.name != ROW_ORDER]
        rows += [(name, number, len(cols), f.name, i, f.dataType.simpleString(), kind_of(f.dataType))
                 for i, f in enumerate(cols)]
    return spark.createDataFrame(rows, "dataset string, dataset_no int, columns int, column_name string, "
                                       "ordinal int, dtype string, kind string")


def semantic_label(name: Column, kind: Column) -> Column:
    """First matching name pattern, else numeric/text by kind."""
    low = F.lower(name)
    expr = F.when(kind.isin("integer", "wide", "float"), F.lit(NUMERIC_LABEL)).otherwise(F.lit(TEXT_LABEL))
    for pattern, label in reversed(SEMANTIC_PATTERNS):
        expr = F.when(low.rlike(pattern), F.lit(label)).otherwise(expr)
    return expr


def semantic_labels(profile: DataFrame) -> DataFrame:
    return profile.select("dataset", "column_name", "ordinal",
                          semantic_label(F.col("column_name"), F.col("kind")).alias("semantic_label"))


def join_keys(profile: DataFrame) -> DataFrame:
    """Same-named columns in every dataset pair; 'high' when id-like."""
    left = profile.select(F.col("dataset").alias("left_dataset"), F.col("dataset_no").alias("ln"),
                          F.col("column_name"))
    right = profile.select(F.col("dataset").alias("right_dataset"), F.col("dataset_no").alias("rn"),
                           F.col("column_name"))
    pairs = left.join(right, "column_name").where(F.col("ln") < F.col("rn"))
    conf = F.when(F.lower("column_name").rlike(ID_PATTERN), F.lit("high")).otherwise(F.lit("medium"))
    return pairs.select("left_dataset", F.col("column_name").alias("left_column"), "right_dataset",
                        F.col("column_name").alias("right_column"), conf.alias("confidence"), "ln", "rn")


def num_text(c: Column) -> Column:
    """Shortest text of a double, plain from 1e-4 up to 1e16 (``-994.28``,
    ``100.0``), with an exponent beyond (``1.5e-07``)."""
    shortest = c.cast("string")
    plain = F.regexp_replace(F.regexp_replace(shortest.cast("decimal(38,21)").cast("string"), "0+$", ""), r"\.$", ".0")
    power = F.regexp_extract(shortest, r"E(-?)(\d+)$", 2)
    exponent = F.concat(F.regexp_replace(F.substring_index(shortest, "E", 1), r"\.0$", ""), F.lit("e"),
                        F.when(shortest.contains("E-"), "-").otherwise("+"),
                        F.when(F.length(power) < 2, F.lpad(power, 2, "0")).otherwise(power))
    in_range = (F.abs(c) >= 1e-4) & (F.abs(c) < 1e16)
    return (F.when(c == 0, F.lit("0.0")).when(in_range, plain).when(shortest.contains("E"), exponent)
            .otherwise(shortest))


def quality_notes(profile: DataFrame) -> DataFrame:
    """Null and negative-value notes; one default row when there are none."""
    nulls = profile.where(F.col("null_pct") > 0).select(
        "dataset", "dataset_no", "column_name", "ordinal", F.lit(0).alias("note_kind"),
        F.format_string("%s.%s: %s%% null values", "dataset", "column_name", num_text(F.col("null_pct"))).alias("note"))
    negative = profile.where(F.col("min_value") < 0).select(
        "dataset", "dataset_no", "column_name", "ordinal", F.lit(1).alias("note_kind"),
        F.format_string("%s.%s: contains negative values (min=%s)", "dataset", "column_name",
                        num_text(F.col("min_value"))).alias("note"))
    notes = nulls.unionByName(negative)
    found = notes.agg(F.count(F.lit(1))).scalar()
    default = profile.sparkSession.range(1).where(found == 0).select(
        F.lit(None).cast("string").alias("dataset"), F.lit(None).cast("int").alias("dataset_no"),
        F.lit(None).cast("string").alias("column_name"), F.lit(None).cast("int").alias("ordinal"),
        F.lit(2).alias("note_kind"), F.lit(NO_ISSUES).alias("note"))
    return notes.unionByName(default)
