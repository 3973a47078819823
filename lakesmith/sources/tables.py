"""Table sources and layer sinks (S2, S3, S9) and the row-order column.

Row order is part of the data model (keep-first dedup, sequential keys,
first samples), but a DataFrame has none.  ``_row_order`` records it right
at the scan as ``struct(file, pos)``: the file path and, for Parquet, the
row index inside that file.  Both are properties of the stored data, so a
recomputed partition after a lost executor yields the same values.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesmith.session import ensure_checkpoint_dir

ROW_ORDER = "_row_order"
# Plan operators that may deal rows out in another order when they run again.
_SHUFFLED = re.compile(r"\b(Aggregate|Join|Repartition\w*|RebalancePartitions|Sort|Window|Distinct|Intersect|Except|Sample|"
                       r"MapInPandas|MapInArrow|FlatMapGroups\w*)\b")


def row_order_from_metadata(kind: str = "parquet") -> Column:
    """``struct(file, pos)`` taken from the hidden file metadata."""
    pos = F.col("_metadata.row_index") if kind == "parquet" else F.monotonically_increasing_id()
    return F.struct(F.col("_metadata.file_path").alias("file"), pos.cast("long").alias("pos"))


def with_row_order(df: DataFrame) -> DataFrame:
    """Attach ``_row_order`` to a DataFrame that has none.

    The position comes from the partition layout (tables read from files carry
    their own).  Operators may evaluate their input more than once, so rows that
    were shuffled on the way, and could come in another order the next time, are
    checkpointed first.
    """
    if ROW_ORDER in df.columns:
        return df
    if _SHUFFLED.search(df._jdf.queryExecution().optimizedPlan().toString()):
        ensure_checkpoint_dir(df.sparkSession)
        df = df.checkpoint()
    return df.withColumn(ROW_ORDER, F.struct(F.lit("").alias("file"),
                                             F.monotonically_increasing_id().alias("pos")))


def read_table(spark: SparkSession, path: str, keep_order: bool = True, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan (S2) with ``_row_order`` from file path and row index; a
    known ``schema`` saves reading file footers."""
    df = (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    if keep_order:
        df = df.select("*", row_order_from_metadata("parquet").alias(ROW_ORDER))
    return df


def table_name(path: str) -> str:
    base = os.path.basename(path.rstrip("/"))
    for suffix in (".parquet", ".csv"):
        if base.endswith(suffix):
            return base[: -len(suffix)]
    return base


def read_tables(spark: SparkSession, paths: Iterable[str] | Mapping[str, str],
                keep_order: bool = True) -> dict[str, DataFrame]:
    """Many files, one call, keyed by table name (S9).  Lazy: nothing is read yet."""
    items = paths.items() if isinstance(paths, Mapping) else ((table_name(p), p) for p in paths)
    return {name: read_table(spark, p, keep_order) for name, p in items}


def layer_path(root: str, run_id: str, layer: str, table: str) -> str:
    """Run-scoped location of a layer table (fixes shared, overwritten outputs)."""
    return os.path.join(root, layer, run_id, table)


def in_written_order(df: DataFrame) -> DataFrame:
    """A table whose written files hold its rows in row order.

    One source file is scanned in order anyway; several are dealt to tasks by
    size, so their rows are range-partitioned by row order first.
    """
    if ROW_ORDER in df.columns and len(df.inputFiles()) > 1:
        return df.repartitionByRange(ROW_ORDER).sortWithinPartitions(ROW_ORDER)
    return df


def write_layer(tables: Mapping[str, DataFrame], root: str, run_id: str, layer: str) -> tuple[dict[str, str], dict[str, int]]:
    """Parquet sink, overwrite, one directory per table (S3).  Returns the
    paths and the row counts, which the writes themselves observe.

    ``_row_order`` is not published: numbered tables keep their order in the
    key, others in their files.
    """
    paths, rows = {}, {}
    for name in tables:
        df = tables[name]
        paths[name] = layer_path(root, run_id, layer, name)
        seen = Observation()
        (df if _key_of(df.columns) else in_written_order(df)).drop(ROW_ORDER).observe(seen, F.count(F.lit(1)).alias("rows")) \
            .write.mode("overwrite").parquet(paths[name])
        rows[name] = seen.get["rows"]
    return paths, rows


def _key_of(columns: list[str]) -> str | None:
    """The generated key, which comes first."""
    return columns[0] if columns and columns[0].startswith("pk_") else None


def read_layer(spark: SparkSession, paths: Mapping[str, str], ordered: bool = True) -> dict[str, DataFrame]:
    """Read back a written layer, ``ordered`` by its keys or files."""
    out = {}
    for name, path in paths.items():
        df = spark.read.parquet(path)
        if not ordered:
            out[name] = df
            continue
        key = _key_of(df.columns)
        order = F.struct(F.lit("").alias("file"), F.col(f"`{key}`").cast("long").alias("pos")) if key else row_order_from_metadata("parquet")
        out[name] = df.select("*", order.alias(ROW_ORDER))
    return out
