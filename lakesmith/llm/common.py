"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesmith.session import discard_at_exit, ensure_checkpoint_dir, scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    Cuts lineage and fixes the rows: a lost executor rereads files instead of
    recomputing.  Parquet (compressed, column-pruned) is used where the rows are
    wide; narrow loops use ``checkpoint()``.  The files go when the application
    ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{label}")
    df.write.parquet(path)
    discard_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def finished(df: DataFrame, label: str) -> DataFrame:
    """``staged``, and the shuffle files of the finished query may go.

    Spark deletes them when nothing refers to the query any more; asking for
    that now keeps one phase's files from adding to the next one's.
    """
    out = staged(df, label)
    del df  # callers pass the query on without keeping it
    for _ in range(2):  # the first round may come before the session has let go of the query
        gc.collect()
        out.sparkSession._jvm.System.gc()
        time.sleep(0.2)
    return out


def checkpointed(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def col(name: str) -> Column:
    """Column by exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def kept_columns(df: DataFrame, added: list[str]) -> list[str]:
    """Input columns that an operator passes on: those it does not add itself.

    An input column whose name equals an added one (case aside) is replaced.
    """
    taken = {a.lower() for a in added}
    return [c for c in df.columns if c.lower() not in taken]


def text_of(name: str = "text") -> Column:
    return F.coalesce(col(name).cast("string"), F.lit(""))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, UPPER.lower())


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also inside other lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def document_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """A document's identity where rows must be joined back: id and text digest.

    Rows that repeat both are the same document and share one result, so no
    unstable row number is needed and a hot repeated row never multiplies.
    """
    return [col(doc_id).alias("__id"), F.xxhash64(text_of(text)).alias("__th")]
