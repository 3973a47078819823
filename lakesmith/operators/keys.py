"""Sequential surrogate keys 1..n in a given order.

In row order (Silver), ``number_in_row_order`` needs no file of its own: rows
are counted in blocks of neighbouring positions, a running sum over the blocks
tells how many rows stand before each, and a row's number follows from its place
in its block.  Both passes see the same positions, so a recomputed task gives
the same numbers.  In any other order (Gold):

A global ``row_number()`` window pulls every row into one partition.
Instead the rows are range-partitioned on the full order (which always
ends in a unique row-order column, so a hot key value can still be split
across partitions), sorted inside each partition, and numbered locally.
The partitioned, locally numbered rows are written as Parquet under the
shared ``spark.checkpoint.dir`` and read back, which fixes the numbering
(a lost executor cannot renumber) and cuts lineage; the per-partition row
counts (one row per partition, a bound known before the job, read from a
single column) become start offsets that are broadcast back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakesmith.sources.tables import ROW_ORDER
from lakesmith.session import discard_at_exit, ensure_checkpoint_dir, scratch_path

#: Bits of the positions in one block (65,536 of them).
BLOCK_BITS = 16
_P, _I, _OFF = "__part", "__local", "__offset"


def number_rows(df: DataFrame, name: str, order: list[str], keep: list[str] | None = None,
                partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 1..n following the columns ``order`` (ascending, nulls
    last) as the first column, followed by ``keep`` (default: all columns).

    Only ``keep`` and the order columns are carried into the checkpoint.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    keep = list(df.columns if keep is None else keep)
    carried = keep + [c for c in order if c not in keep]
    sort = [F.col(f"`{c}`").asc_nulls_last() for c in order]
    # Without an explicit count the range shuffle starts from the session's
    # partition count and adaptive execution may merge adjacent small ranges;
    # merged ranges stay contiguous and in order, so the numbering is unchanged.
    by = (partitions,) if partitions else ()
    ranged = df.select(*[F.col(f"`{c}`") for c in carried]).repartitionByRange(*by, *sort).sortWithinPartitions(*sort)
    part = F.spark_partition_id().cast("long")
    path = scratch_path(spark, "keys")
    (ranged.withColumn(_P, part)
     .withColumn(_I, F.monotonically_increasing_id() - F.shiftleft(part, 33))
     .write.parquet(path))
    discard_at_exit(spark, path)
    tagged = spark.read.parquet(path)  # fixed numbering, lineage cut
    sizes = tagged.groupBy(_P).agg(F.count(F.lit(1)).alias("__n"))  # reads one column
    offsets = sizes.select(_P, (F.sum("__n").over(Window.orderBy(_P)) - F.col("__n")).alias(_OFF))
    numbered = tagged.join(F.broadcast(offsets), _P)  # at most `n` rows: bounded by the partition count
    return numbered.select((F.col(_OFF) + F.col(_I) + 1).cast("long").alias(name),
                           *[F.col(f"`{c}`") for c in keep])


def number_in_row_order(df: DataFrame, name: str, keep: list[str]) -> DataFrame:
    """Add ``name`` = 1..n in row order as the first column, followed by ``keep``.

    A block holds the rows of one file whose positions share all but the lowest
    ``BLOCK_BITS`` bits, so every window below is bounded by that, by the blocks
    of a file or by the number of files.
    """
    file, pos = F.col(ROW_ORDER)["file"].alias("__file"), F.col(ROW_ORDER)["pos"].alias("__pos")
    block = F.shiftright("__pos", BLOCK_BITS).alias("__block")
    rows = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)], file, pos).select("*", block)
    blocks = df.select(file, pos).select("__file", block).groupBy("__file", "__block").agg(F.count(F.lit(1)).alias("__n"))
    files = blocks.groupBy("__file").agg(F.sum("__n").alias("__rows"))
    before = files.select("__file", (F.sum("__rows").over(Window.orderBy("__file")) - F.col("__rows")).alias("__base"))
    in_file = F.sum("__n").over(Window.partitionBy("__file").orderBy("__block")) - F.col("__n")
    offsets = blocks.select("__file", "__block", in_file.alias("__skipped")).join(before, "__file").select(
        "__file", "__block", (F.col("__base") + F.col("__skipped")).alias(_OFF))
    place = F.row_number().over(Window.partitionBy("__file", "__block").orderBy("__pos"))
    return rows.join(offsets, ["__file", "__block"]).select(
        (F.col(_OFF) + place).cast("long").alias(name), *[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)])
