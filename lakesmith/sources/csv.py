"""Raw CSV source.

Every value is read as text; the usual spreadsheet null spellings become
null; then one aggregate over the whole file decides each column's type
(integer, float, boolean or text) by counting values that fail to parse.
The cast itself is a single ``select``.  Spark accepts one ``nullValue``
only, hence the explicit normalisation step.

Quoted fields may span lines, as a plain reader allows; Spark reads such files
whole, one task each.  ``multi_line="auto"`` splits them all the same:

* a scan of the lines proves that every line is whole records (then Spark's own
  line-wise reader gives the same), or
* each split of a file counts its quotes; running sums over the splits tell for
  every line whether it begins inside a quoted field; lines of one record are
  joined and each record is parsed by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakesmith.functions.casts import INT_TEXT, is_number_text
from lakesmith.sources.tables import ROW_ORDER, row_order_from_metadata

# The text spellings a CSV reader treats as missing by default.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]

# Boolean spellings recognised when inferring a column type.
TRUE_TOKENS = ["True", "TRUE", "true"]
FALSE_TOKENS = ["False", "FALSE", "false"]

#: Type of whole numbers beyond 64 bits; longer ones stay text.
WIDE_INTEGER = "decimal(38,0)"


# A line of whole records: quotes only around fields and doubled inside them.
_WHOLE_LINE = r'^(?:"(?:[^"]|"")*+"|[^",]*+)(?:,(?:"(?:[^"]|"")*+"|[^",]*+))*+\r?$'


def read_raw_csv(spark: SparkSession, path: str, multi_line: bool | str = "auto") -> DataFrame:
    """All-text scan with header.

    ``multi_line``: True reads quoted fields that span lines and takes one task
    a file; False lets Spark split files known to hold one record per line by
    ``spark.sql.files.maxPartitionBytes``; "auto" finds out which lines belong
    together and splits in either case.
    """
    if multi_line == "auto":
        lines = spark.read.text(path)
        odd = lines.where(~F.col("value").rlike(_WHOLE_LINE)).limit(1).count()
        if odd:
            joined = _joined_records(spark, path)
            if joined is not None:
                return joined
        multi_line = bool(odd)
    df = (spark.read.option("header", True).option("multiLine", multi_line)
          .option("escape", '"').option("inferSchema", False).csv(path))
    return df.select(*_without_null_tokens(df.columns), row_order_from_metadata("csv").alias(ROW_ORDER))


def _without_null_tokens(columns: list[str]) -> list[Column]:
    return [F.when(~F.col(f"`{c}`").isin(NULL_TOKENS), F.col(f"`{c}`")).alias(c) for c in columns]


def _joined_records(spark: SparkSession, path: str) -> DataFrame | None:
    """Records of files whose quoted fields span lines, each file read in many tasks.

    None where a quote stands inside an unquoted field: counting quotes cannot
    follow that, and Spark's whole-file reader has to.
    """
    meta = F.col("_metadata")
    raw = spark.read.option("lineSep", "\n").text(path).select(
        "value", meta["file_path"].alias("file"), meta["file_block_start"].alias("split"), F.monotonically_increasing_id().alias("at"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    in_split = Window.partitionBy("file", "split").orderBy("at")
    # quotes of the splits before each split: one row a split
    splits = raw.groupBy("file", "split").agg(F.sum(quotes).alias("n"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    before = splits.select("file", "split", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    upto = F.col("base") + F.sum("quotes").over(in_split)
    lines = raw.withColumn("quotes", quotes).join(before, ["file", "split"]).select(
        "file", "split", "at", "value", (F.col("split") + F.row_number().over(in_split)).alias("pos"),
        ((upto - F.col("quotes")) % 2 == 1).alias("inside"), (upto % 2 == 1).alias("open"))
    # single lines are records; the others join the last line before them that begins one, in their split or an earlier one
    begins = F.when(F.col("open") & ~F.col("inside"), F.col("pos"))
    last = lines.groupBy("file", "split").agg(F.max(begins).alias("last")).select(
        "file", "split", F.max("last").over(earlier).alias("carried"))
    placed = lines.withColumn("own", F.max(begins).over(in_split)).join(last, ["file", "split"])
    alone = placed.where("not inside and not open").select("file", "pos", F.col("value").alias("record"))
    joined = placed.where("inside or open").groupBy("file", F.coalesce("own", "carried").alias("pos")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col("pos").alias("p"), "value"))), lambda x: x["value"]), "\n")
        .alias("record"))
    records = alone.unionByName(joined).withColumn("record", F.regexp_replace("record", "\r$", ""))
    whole = F.col("pos").isNotNull() & F.col("record").rlike("(?s)" + _WHOLE_LINE)
    if records.where(~whole | ((F.col("pos") == 1) & (F.col("record") == ""))).limit(1).count():
        return None
    names = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).columns
    fields = F.from_csv("record", F.lit(", ".join(f"c{i} string" for i in range(len(names)))), {"escape": '"', "multiLine": "true"})
    # the first line of a file stands at position 1 and is its header
    return (records.where("record <> '' and pos > 1").select(fields.alias("r"), F.struct("file", "pos").alias(ROW_ORDER))
            .select(*[F.col(f"r.c{i}").alias(c) for i, c in enumerate(names)], ROW_ORDER)
            .select(*_without_null_tokens(names), ROW_ORDER))


def infer_types(df: DataFrame) -> dict[str, str]:
    """One aggregate pass: column -> 'bigint' | 'decimal(38,0)' | 'double' |
    'boolean' | 'string', by counting the values that each type can hold."""
    data_cols = [c for c in df.columns if c != ROW_ORDER]
    aggs = []
    for i, c in enumerate(data_cols):
        col = F.col(f"`{c}`")
        aggs += [
            F.count(col).alias(f"n{i}"),
            F.count_if(col.rlike(INT_TEXT)).alias(f"i{i}"),
            F.count_if(col.rlike(INT_TEXT) & F.trim(col).try_cast("bigint").isNotNull()).alias(f"l{i}"),
            F.count_if(col.rlike(INT_TEXT) & F.trim(col).try_cast(WIDE_INTEGER).isNotNull()).alias(f"w{i}"),
            F.count_if(is_number_text(col)).alias(f"f{i}"),
            F.count_if(col.isin(TRUE_TOKENS + FALSE_TOKENS)).alias(f"b{i}"),
        ]
    if not aggs:
        return {}
    row = df.agg(*aggs).first()
    types = {}
    for i, c in enumerate(data_cols):
        n = row[f"n{i}"]
        if n == 0:
            types[c] = "double"  # an all-missing column reads as float
        elif row[f"i{i}"] == n:  # the narrowest type that loses no digit
            types[c] = "bigint" if row[f"l{i}"] == n else WIDE_INTEGER if row[f"w{i}"] == n else "string"
        elif row[f"f{i}"] == n:
            types[c] = "double"
        elif row[f"b{i}"] == n:
            types[c] = "boolean"
        else:
            types[c] = "string"
    return types


def apply_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    out = []
    for c in df.columns:
        col = F.col(f"`{c}`")
        t = types.get(c)
        if t in ("bigint", "double", WIDE_INTEGER):
            out.append(F.expr(f"try_cast(trim(`{c}`) as {t})").alias(c))
        elif t == "boolean":
            out.append(F.when(col.isin(TRUE_TOKENS), F.lit(True))
                       .when(col.isin(FALSE_TOKENS), F.lit(False)).alias(c))
        else:
            out.append(col)
    return df.select(*out)


def read_csv_table(spark: SparkSession, path: str, schema: dict[str, str] | None = None,
                   multi_line: bool | str = "auto") -> DataFrame:
    """Typed CSV table: explicit ``schema`` wins, else one inference pass."""
    raw = read_raw_csv(spark, path, multi_line)
    return apply_types(raw, schema if schema is not None else infer_types(raw))
