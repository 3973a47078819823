"""Silver layer (V1-V18), including the paths the reference leaves untested."""

import datetime as dt

from lakesmith.operators import rules, silver


def _run(spark, df, spec, name="test_bronze"):
    r = rules.rules_from_rows(spark, [{"source_table": name, "source_column": c, "target_column": c,
                                       "transformation_logic": lg} for c, lg in spec])
    out = silver.execute_silver({name: df}, r)
    return out[name.replace("_bronze", "") + "_silver"]


def test_passthrough_two_rows(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 20.0)], "id long, value double")
    assert _run(spark, df, [("id", "keep"), ("value", "keep")]).count() == 2


def test_mean_fill(spark):
    df = spark.createDataFrame([(1, 10.0), (2, None), (3, 30.0)], "id long, value double")
    out = _run(spark, df, [("id", "keep"), ("value", "Fill null values with mean")])
    assert sorted(r["value"] for r in out.collect()) == [10.0, 20.0, 30.0]


def test_mean_fill_promotes_integer_column(spark):
    df = spark.createDataFrame([(1, 1), (2, None), (3, 2)], "id long, value long")
    out = _run(spark, df, [("id", "keep"), ("value", "Fill null values with mean")])
    assert dict(out.dtypes)["value"] == "double"
    assert sorted(r["value"] for r in out.collect()) == [1.0, 1.5, 2.0]


def test_median_fill_even_count(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 4.0), (4, 2.0), (5, 10.0)], "id long, v double")
    out = _run(spark, df, [("id", "keep"), ("v", "Fill null with median")])
    assert [r["v"] for r in out.orderBy("id").collect()][1] == 3.0


def test_mode_fill_ties_to_smallest_and_all_null_unchanged(spark):
    df = spark.createDataFrame([(1, "b", None), (2, "a", None), (3, None, None), (4, "b", None), (5, "a", None)],
                               "id long, s string, e string")
    out = _run(spark, df, [("id", "keep"), ("s", "Fill null values with mode"), ("e", "Fill null with mode")])
    got = {r["id"]: (r["s"], r["e"]) for r in out.collect()}
    assert got[3] == ("a", None)


def test_dedup_keeps_first(spark):
    df = spark.createDataFrame([(1, 5.0), (1, 6.0), (2, 6.0)], "id long, value double")
    out = _run(spark, df, [("id", "keep"), ("value", "keep"), ("id", "Deduplicate rows based on id")])
    assert sorted((r["id"], r["value"]) for r in out.collect()) == [(1, 5.0), (2, 6.0)]


def test_dedup_whole_row_when_column_missing(spark):
    df = spark.createDataFrame([(1, 5.0), (1, 5.0), (2, 6.0)], "id long, value double")
    out = _run(spark, df, [("id", "keep"), ("value", "keep"), ("nope", "Deduplicate rows")])
    assert out.count() == 2


def test_dedup_null_keys_equal(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), (3, 3.0)], "k long, v double")
    out = _run(spark, df, [("k", "keep"), ("v", "keep"), ("k", "Deduplicate rows based on k")])
    assert sorted((r["k"] is None, r["v"]) for r in out.collect()) == [(False, 3.0), (True, 1.0)]


def test_drop_null(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None)], "id long, v double")
    assert _run(spark, df, [("id", "keep"), ("v", "Drop null values")]).count() == 1


def test_blank_fill_only_for_text(spark):
    df = spark.createDataFrame([(1, None, None)], "id long, s string, n double")
    out = _run(spark, df, [("id", "keep"), ("s", "Fill null with default"), ("n", "fill null")]).collect()[0]
    assert out["s"] == "" and out["n"] is None


def test_surrogate_key_is_first_and_sequential(spark):
    df = spark.createDataFrame([("W1",), ("W2",), ("W3",)], "widget_id string")
    out = _run(spark, df, [("widget_id", "keep")], name="widgets_bronze")
    assert out.columns[0] == "pk_widgets_bronze_silver_id"
    assert sorted(r[0] for r in out.collect()) == [1, 2, 3]


def test_key_name_from_rule_when_present(spark):
    df = spark.createDataFrame([("W1",)], "widget_id string")
    r = rules.rules_from_rows(spark, [
        {"source_table": "widgets_bronze", "target_column": "pk_widgets_silver_id",
         "transformation_logic": rules.PK_TEXT},
        {"source_table": "widgets_bronze", "source_column": "widget_id", "target_column": "widget_id",
         "transformation_logic": "keep"}])
    out = silver.execute_silver({"widgets_bronze": df}, r)["widgets_silver"]
    assert out.columns[0] == "pk_widgets_silver_id"


def test_dates_first_matching_format_wins(spark):
    df = spark.createDataFrame([(1, "13/03/2024"), (2, "2024-03-14"), (3, "05/03/2024")], "id long, d string")
    out = _run(spark, df, [("id", "keep"), ("d", "Standardise date format")])
    got = {r["id"]: r["d"] for r in out.collect()}
    # format 1 (year first) parses row 2, so it is used for the whole column
    assert got[2] == dt.datetime(2024, 3, 14) and got[1] is None and got[3] is None


def test_dates_day_first_before_month_first(spark):
    df = spark.createDataFrame([(1, "05/03/2024")], "id long, d string")
    out = _run(spark, df, [("id", "keep"), ("d", "convert to date")])
    assert out.collect()[0]["d"] == dt.datetime(2024, 3, 5)


def test_case_and_strip(spark):
    df = spark.createDataFrame([(1, "o'neil-smith 3rd", "\t Mixed Case \n", "abc")], "id long, t string, s string, u string")
    out = _run(spark, df, [("id", "keep"), ("t", "Convert to title case"), ("s", "strip whitespace; lowercase"),
                           ("u", "uppercase")]).collect()[0]
    assert out["t"] == "O'Neil-Smith 3Rd"
    assert out["s"] == "mixed case"
    assert out["u"] == "ABC"


def test_id_text_cast_prints_whole_numbers(spark):
    df = spark.createDataFrame([(1.0,), (2.5,)], "order_id double")
    out = _run(spark, df, [("order_id", rules.SILVER_ID)])
    assert sorted(r["order_id"] for r in out.collect()) == ["1", "2.5"]


def test_generated_rules_cost_one_statistics_pass(spark):
    from lakesmith.operators.staging import Stage
    from lakesmith.operators.silver import fill_nulls
    df = spark.createDataFrame([(1, 2.0, "a"), (2, None, None)], "id long, v double, s string")
    st = Stage(df)
    fill_nulls(st, "v", "mean")
    fill_nulls(st, "s", "blank")
    st.frame()
    assert st.jobs == 1


def _hot_rows(n=3000):
    """Key 7 holds a third of the rows, the null key another tenth."""
    rows = []
    for i in range(n):
        k = 7 if i % 3 == 0 else (None if i % 10 == 1 else i % 97)
        rows.append((i, k, f"t{i % 13}"))
    return rows


def test_keep_first_hot_key_matches_brute_force(spark):
    import pandas as pd

    from lakesmith.sources.tables import ROW_ORDER
    rows = _hot_rows()
    df = spark.createDataFrame(rows, "seq long, k long, tag string").repartition(6)
    df = df.withColumn(ROW_ORDER, df["seq"])  # row order = original position
    out = silver.keep_first(df, ["k"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    # each task keeps its own first row of a key before the one shuffle
    assert "row_number(), 1, Partial" in plan and plan.count("Exchange hashpartitioning") == 1
    got = sorted(((r["k"], r["seq"], r["tag"]) for r in out.collect()), key=repr)
    pdf = pd.DataFrame(rows, columns=["seq", "k", "tag"]).astype({"k": "Int64"})
    want = sorted(((None if pd.isna(k) else int(k), int(s), t)
                   for s, k, t in pdf.drop_duplicates(subset=["k"], keep="first").itertuples(index=False)),
                  key=repr)
    assert got == want


def test_sequential_keys_hot_order_key_match_brute_force(spark):
    from lakesmith.operators.keys import number_rows
    rows = _hot_rows()
    df = spark.createDataFrame(rows, "seq long, k long, tag string").repartition(6)
    out = number_rows(df, "pk", ["k", "seq"], ["seq", "k", "tag"], partitions=8)
    plan = out._jdf.queryExecution().executedPlan().toString()
    # the only single-partition step is the offsets window over one count row per partition
    lines = plan.splitlines()
    singles = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    assert singles and all("HashAggregate(keys=[__part" in lines[i + 1] for i in singles)
    got = [(r["pk"], r["seq"]) for r in out.orderBy("pk").collect()]
    order = sorted(rows, key=lambda r: (r[1] is None, r[1] if r[1] is not None else 0, r[0]))
    assert got == [(i + 1, r[0]) for i, r in enumerate(order)]
    hot = sorted(r["pk"] for r in out.where("k = 7").select("pk").collect())
    n_hot = sum(1 for r in rows if r[1] == 7)
    assert n_hot >= len(rows) // 3 and hot == list(range(hot[0], hot[0] + n_hot))  # consecutive numbers


def test_strip_characters_are_plain_whitespace(spark):
    """The strip set is exactly what ``str.strip()`` removes, and stripping
    keeps inner whitespace, empties blank text and keeps null."""
    from pyspark.sql import functions as F

    from lakesmith.functions.text import WS_CHARS, strip_ws
    assert set(WS_CHARS) == {chr(c) for c in range(0x110000) if chr(c).isspace()}
    samples = [" \t a  b 　\n", "\x1c\x85x ", "   ", "", "no-edges", None, "​zero-width​"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "i int, s string")
    got = [r["o"] for r in df.select(strip_ws(F.col("s")).alias("o")).orderBy(F.col("i")).collect()]
    assert got == [None if s is None else s.strip() for s in samples]


def test_sequential_keys_exact_when_ranges_are_merged(spark):
    """Adaptive execution merges adjacent small ranges; the numbering stays 1..n in order."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from lakesmith.operators.keys import number_rows
    confs = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
             "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    prev = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(400_000).select(
            F.col("id").alias("seq"),
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.xxhash64("id") % 10007).alias("k"),
            F.sha2(F.col("id").cast("string"), 256).alias("pad"))
        out = number_rows(df, "pk", ["k", "seq"], ["seq", "k"])
        numbered_dir = out.inputFiles()[0].rsplit("/", 1)[0]  # the checkpointed, locally numbered rows
        parts = spark.read.parquet(numbered_dir).select("__part").distinct().count()
        assert 1 < parts < 32  # ranges were merged, but not into one
        want = df.select("seq", F.row_number().over(Window.orderBy(F.col("k").asc_nulls_last(), "seq")).alias("w"))
        assert out.join(want, "seq").where(F.col("pk") != F.col("w")).count() == 0
        assert out.count() == 400_000
    finally:
        for k, v in prev.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
