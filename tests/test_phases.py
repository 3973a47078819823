"""End to end (E1-E5) from CSV files, modelled on the reference's orchestrator test."""

import os

from lakesmith.plans import phases
from lakesmith.sources.runlog import read_runlog, read_traces


def _write_csv(path, header, rows):
    with open(path, "w", encoding="utf-8") as f:
        f.write(header + "\n")
        for r in rows:
            f.write(",".join(str(x) for x in r) + "\n")


def test_pipeline_from_csv(spark, tmp_path):
    products = str(tmp_path / "products.csv")
    sales = str(tmp_path / "sales.csv")
    _write_csv(products, "product_id,product_name,category",
               [("P1", "Widget", "Tools"), ("P2", "Gadget", "Tools"), ("P3", "Gizmo", "Toys")])
    _write_csv(sales, "transaction_id,product_id,total_amount",
               [("T1", "P1", 10), ("T2", "P1", 20), ("T3", "P2", 30), ("T4", "P3", 5)])
    root = str(tmp_path / "out")
    state = phases.run(spark, [products, sales], "What is total sales revenue by product category?", root=root)
    assert sorted(state.bronze) == ["products_bronze", "sales_bronze"]
    assert sorted(state.silver) == ["products_silver", "sales_silver"]
    assert list(state.gold) == ["gold_output"]
    got = [(r["category"], r["total_amount"]) for r in state.result.collect()]
    assert got == [("Tools", 60.0), ("Toys", 5.0)]
    assert os.path.isdir(os.path.join(root, "gold", state.run_id, "gold_output"))
    assert os.path.isdir(os.path.join(root, "answers", state.run_id))
    assert spark.read.json(os.path.join(root, "profiles", state.run_id)).count() == 6
    log = read_runlog(spark, os.path.join(root, "runlog"), state.run_id)
    assert log.where("action = 'pipeline_completed'").count() == 1
    # Gold files hold no row order; analysis, shapes, rule reports, traces and documents are there
    assert "_row_order" not in spark.read.parquet(state.paths["gold"]["gold_output"]).columns
    labels = spark.read.json(os.path.join(root, "analysis", state.run_id, "semantic_labels"))
    assert labels.count() == 6
    keys = spark.read.json(os.path.join(root, "analysis", state.run_id, "join_keys")).collect()
    assert [(r["left_column"], r["confidence"]) for r in keys] == [("product_id", "high")]
    written = {r["details"]["table"]: r["details"] for r in log.where("action = 'table_written'").collect()}
    assert (written["sales_silver"]["rows_in"], written["sales_silver"]["rows_removed"]) == ("4", "0")
    assert (written["gold_output"]["rows_in"], written["gold_output"]["rows_out"]) == ("7", "4")
    traces = read_traces(spark, os.path.join(root, "traces")).collect()
    assert {(r["agent"], r["status"]) for r in traces} == {
        (a, "success") for a in ("profiler", "bronze_agent", "silver_agent", "gold_agent")}
    stored = spark.read.parquet(os.path.join(root, "documents", state.run_id)).collect()
    assert {r["metadata"]["kind"] for r in stored} == {"intent", "report"}


def test_unreadable_source_is_reported_and_skipped(spark, tmp_path):
    good = str(tmp_path / "sales.csv")
    _write_csv(good, "sale_id,category,total_amount", [("1", "a", 2), ("2", "b", 3)])
    root = str(tmp_path / "out")
    state = phases.run(spark, {"sales": phases.CsvSource(good, multi_line=False), "gone": str(tmp_path / "gone.csv")},
                       "total amount by category", root=root)
    assert list(state.sources) == ["sales"] and state.result.count() == 2
    events = read_runlog(spark, os.path.join(root, "runlog"), state.run_id)
    assert events.where("action = 'source_skipped'").first()["details"]["table"] == "gone"


def test_unrecognised_rules_are_reported(spark, tmp_path):
    from lakesmith.sources.runlog import RunLog
    log = RunLog(spark, str(tmp_path / "log"), "r")
    from lakesmith.operators import rules
    table = rules.rules_from_rows(spark, [
        {"source_table": "t", "source_column": "a", "target_column": "a", "transformation_logic": "polish it"},
        {"source_table": "t", "source_column": "b", "target_column": "b", "transformation_logic": "Convert to integer"}])
    assert [r["target_column"] for r in phases.report_rules("bronze", table, log)] == ["a"]
    log.flush()
    assert read_runlog(spark, str(tmp_path / "log")).where("action = 'rule_unrecognised' AND status = 'skipped'").count() == 1


def test_csv_keeps_long_whole_numbers(spark, tmp_path):
    from lakesmith.sources.csv import read_csv_table
    p = str(tmp_path / "t.csv")
    _write_csv(p, "a,b,c", [("12345678901234567890", 1, "1" * 45), ("12345678901234567891", 2, "7"), ("5", 3, "8")])
    df = read_csv_table(spark, p)
    assert [t for _, t in df.dtypes[:3]] == ["decimal(38,0)", "bigint", "string"]
    assert [str(r["a"]) for r in df.orderBy("_row_order").collect()] == ["12345678901234567890", "12345678901234567891", "5"]


def test_csv_null_tokens_and_types(spark, tmp_path):
    p = str(tmp_path / "t.csv")
    _write_csv(p, "a,b,c,d", [(1, "1.5", "True", "x"), ("NA", "n/a", "False", "")])
    from lakesmith.sources.csv import read_csv_table
    df = read_csv_table(spark, p)
    assert [t for _, t in df.dtypes[:4]] == ["bigint", "double", "boolean", "string"]
    rows = df.orderBy("_row_order").collect()
    assert rows[1]["a"] is None and rows[1]["b"] is None and rows[1]["d"] is None


def test_csv_split_read_matches_multiline_read(spark, tmp_path):
    """A one-record-per-line file read in splits gives the same typed rows,
    in the same row order, as the default whole-file read."""
    from lakesmith.sources.csv import read_csv_table
    p = str(tmp_path / "big.csv")
    _write_csv(p, "k,v,flag", [(i, f"{i / 7:.3f}" if i % 11 else "NA", "True" if i % 2 else "False")
                               for i in range(60000)])
    prev = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 * 1024))
    try:
        split = read_csv_table(spark, p, multi_line=False)
        assert split.rdd.getNumPartitions() > 1
        whole = read_csv_table(spark, p)
        assert split.dtypes == whole.dtypes
        cols = ["k", "v", "flag"]
        got = [tuple(r) for r in split.orderBy("_row_order").select(*cols).collect()]
        want = [tuple(r) for r in whole.orderBy("_row_order").select(*cols).collect()]
        assert got == want and len(got) == 60000 and got[0][0] == 0 and got[-1][0] == 59999
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", prev)
