"""Bronze layer (B1-B10), modelled on the reference's Bronze tests."""

from lakesmith.operators import bronze, rules


def _rules(spark, rows):
    return rules.rules_from_rows(spark, rows)


def _basic(spark):
    return _rules(spark, [
        {"source_table": "test", "source_column": "id", "target_column": "id",
         "transformation_logic": "Convert to integer whole number"},
        {"source_table": "test", "source_column": "value", "target_column": "value",
         "transformation_logic": "Convert to integer whole number"},
    ])


def test_lineage_columns_present(spark):
    df = spark.createDataFrame([(1, 10), (2, 20)], "id long, value long")
    out = bronze.execute_bronze({"test": df}, _basic(spark))["test_bronze"]
    assert {"_load_timestamp", "_source_file"} <= set(out.columns)
    assert out.count() == 2


def test_row_count_kept(spark):
    df = spark.createDataFrame([(i, i * 10) for i in range(50)], "id long, value long")
    assert bronze.execute_bronze({"test": df}, _basic(spark))["test_bronze"].count() == 50


def test_rename(spark):
    df = spark.createDataFrame([(1,), (2,)], "old_name long")
    r = _rules(spark, [{"source_table": "test", "source_column": "old_name", "target_column": "new_name",
                        "transformation_logic": "Convert to integer whole number"}])
    out = bronze.execute_bronze({"test": df}, r)["test_bronze"]
    assert "new_name" in out.columns and "old_name" not in out.columns


def test_two_files_in_two_out_blank_source_table_applies_to_all(spark):
    a = spark.createDataFrame([(1,)], "id long")
    b = spark.createDataFrame([(2,)], "id long")
    r = _rules(spark, [{"source_table": "", "source_column": "id", "target_column": "id",
                        "transformation_logic": "Convert to text format"}])
    out = bronze.execute_bronze({"a": a, "b": b}, r)
    assert set(out) == {"a_bronze", "b_bronze"}
    assert all(dict(t.dtypes)["id"] == "string" for t in out.values())


def test_casts_from_text(spark, rows_of):
    df = spark.createDataFrame([("1", "1.5", "2024-03-05", "7", None), ("x", "1d", "bad", "8", "z")],
                               "i string, f string, d string, t string, n string")
    r = _rules(spark, [
        {"source_column": "i", "target_column": "i", "transformation_logic": "Convert to integer whole number"},
        {"source_column": "f", "target_column": "f", "transformation_logic": "Convert to float decimal numeric"},
        {"source_column": "d", "target_column": "d", "transformation_logic": "Convert to date format"},
        {"source_column": "n", "target_column": "n", "transformation_logic": "Convert to text format"},
    ])
    out = bronze.execute_bronze({"t": df}, r)["t_bronze"]
    got = rows_of(out, "i", "f", "d", "n")
    assert got[0][:2] == (1, 1.5) and str(got[0][2]).startswith("2024-03-05")
    # bad values become null; '1d' is not a number (Q12); null text stays null (Q2)
    assert got[1][:3] == (None, None, None)
    assert got[0][3] is None and got[1][3] == "z"


def test_integer_rule_on_fractional_column_leaves_it_unchanged(spark):
    df = spark.createDataFrame([("1.5",), ("2",)], "q string")
    r = _rules(spark, [{"source_column": "q", "target_column": "q",
                        "transformation_logic": "Convert to integer whole number"}])
    out = bronze.execute_bronze({"t": df}, r)["t_bronze"]
    assert dict(out.dtypes)["q"] == "string"
    assert [x["q"] for x in out.collect()] == ["1.5", "2"]


def test_shorter_rule_table_is_accepted(spark):
    df = spark.createDataFrame([(1, 9)], "id long, value long")
    r = spark.createDataFrame([("id", "id", "Convert to text format")],
                              "source_column string, target_column string, transformation_logic string")
    out = bronze.execute_bronze({"test": df}, r)["test_bronze"]
    assert dict(out.dtypes)["id"] == "string"
