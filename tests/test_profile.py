"""Profiling (P1-P10), modelled on the reference's profiler tests."""

from lakesmith.operators import profile


def _widgets(spark, rows):
    return spark.createDataFrame(rows, "widget_id string, price double")


def test_row_and_column_counts(spark):
    prof = profile.profile_tables({"widgets": _widgets(spark, [("W1", 10.0), ("W2", 20.0)])})
    r = {x["column_name"]: x for x in prof.collect()}
    assert r["price"]["rows"] == 2 and r["price"]["columns"] == 2
    assert r["price"]["min_value"] == 10.0 and r["price"]["max_value"] == 20.0 and r["price"]["mean_value"] == 15.0
    assert r["widget_id"]["sample_values"] == ["W1", "W2"]
    assert r["widget_id"]["min_value"] is None


def test_semantic_labels(spark):
    df = spark.createDataFrame([(1, "2024-01-01", 2.0, 3, "a", "x", "c", 1.5, "t")],
                               "order_id long, order_date string, total_amount double, qty long, "
                               "product_name string, city string, category string, score double, note string")
    labels = {r["column_name"]: r["semantic_label"]
              for r in profile.semantic_labels(profile.profile_tables({"t": df})).collect()}
    assert labels == {
        "order_id": "Unique identifier column", "order_date": "Date/time column",
        "total_amount": "Monetary value column", "qty": "Quantity/count column",
        "product_name": "Descriptive name column", "city": "Geographic/location column",
        "category": "Categorical grouping column", "score": "Numeric measure column",
        "note": "Descriptive text column"}


def test_shared_id_is_high_confidence_join_key(spark):
    products = spark.createDataFrame([("P1", "A")], "product_id string, category string")
    sales = spark.createDataFrame([("P1", 1.0, "A")], "product_id string, amount double, category string")
    keys = profile.join_keys(profile.profile_tables({"products": products, "sales": sales})).collect()
    got = {(k["left_dataset"], k["right_dataset"], k["left_column"], k["confidence"]) for k in keys}
    assert got == {("products", "sales", "product_id", "high"), ("products", "sales", "category", "medium")}


def test_null_quality_note_names_the_column(spark):
    prof = profile.profile_tables({"widgets": _widgets(spark, [("W1", 10.0), ("W2", None)])})
    notes = [r["note"] for r in profile.quality_notes(prof).collect()]
    assert notes == ["widgets.price: 50.0% null values"]


def test_negative_note_and_default_note(spark):
    prof = profile.profile_tables({"t": spark.createDataFrame([(-2.5,), (1.0,)], "x double")})
    assert [r["note"] for r in profile.quality_notes(prof).collect()] == ["t.x: contains negative values (min=-2.5)"]
    clean = profile.profile_tables({"t": spark.createDataFrame([(1.0,)], "x double")})
    assert [r["note"] for r in profile.quality_notes(clean).collect()] == [profile.NO_ISSUES]


def test_all_null_numeric_column_has_no_min(spark):
    prof = profile.profile_tables({"t": spark.createDataFrame([(None,), (None,)], "x double")})
    r = prof.collect()[0]
    assert r["min_value"] is None and r["mean_value"] is None and r["null_pct"] == 100.0


def test_samples_are_first_five_in_file_order(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.createDataFrame([(i, f"v{i}") for i in range(20)], "i long, s string").coalesce(1) \
        .write.parquet(path)
    from lakesmith.sources.tables import read_table
    prof = profile.profile_tables({"t": read_table(spark, path)})
    s = [r for r in prof.collect() if r["column_name"] == "s"][0]
    assert s["sample_values"] == ["v0", "v1", "v2", "v3", "v4"]


def test_empty_table_and_nan(spark):
    empty = spark.createDataFrame([], "a long, b string")
    nan = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    prof = {(r["dataset"], r["column_name"]): r for r in
            profile.profile_tables({"e": empty, "n": nan}).collect()}
    assert prof[("e", "a")]["rows"] == 0 and prof[("e", "a")]["null_pct"] is None
    assert prof[("n", "x")]["null_count"] == 1 and prof[("n", "x")]["unique_count"] == 1
    assert prof[("n", "x")]["mean_value"] == 1.0


def test_approximate_distinct_option(spark):
    df = spark.createDataFrame([(i % 7, "x") for i in range(100)], "k long, s string")
    prof = {r["column_name"]: r for r in profile.profile_tables({"t": df}, approx_distinct=True).collect()}
    assert prof["k"]["unique_count"] == 7 and prof["s"]["unique_count"] == 1 and prof["k"]["max_value"] == 6.0


def test_signed_zeros_are_one_value(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (1.0,), (float("nan"),), (None,)], "x double")
    row = profile.profile_tables({"t": df}).first()
    assert (row["unique_count"], row["null_count"]) == (2, 2)
    assert profile.profile_of_state(profile.profile_state({"t": df})).first()["unique_count"] == 2


def test_maps_and_long_texts_are_counted(spark):
    df = spark.createDataFrame([({"a": 1, "b": 2}, "x" * 500), ({"b": 2, "a": 1}, "x" * 499 + "y"), (None, None)], "m map<string,int>, s string")
    assert {r["column_name"]: r["unique_count"] for r in profile.profile_tables({"t": df}).collect()} == {"m": 1, "s": 2}


def test_merged_states_equal_the_whole(spark):
    from pyspark.sql import functions as F
    rows = [(i, None if i % 5 == 0 else f"v{i % 37}", float(i % 11) if i % 3 else None, i % 2 == 0) for i in range(500)]
    whole = spark.createDataFrame(rows, "id long, s string, x double, b boolean").coalesce(1)
    a, b, c = (spark.createDataFrame(part, whole.schema).coalesce(1) for part in (rows[:100], rows[100:101], rows[101:]))
    states = [profile.profile_state({"t": d}) for d in (a, b, c)]
    merged = profile.merge_states(profile.merge_states(*states[:2]), states[2])
    keep = ["column_name", "rows", "null_count", "null_pct", "min_value", "max_value", "unique_count", "sample_values"]
    mean = F.round("mean_value", 9)
    got, want = (sorted(map(str, p.select(*keep, mean).collect())) for p in (
        profile.profile_of_state(merged), profile.profile_of_state(profile.profile_state({"t": whole}))))
    assert got == want
    exact = {r["column_name"]: r for r in profile.profile_tables({"t": whole}).collect()}
    for r in profile.profile_of_state(merged).collect():
        e = exact[r["column_name"]]
        assert abs(r["unique_count"] - e["unique_count"]) <= 0.05 * e["unique_count"]
        assert all(r[c] == e[c] for c in ("rows", "null_count", "null_pct", "min_value", "max_value", "sample_values"))


def test_a_new_column_is_missing_in_earlier_states(spark):
    old = profile.profile_state({"t": spark.createDataFrame([(1,), (2,)], "a long")})
    new = profile.profile_state({"t": spark.createDataFrame([(3, "x")], "a long, b string")})
    got = {r["column_name"]: (r["rows"], r["null_count"]) for r in profile.profile_of_state(profile.merge_states(old, new)).collect()}
    assert got == {"a": (3, 0), "b": (3, 2)}
