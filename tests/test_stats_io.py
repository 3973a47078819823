"""Exact median / mode against brute force, and the rule/profile sinks."""

import random
import statistics

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesmith.functions import stats
from lakesmith.operators import profile, rules


def _median_of(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    return stats.exact_median(df, F.col("x"))


def test_exact_median_matches_brute_force_with_narrowing(spark, monkeypatch):
    monkeypatch.setattr(stats, "_ACCURACY", 3)  # rough candidates: several narrowing passes
    rng = random.Random(7)
    for n in (1, 2, 501, 1000):
        values = [float(rng.randint(0, 300)) for _ in range(n)]
        assert _median_of(spark, values) == statistics.median(values)


def test_exact_median_hot_value_and_nulls(spark, monkeypatch):
    monkeypatch.setattr(stats, "_ACCURACY", 2)
    values = [5.0] * 400 + [float(i) for i in range(200)] + [None] * 50
    expected = statistics.median([v for v in values if v is not None])
    assert _median_of(spark, values) == expected
    assert _median_of(spark, [None, None]) is None


def test_exact_median_between_two_long_runs(spark):
    for n in (120_002, 1_555_554):
        df = spark.range(n).select(F.when(F.col("id") % 2 == 0, 1.0).otherwise(2.0).alias("x"),
                                   F.when(F.col("id") % 3 == 0, float("nan")).otherwise(F.col("id")).alias("y"))
        kept = [i for i in range(n) if i % 3]
        assert stats.exact_medians(df, {"x": F.col("x"), "y": F.col("y")}) == {"x": 1.5, "y": statistics.median(kept)}


def test_exact_median_narrows_until_the_driver_may_look(spark, monkeypatch):
    monkeypatch.setattr(stats, "_ACCURACY", 20)
    monkeypatch.setattr(stats, "_LOOKED_AT", 50)
    rng = random.Random(3)
    values = [rng.random() * 10 ** rng.randint(0, 9) for _ in range(20_001)]
    df = spark.createDataFrame([(v, float(i % 7), None) for i, v in enumerate(values)], "x double, y double, z double").repartition(5)
    assert stats.exact_medians(df, {c: F.col(c) for c in "xyz"}) == {
        "x": statistics.median(values), "y": statistics.median(i % 7 for i in range(20_001)), "z": None}


def test_number_text_is_the_doubles_own(spark):
    values = [-0.000123456789012, -994.28, 100.0, 0.0, 1.5e-7, 1e16, 123456789.125, 9007199254740993.0, 0.1 + 0.2, 2e-5]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in df.select(profile.num_text(F.col("x"))).collect()] == [repr(v) for v in values]


def test_modes_one_pass(spark):
    df = spark.createDataFrame([("b", 2, None), ("a", 2, None), ("b", 1, None), ("a", 1, None), (None, 3, None)],
                               "s string, n long, e string")
    got = stats.modes(df, {"s": (F.col("s"), T.StringType()), "n": (F.col("n"), T.LongType()),
                           "e": (F.col("e"), T.StringType())})
    assert got == {"s": "a", "n": "1", "e": None}


def test_rule_table_csv_round_trip(spark, tmp_path):
    r = rules.rules_from_rows(spark, [
        {"source_table": "t", "source_column": "a", "target_column": "b", "transformation_logic": "Convert, \"quoted\""},
        {"source_table": "", "source_column": "c", "target_column": "c", "transformation_logic": ""}])
    path = str(tmp_path / "rules")
    rules.write_rules(r, path)
    back = rules.collect_rules(rules.read_rules(spark, path))
    assert [(x["source_column"], x["target_column"], x["transformation_logic"], x["source_table"]) for x in back] == \
        [("a", "b", 'Convert, "quoted"', "t"), ("c", "c", "", "")]


def test_profile_sink(spark, tmp_path):
    prof = profile.profile_tables({"t": spark.createDataFrame([(1, "x")], "id long, s string")})
    profile.write_profile(prof, str(tmp_path / "p"))
    back = spark.read.json(str(tmp_path / "p"))
    assert back.count() == 2 and "semantic_label" not in back.columns
