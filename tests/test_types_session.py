"""Common types, missing values, upserts and session rules."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesmith import session
from lakesmith.functions.types import common_type, union_all
from lakesmith.operators import docs, gold, rules, silver


def test_common_types():
    assert common_type(T.IntegerType(), T.LongType()) == T.LongType()
    assert common_type(T.LongType(), T.DoubleType()) == T.DoubleType()
    assert common_type(T.LongType(), T.StringType()) == T.StringType()
    assert common_type(T.DateType(), T.TimestampNTZType()) == T.TimestampNTZType()
    assert common_type(T.NullType(), T.DateType()) == T.DateType()


def test_union_reconciles_types_and_case(spark):
    a = spark.createDataFrame([(1, "x")], "size long, Name string")
    b = spark.createDataFrame([("large", "y", 2.5)], "SIZE string, name string, extra double")
    out = union_all([a, b])
    assert out.dtypes == [("size", "string"), ("Name", "string"), ("extra", "double")]
    assert sorted(tuple(r) for r in out.collect()) == [("1", "x", None), ("large", "y", 2.5)]


def test_join_keys_of_two_types(spark):
    left = spark.createDataFrame([(1, "a"), (3, "c")], "id long, Name string")
    right = spark.createDataFrame([(2.5, "r"), (1.0, "s")], "id double, name string")
    spec = [{"source_table": t, "source_column": c, "target_table": "g", "target_column": c,
             "transformation_type": "Direct", "transformation_logic": "Passthrough"} for t, c in (("l", "id"), ("l", "Name"))]
    spec += [dict(spec[0], source_table="r")]
    out = gold.execute_gold({"l": left, "r": right}, rules.rules_from_rows(spark, spec))["g"]
    assert [(r["id"], r["Name"]) for r in out.orderBy("pk_gold_id").collect()] == [(1.0, "a"), (2.5, None), (3.0, "c")]


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1, 10.0), (2, float("nan")), (3, 30.0), (4, None)], "k long, v double")
    for how, want in (("mean", [10.0, 20.0, 30.0, 20.0]), ("median", [10.0, 20.0, 30.0, 20.0]), ("mode", [10.0, 10.0, 30.0, 10.0])):
        r = rules.rules_from_rows(spark, [
            {"source_table": "t", "source_column": "k", "target_column": "k", "transformation_logic": "Keep"},
            {"source_table": "t", "source_column": "v", "target_column": "v", "transformation_logic": f"Fill null values with {how}"}])
        out = silver.execute_silver({"t": df}, r)["t_silver"].orderBy("k").collect()
        assert [x["v"] for x in out] == want


def test_keep_first_with_a_map_column(spark):
    df = spark.createDataFrame([(1, {"a": 1, "b": 2}), (1, {"b": 2, "a": 1}), (1, {"a": 3}), (2, None)], "k long, m map<string,int>")
    assert silver.keep_first(df.coalesce(1)).count() == 3
    assert silver.keep_first(df.coalesce(1), ["k"]).count() == 2


def test_upsert_keeps_the_last_new_document_and_puts_it_last(spark):
    def store(rows, batch=0):
        df = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id string, text string, n long")
        df = df.withColumn("_row_order", F.struct(F.lit("").alias("file"), F.col("n").alias("pos")))
        return docs.as_store(df, "doc_id", "text", ["n"], batch=batch)

    out = docs.upsert(store([("a", "old"), ("b", "stays")]), store([("a", "first"), ("a", "second"), ("c", "new")]))
    rows = out.orderBy("stored_batch", "_row_order").collect()
    assert [(r["id"], r["document"], r["stored_batch"]) for r in rows] == [("b", "stays", 0), ("a", "second", 1), ("c", "new", 1)]


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
