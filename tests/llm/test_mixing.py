import os

import duckdb
import pytest
from pyspark.sql import functions as F

from lakesmith.llm import mixing
from lakesmith.llm.queries import OP8_SQL, ORACLE, QUERIES

from .conftest import EDGE

SF = "/root/testdata/sf0.001"


def test_raked_weights_meet_all_marginals(spark):
    cells = [(s, la, t, 10 + 7 * i * j + 3 * k) for i, s in enumerate("abc") for j, la in enumerate("xy") for k, t in enumerate("pq")]
    df = spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")
    targets = {"source": {"a": 0.5, "b": 0.3, "c": 0.2, "absent": 0.4}, "lang": {"x": 0.1, "y": 0.9}, "topic": {"p": 0.25, "q": 0.75}}
    out = mixing.rake(df, targets, rounds=40).collect()
    for margin, shares in targets.items():
        whole = sum(v for k, v in shares.items() if k != "absent")
        for value, share in shares.items():
            got = sum(r["weight"] for r in out if r[margin] == value)
            assert got == pytest.approx(0 if value == "absent" else share / whole, abs=1e-6)


def test_sample_follows_the_probabilities(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("one two three "), "id").alias("text"),
        F.when(F.col("id") % 4 == 0, "small").otherwise("large").alias("source"), F.lit("en").alias("lang"))
    rows = mixing.mix(docs, {"source": {"small": 0.5, "large": 0.5}}).collect()
    by = {s: [r for r in rows if r["source"] == s] for s in ("small", "large")}
    assert {r["probability"] for r in by["small"]} == {1.0} and all(r["sampled"] for r in by["small"])
    assert by["large"][0]["probability"] == pytest.approx(1 / 3)
    assert abs(sum(r["sampled"] for r in by["large"]) / 3000 - 1 / 3) < 0.03


def test_a_value_without_target_is_not_drawn(make):
    docs = make([(1, "a b"), (2, "c d")], source="s").unionByName(make([(3, "x")], source="t"))
    got = {r["doc_id"]: r["probability"] for r in mixing.mix(docs, {"source": {"s": 1.0}}).collect()}
    assert got == {1: 1.0, 2: 1.0, 3: 0.0}


def test_edges_and_empty(edge, empty):
    out = mixing.mix(edge)
    rows = out.collect()
    assert len(rows) == len(EDGE) and out.columns.count("n_tokens") == 1
    assert all(0 < r["probability"] <= 1 for r in rows)
    assert {r["n_tokens"] for r in rows if not r["text"]} == {0}
    twins = [r["sampled"] for r in rows if r["doc_id"] == 1]
    assert len(twins) == 2 and len(set(twins)) == 1
    assert mixing.mix(empty).count() == 0 and mixing.sample_to_targets(empty).columns == empty.columns


def test_no_python_on_the_main_path(edge):
    plan = mixing.mix(edge)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t)}.parquet')")
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = con.sql(ORACLE[name])
    assert sorted(want.columns) == columns
    rows = con.sql(f"SELECT {', '.join(columns)} FROM want").fetchall()
    assert sorted(map(repr, rows)) == sorted(repr(tuple(r)) for r in got.select(*columns).collect())
    assert OP8_SQL in ORACLE.values()
