"""Document store (K1, K2) and run-log operators."""

from pyspark.sql import functions as F

from lakesmith.operators import docs, runlog
from lakesmith.sources.runlog import RunLog, Trace, read_runlog, read_traces, write_traces


def _store(spark, rows, batch=0):
    df = spark.createDataFrame(rows, "doc_id string, text string")
    return docs.as_store(df, "doc_id", "text", batch=batch)


def test_search_counts_distinct_shared_words_and_keeps_zero_scores(spark):
    store = _store(spark, [("a", "The cat the CAT"), ("b", "dog and cat"), ("c", "nothing here")])
    res = docs.search(store, "the cat dog", n=5).collect()
    assert [(r["id"], r["score"]) for r in res] == [("a", 2), ("b", 2), ("c", 0)]


def test_search_ties_keep_stored_order(spark):
    store = _store(spark, [("x", "alpha"), ("y", "alpha")])
    assert [r["id"] for r in docs.search(store, "alpha", n=1).collect()] == ["x"]


def test_upsert_replaces_and_appends(spark):
    store = _store(spark, [("a", "one"), ("b", "two")])
    new = _store(spark, [("a", "uno")], batch=1)
    out = {r["id"]: (r["document"], r["stored_batch"]) for r in docs.upsert(store, new).collect()}
    assert out == {"a": ("uno", 1), "b": ("two", 0)}


def test_status_classes_reason_and_clock(spark):
    rows = [("2024-01-01T10:11:12+00:00", "x", "phase1_failed", None, {}),
            ("2024-01-01T10:11:13+00:00", "x", "done", "completed", {"detail": "ok"}),
            ("2024-01-01T10:11:14+00:00", "x", "go", "running", {"rationale": "", "decision_basis": "b"}),
            ("short", "x", "note", None, None)]
    df = spark.createDataFrame(rows, "timestamp string, agent string, action string, status string, "
                                     "details map<string,string>")
    got = [(r["status_class"], r["reason"], r["clock"]) for r in runlog.annotate(df).collect()]
    assert got == [("is-failed", runlog.NO_REASON, "10:11:12"), ("is-success", "ok", "10:11:13"),
                   ("is-progress", "b", "10:11:14"), ("is-neutral", runlog.NO_REASON, "--:--:--")]


def test_runlog_round_trip_and_missing(spark, tmp_path):
    root = str(tmp_path / "log")
    assert read_runlog(spark, root, "r1").count() == 0
    log = RunLog(spark, root, "r1")
    log.log("bronze_agent", "started", status="started", files="a.csv")
    log.log("bronze_agent", "completed", status="completed")
    log.flush()
    RunLog(spark, root, "r2").log("x", "y") or None
    got = read_runlog(spark, root, "r1")
    assert got.count() == 2
    latest = runlog.latest_per_run(got).collect()[0]
    assert latest["action"] == "completed"


def test_traces(spark, tmp_path):
    t = Trace("bronze_agent", "r1").set_input(a=1).set_plan("p").step("s1").set_output(b=2).complete()
    write_traces(spark, [t], str(tmp_path / "tr"))
    back = runlog.step_durations(read_traces(spark, str(tmp_path / "tr"))).collect()
    assert back[0]["agent"] == "bronze_agent" and back[0]["status"] == "success"


def test_index_search_equals_the_scan(spark, tmp_path):
    import random

    from pyspark.sql import functions as F
    from lakesmith.operators import docs
    rng = random.Random(2)
    words = ["alpha", "Beta", "gamma", "delta", "É", "x"]
    rows = [(f"d{i}", " \t".join(rng.choices(words, k=rng.randint(0, 5))) if i % 9 else None, i) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id string, text string, n long").withColumn(
        "_row_order", F.struct(F.lit("").alias("file"), F.col("n").alias("pos")))
    store = docs.as_store(df, "doc_id", "text", ["n"])
    path = str(tmp_path / "index")
    docs.write_index(store, path)
    for text, n in (("alpha beta", 5), ("é gamma delta x alpha", 60), ("nothing here", 7), ("", 3), ("x", 50)):
        want = [(r["id"], r["score"] or 0) for r in docs.search(store, text, n).collect()]
        found = docs.search_index(spark, path, text, n)
        assert [(r["id"], r["score"]) for r in found.collect()] == want, text
    plan = docs.search_index(spark, path, "alpha", 5)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "document" not in plan


def test_index_of_an_empty_store(spark, tmp_path):
    from lakesmith.operators import docs
    store = docs.as_store(spark.createDataFrame([], "doc_id string, text string"), "doc_id", "text")
    docs.write_index(store, str(tmp_path / "i"))
    assert docs.search_index(spark, str(tmp_path / "i"), "word").count() == 0
