import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakesmith.llm import quality as q
from lakesmith.llm.common import table

from .conftest import EDGE

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def scored(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    model = q.fit(docs, table(spark, SF, "labels"))
    rows = model.score(docs).withColumn("held", q.fold() == 0).join(
        table(spark, SF, "labels").select("doc_id", "quality"), "doc_id").where("quality is not null").select(
        "score", "predicted", "quality", "held").collect()
    return model, rows


def test_held_out_accuracy(scored):
    _, rows = scored
    held = [r for r in rows if r["held"]]
    good, bad = ([r["score"] for r in held if r["quality"] == k] for k in (1, 0))
    wins = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert len(held) > 50 and wins > 0.95
    assert sum(r["predicted"] == 1 for r in held if r["quality"] == 1) >= 0.97 * len(good)
    assert sum(r["predicted"] == 0 for r in held if r["quality"] == 0) >= 0.8 * len(bad)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_calibrated(scored):
    _, rows = scored
    held = [r for r in rows if r["held"]]
    assert sum((r["score"] - r["quality"]) ** 2 for r in held) / len(held) < 0.05
    assert abs(np.mean([r["score"] for r in held]) - np.mean([r["quality"] for r in held])) < 0.05


def test_statistics_of_plain_texts():
    """Every statistic, counted by hand on a small text."""
    text = "Big CATS saw 12 dogs, big CATS!\nsaw saw $$ é"
    s = dict(zip(q.STATISTICS, q.text_statistics(text)))
    words, data = text.split(), text.encode()
    n, size = len(words), len(data)
    lens = [len(w) for w in words]
    want = {"log_words": math.log1p(n), "word_length": np.mean(lens), "word_spread": np.std(lens),
            "short_words": sum(x <= 3 for x in lens) / n, "long_words": 0, "different_words": len(set(words)) / n,
            "commonest_word": words.count("saw") / n, "different_pairs": len(set(zip(words, words[1:]))) / n,
            "doubled_words": 1 / n, "capital_words": 2 / n, "title_words": 1 / n, "bare_marks": 1 / n, "marked_ends": 3 / n,
            "letters": sum(c.isascii() and c.isalpha() for c in text) / size, "capitals": 9 / size, "digits": 2 / size,
            "stops": 1 / size, "cries": 1 / size, "symbols": 2 / size, "blanks": text.count(" ") / size + 1 / size,
            "other_bytes": 2 / size, "line_words": math.log1p(n / 2), "repeated_lines": 0,
            "sentence_words": math.log1p(n / 2)}
    assert {k: s[k] for k in want} == pytest.approx(want)
    assert q.text_statistics(None) == q.text_statistics(" \n\t") == [0.0] * len(q.STATISTICS)
    assert len(q.text_statistics("x" * 1_000_000)) == len(q.STATISTICS)


def test_features_approximate_the_gaussian_kernel():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(40, 5))
    kernel = q.Kernel.draw(np.zeros(5), np.ones(5), 20_000, 1.0, 3)
    z = kernel.features(x)[:, 1:]
    distance = ((x[:, None] - x[None]) ** 2).sum(-1)
    assert np.abs(z @ z.T - np.exp(-distance / (2 * 5))).max() < 0.04


def test_normal_equations_are_the_sums_over_all_rows(spark):
    rng = np.random.default_rng(2)
    s, y = rng.normal(size=(57, 4)), rng.integers(0, 2, 57).astype(float)
    rows = spark.createDataFrame([(a.tolist(), float(b)) for a, b in zip(s, y)], "s array<double>, label double").repartition(5)
    kernel = q.Kernel.draw(s.mean(0), s.std(0), 16, 1.0, 5)
    gram, right, n = q.normal_equations(rows, kernel)
    z = kernel.features(s)
    assert n == 57 and np.allclose(gram, z.T @ z) and np.allclose(right, z.T @ y)


def test_no_label_of_the_held_out_fold_is_used(spark, make):
    pairs = [(i, f"word{i} and more text {'| ' * (i % 5)} here") for i in range(200)]
    docs = make(pairs)
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    flipped = labels.withColumn("quality", F.when(q.fold() == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted((r["doc_id"], round(r["score"], 9)) for r in q.fit(docs, x).score(docs).collect()) for x in (labels, flipped))
    assert a == b


def test_edges(spark, edge, empty, scored):
    model, _ = scored
    out = model.score(edge)
    rows = out.collect()
    assert len(rows) == len(EDGE) and all(0 <= r["score"] <= 1 for r in rows)
    assert [c for c in out.columns if c in ("score", "predicted")] == ["score", "predicted"] and "spans" in out.columns
    blank = {r["score"] for r in rows if not (r["text"] or "").strip()}
    assert len(blank) == 1
    assert model.score(empty).count() == 0
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in q.fit(edge, none).score(edge).collect()} == {1.0}
    one = spark.createDataFrame([(1, 1), (2, 1), (4, 1), (None, 0), (5, None)], "doc_id long, quality int")
    assert {r["score"] for r in q.fit(edge, one).score(edge).collect()} == {1.0}
    assert q.fit(empty, one).score(edge).count() == len(EDGE)
