import random
import zlib

import pytest
from pyspark.sql import functions as F

from lakesmith.llm import toxicity as t

from .conftest import EDGE

INSULTS = ["idiot", "grobnak", "trash", "zlorpen"]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    words = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("lt", "rm", "n", "st")]
    docs, labels = [], []
    for i in range(500):
        tokens = rng.choices(words, k=rng.randint(5, 120))
        toxic = i % 4 == 0
        if toxic:
            for _ in range(max(1, len(tokens) // 25)):
                tokens.insert(rng.randrange(len(tokens)), rng.choice(["you ", ""]) + rng.choice(INSULTS))
        docs.append((i, " ".join(tokens)))
        if i < 400:
            labels.append((i, int(toxic)))
    return docs, labels


def test_held_out_accuracy_and_folds(spark, make, corpus):
    docs, labels = corpus
    frame = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = t.fit(make(docs), frame)
    assert "grobnak" in model.lexicon and len(model.lexicon) <= t.LEXICON_ENTRIES + len(t.SEED_WORDS)
    rows = model.score(make(docs)).withColumn("fold", t.fold()).collect()
    assert all(r["fold"] == zlib.crc32(str(r["doc_id"]).encode()) % 5 for r in rows)
    held = [r for r in rows if r["fold"] == 0 or r["doc_id"] >= 400]
    assert sum(r["predicted"] == (r["doc_id"] % 4 == 0) for r in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    # held-out labels change nothing
    flipped = frame.withColumn("toxic", F.when(t.fold() == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = t.fit(make(docs), flipped)
    assert again.lexicon == model.lexicon and again.trees.toDebugString.split("\n")[1:] == model.trees.toDebugString.split("\n")[1:]


def test_features():
    lexicon = {"idiot": 2.0, "grob*": 1.0}
    f = dict(zip(t.FEATURES, t.text_features("You IDIOT! grobnak 1d10t h.e.l.l.o sooo", lexicon)))
    assert f["density"] > 0 and f["disguised_hits"] > 0 and f["near_you"] > 0 and f["repeats"] > 0
    assert f["capital_words"] > 0 and f["exclaims"] > 0 and f["spaced"] > 0
    assert t.text_features("", lexicon) == t.text_features(None, lexicon) == [0.0] * len(t.FEATURES)
    assert len(t.text_features("ab " * 50_000, lexicon)) == len(t.FEATURES)


def test_without_usable_labels(spark, edge, empty):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    out = t.fit(edge, none).score(edge)
    rows = out.collect()
    assert len(rows) == len(EDGE) and out.columns.count("score") == 1 and {r["score"] for r in rows} == {0.0}
    one_class = spark.createDataFrame([(i, 1) for i in range(1, 7)] * 2, "doc_id long, toxic int")
    assert {r["score"] for r in t.fit(edge, one_class).score(edge).collect()} == {1.0}
    assert t.fit(empty, none).score(empty).count() == 0


def test_features_counted_by_hand():
    import math
    text = "You IDIOT!! y0u are a m0ron... sooo b.a.d.s"
    n, size = 11, len(text)  # you idiot y0u are a m0ron sooo b a d s
    got = dict(zip(t.FEATURES, t.text_features(text, {"idiot": 2.0, "moron": 1.5})))
    want = {"density": 2 / n, "weight": 3.5 / n, "densest": 2 / t.WINDOW, "near_you": 2 / n, "second_person": 1 / n,
            "capitals": 6 / size, "capital_words": 1 / n, "exclaims": 2 / n, "punctuation": 8 / size, "disguised": 2 / n,
            "disguised_hits": 1 / n, "spaced": 1 / n, "repeats": 1 / n, "log_words": math.log1p(n)}
    assert {k: round(v, 12) for k, v in got.items()} == {k: round(v, 12) for k, v in want.items()}
