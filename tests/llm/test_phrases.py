import random
import re
from collections import Counter

import pytest

from lakesmith.llm import phrases as p

from .conftest import EDGE


def plain(docs, max_words=3, min_count=10, top=2000, percent=50):
    """The contract, restated: (lang, text) pairs to (lang, rank, phrase, a, l, r, n, score)."""
    counts: dict[str, Counter] = {}
    for lang, text in docs:
        seen = counts.setdefault(lang or "und", Counter())
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in range(1, max_words + 1):
                seen.update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        candidates = {w: a for w, a in f.items() if len(w) > 1 and a >= min_count}
        gone = set()
        for longer, b in candidates.items():
            for size in range(2, len(longer)):
                for i in range(len(longer) - size + 1):
                    inner = longer[i:i + size]
                    if 100 * b >= percent * f[inner]:
                        gone.add(inner)
        rows = []
        for w, a in candidates.items():
            if w not in gone:
                score, _, left, right = min((10**6 * a * a // (f[w[:k]] * f[w[k:]]), k, f[w[:k]], f[w[k:]]) for k in range(1, len(w)))
                rows.append((-score, -a, " ".join(w).encode(), left, right))
        n = sum(a for w, a in f.items() if len(w) == 1)
        out += [(lang, i, w.decode(), -a, left, right, n, -score)
                for i, (score, a, w, left, right) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def docs_of(seed, n=400):
    rng = random.Random(seed)
    words = ["the", "The", "of", "New", "york", "city", "hall", "é", "über", " x", "a\x00b", "don't", "x-y"]
    for i in range(n):
        parts = [rng.choice(words) if rng.random() < 0.7 else rng.choice(["new york", "new york city", "of the city hall", "\t \t"])
                 for _ in range(rng.randint(0, 40))]
        yield rng.choice(["en", "de", None, "und"]), "".join(x + rng.choice([" ", " ", " ", "  ", ", ", ".", "\n", "\r\n", "\t"]) for x in parts)


@pytest.fixture
def frame(spark):
    return lambda pairs: spark.createDataFrame([(lang, text) for lang, text in pairs], "lang string, text string")


@pytest.mark.parametrize("max_words,min_count,top", [(3, 10, 2000), (3, 2, 7), (4, 3, None), (2, 1, 50)])
def test_equals_plain_version(frame, max_words, min_count, top):
    docs = list(docs_of(max_words))
    got = sorted(tuple(r) for r in p.mine_phrases(frame(docs), max_words, min_count, top).collect())
    want = plain(docs, max_words, min_count, top or 10**9)
    assert got == want and len(want) > 10


def test_small_chunks_and_few_marks_change_nothing(frame, monkeypatch):
    docs = list(docs_of(9))
    want = plain(docs, 3, 3)
    monkeypatch.setattr(p, "WORDS_AT_ONCE", 50)
    monkeypatch.setattr(p, "MARK_BITS", 15)  # many false marks
    assert sorted(tuple(r) for r in p.mine_phrases(frame(docs), 3, 3).collect()) == want


def test_marks_agree_with_spark(spark):
    import numpy as np
    import xxhash
    from pyspark.sql import functions as F
    rows = [("en", "the", "city"), ("und", "é", "über"), ("de", "", "x")]
    df = spark.createDataFrame(rows, "lang string, a string, b string")
    got = [r[0] for r in df.select(p.phrase_hash(F.col("lang"), F.col("a"), F.col("b"))).collect()]
    want = []
    for lang, *words in rows:
        h = np.array([xxhash.xxh64_intdigest(f"{lang}\0{w}".encode(), 42) for w in words], np.uint64)
        want.append(int(p._marks(h, [np.array([0]), np.array([1])])[0]))
    assert got == want


def test_hot_word_and_exact_large_products(spark, frame):
    """One word in half of all places; its stripe is cut into pieces."""
    rng = random.Random(4)
    docs = [("en", " ".join("the " + rng.choice(["cat", "dog", f"w{rng.randint(0, 3000)}"]) for _ in range(50))) for _ in range(300)]
    assert sorted(tuple(r) for r in p.mine_phrases(frame(docs)).collect()) == plain(docs)
    big = spark.createDataFrame([(10**12, 10**12, 10**12 + 1), (3, 3, 4)], "a long, l long, r long")
    from pyspark.sql import functions as F
    got = [r[0] for r in big.select(p._score(F.col("a"), F.col("l"), F.col("r"))).collect()]
    assert got == [10**6 * 10**24 // (10**12 * (10**12 + 1)), 10**6 * 9 // 12]


def test_edges(edge, empty, frame):
    want = plain([(r[2], r[1]) for r in EDGE])
    assert sorted(tuple(r) for r in p.mine_phrases(edge).collect()) == want and want
    assert p.mine_phrases(empty).count() == 0
    out = p.mine_phrases(frame([("en", None), (None, ""), (None, None), ("en", " \t, . ")]))
    assert out.collect() == [] and out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
