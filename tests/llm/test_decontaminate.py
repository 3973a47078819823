import itertools
import random

import pytest

from lakesmith.llm import decontaminate as d

from .conftest import EDGE

WORDS = [f"w{i}" for i in range(3000)]


@pytest.fixture(scope="module")
def items():
    rng = random.Random(3)
    return [(i, " ".join(rng.choices(WORDS, k=n))) for i, n in enumerate((40, 25, 13, 9, 6, 5, 0, 60))]


def noise(rng, n):
    return rng.choices([f"n{i}" for i in range(400)] + WORDS[:40], k=n)


def found(docs, items, spark, **options):
    bench = spark.createDataFrame(items + [(99, None)], "item_id long, text string")
    return {(r["doc_id"], o["item_id"]): o for r in d.contamination(docs, bench, **options).collect() for o in r["overlaps"]}


def test_exact_and_substituted_passages(make, spark, items):
    rng = random.Random(4)
    docs, want = [], set()
    for i, (item, text) in enumerate(items):
        tokens = text.split()
        docs.append((i, " ".join(noise(rng, 50) + tokens + noise(rng, 30))))
        if len(tokens) >= d.LEAST_TOKENS:
            want.add((i, item))
    for k, item in ((20, 0), (21, 7), (22, 1)):  # one token in eight replaced, other case and punctuation
        tokens = [("zz" if j % 8 == 5 else t.upper() + ",") for j, t in enumerate(items[item][1].split())]
        docs.append((k, " ".join(noise(rng, 20) + tokens)))
        want.add((k, item))
    docs.append((30, " ".join(items[0][1].split()[10:30])))  # part of an item
    want.add((30, 0))
    docs += [(40, " ".join(items[0][1].split()[:8])), (41, " ".join(noise(rng, 500)))]  # too short a part, clean
    got = found(make(docs), items, spark)
    assert set(got) == want
    assert got[0, 0]["start"] == 50 and got[0, 0]["end"] == 90 and got[0, 0]["matched"] == 40


def test_slices_and_a_full_filter_give_the_same(make, spark, items, monkeypatch):
    docs = make([(i, "start " + t) for i, t in items])
    want = found(docs, items, spark)
    assert len(want) == 7
    monkeypatch.setattr(d, "SLICE_BYTES", 100)
    monkeypatch.setattr(d, "FILTER_LEAST", 1 << 16)
    monkeypatch.setattr(d, "FILTER_BITS", 0)
    assert found(docs, items, spark) == want


def overlaps_of(spark, pairs):
    """pairs: (item tokens, document tokens); each pair has words of its own, so one run serves all."""
    own = lambda n, tokens: " ".join(f"p{n}q{t}" for t in tokens)
    items = spark.createDataFrame([(n, own(n, item)) for n, (item, _) in enumerate(pairs)], "item_id long, text string")
    docs = spark.createDataFrame([(n, own(n, doc)) for n, (_, doc) in enumerate(pairs)], "doc_id long, text string")
    out = [None] * len(pairs)
    for r in d.contamination(docs, items).collect():
        assert all(o["item_id"] == r["doc_id"] for o in r["overlaps"])
        out[r["doc_id"]] = {(o["start"], o["end"], o["matched"]) for o in r["overlaps"]}
    return out


def check(spark, pairs):
    for got, (item, doc) in zip(overlaps_of(spark, pairs), pairs):
        assert got == all_overlaps(doc, item), (item, doc)


def all_overlaps(doc, item):
    """The documented rule at every alignment, by trying every stretch."""
    out, needed = set(), len(item) if len(item) < 6 else min(13, -(-8 * len(item) // 10))
    for shift in range(1 - len(item), len(doc)):
        same = [0 <= shift + k < len(doc) and doc[shift + k] == t for k, t in enumerate(item)]
        inside = [0 <= shift + k < len(doc) for k in range(len(item))]
        good = [(i, j) for i in range(len(item)) for j in range(i + 1, len(item) + 1)
                if same[i] and same[j - 1] and all(inside[i:j]) and sum(same[i:j]) >= needed
                and 10 * sum(same[i:j]) >= 8 * (j - i)]
        out |= {(shift + i, shift + j, sum(same[i:j])) for i, j in good
                if not any(a <= i and j <= b and (a, b) != (i, j) for a, b in good)}
    return out


def replaced(tokens, at):
    return [f"x{j}" if j in at else t for j, t in enumerate(tokens)]


#: Token numbers replaced in an item of the given length.
CASES = [
    (16, {1, 14}),  # matched ends count
    (51, {*range(13, 19), *range(32, 38)}),  # exact runs of 13 between replaced stretches
    (67, {*range(20, 29), *range(38, 47)}),  # 20 + 9 + 20, the middle run of 9 only
    (40, {*range(0, 40, 7)}),
]


def test_every_stretch_that_meets_the_rule(make, spark):
    items = [(n, " ".join(f"i{n}t{j}" for j in range(length))) for n, (length, _) in enumerate(CASES)]
    docs = [(n, " ".join(["start", *replaced(t.split(), CASES[n][1]), "end"])) for n, t in items]
    out = d.contamination(make(docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    for r in out:
        want = all_overlaps(r["text"].split(), items[r["doc_id"]][1].split())
        assert want and {(o["start"], o["end"], o["matched"]) for o in r["overlaps"]} == want
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert d.decontaminate(make([*docs, (9, "clean")]), bench).select("doc_id").collect() == [(9,)]


def test_random_substitutions_equal_brute_force(spark):
    rng = random.Random(8)
    pairs = []
    for _ in range(400):
        item = [f"t{j}" for j in range(rng.randint(16, 50))]
        share = rng.choice((0.1, 0.2, 0.3, 0.4))
        pairs.append((item, ["a", *replaced(item, {j for j in range(6, len(item)) if rng.random() < share}), "b"]))
    check(spark, pairs)


def test_every_accepted_substitution_has_a_seed(spark):
    pairs = []
    for n in range(2, 18):
        item = [f"t{j}" for j in range(n)]
        pairs += [(item, replaced(item, set(at))) for k in range(min(5, n)) for at in itertools.combinations(range(n), k)]
    check(spark, random.Random(1).sample(pairs, 2500))


def test_random_items_and_any_alignment_equal_brute_force(spark):
    rng = random.Random(12)
    pairs = []
    for _ in range(300):
        words = [f"t{j}" for j in range(rng.choice((4, 12, 500)))]
        item = rng.choices(words, k=rng.randint(2, 36))
        pairs.append((item, rng.choices(words, k=5) + [t if rng.random() > 0.2 else "x" for t in item] + rng.choices(words, k=5)))
    check(spark, pairs)


def missed_pattern(masks, needed, longest):
    """An accepted stretch (1: equal, 0: replaced) of up to ``longest`` tokens
    in which no mask fits, or None.  All stretches are followed token by token;
    of those that agree in their last tokens and in their replaced ones, one is enough."""
    span = max(map(len, masks))
    fits = [(len(m), int(m.replace("#", "1").replace("-", "0"), 2)) for m in masks]
    layer = {(1, 0): "1"}
    for size in range(1, longest + 1):
        layer = {(bits, lost): word for (bits, lost), word in layer.items()
                 if not any(size >= n and bits & m == m for n, m in fits)}
        for (bits, lost), word in layer.items():
            if bits & 1 and size - lost >= needed and 4 * lost <= size - lost:
                return word
        layer = {((bits << 1 | bit) & ((1 << span) - 1), lost + 1 - bit): word + str(bit)
                 for (bits, lost), word in layer.items() for bit in (0, 1) if lost + 1 - bit <= longest // 5}
    return None


def test_masks_are_complete():
    """Every accepted stretch holds a mask.  Longer stretches than 31 tokens
    need no look: cut in two, one half of 16 or more is accepted itself."""
    for n, masks in d.SPACED_SEEDS.items():
        assert missed_pattern(masks, min(13, -(-8 * n // 10)), 31 if n == 16 else n) is None, n
    assert missed_pattern(d.SPACED_SEEDS[16][:-1], 13, 31) is not None  # the proof can fail
    assert any("-" in m for masks in d.SPACED_SEEDS.values() for m in masks)


def test_other_rules_use_exact_runs(make, spark, items):
    text = " ".join(replaced(items[0][1].split(), {*range(0, 40, 3)}))
    assert found(make([(1, text)]), items, spark, min_overlap=20, min_share=0.6)
    assert not found(make([(1, text)]), items, spark)


def test_common_phrases_of_many_items(make, spark):
    """A phrase of every item, shorter than a mask looks, joins nothing."""
    rng = random.Random(14)
    items = [(i, " ".join([*rng.choices(WORDS, k=8), "one", "of", "the", "most", *rng.choices(WORDS, k=8)])) for i in range(3000)]
    text = " ".join(f"{' '.join(noise(rng, 20))} one of the most" for _ in range(20))
    assert found(make([(1, text), (2, text + " " + items[7][1])]), items, spark).keys() == {(2, 7)}


def test_edges_and_empty(spark, edge, empty):
    bench = spark.createDataFrame([(1, EDGE[0][1]), (2, ""), (3, None), (4, "a b")], "item_id long, text string")
    out = d.contamination(edge, bench)
    assert out.count() == len(EDGE) and out.columns.count("overlaps") == 1
    kept = d.decontaminate(edge, bench)
    assert kept.columns == edge.columns and kept.count() == len(EDGE) - 2
    assert d.decontaminate(empty, bench).count() == 0
    assert d.decontaminate(edge, bench.limit(0)).count() == len(EDGE)
