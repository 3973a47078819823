import numpy as np
from pyspark.sql import functions as F

from lakesmith.llm import sharding

from .conftest import EDGE


def test_matrix_has_its_margins_and_law():
    rng = np.random.default_rng(1)
    rows, columns = np.array([5, 0, 7, 12]), np.array([8, 8, 8])
    cells = []
    for _ in range(3000):
        m = sharding.draw_matrix(rng, rows, columns)
        assert (m.sum(1) == rows).all() and (m.sum(0) == columns).all() and (m >= 0).all()
        cells.append(m[0, 0])
    # first cell: 5 draws from 24 places of which 8 count
    assert abs(np.mean(cells) - 5 * 8 / 24) < 0.06
    assert abs(np.var(cells) - 5 * (1 / 3) * (2 / 3) * 19 / 23) < 0.08


def test_beyond_the_generators_limit():
    rng = np.random.default_rng(2)
    left = np.array([3_000_000_000, 3_000_000_001, 1])
    out = sharding._hypergeometric(rng, left, 4_000_000_000)
    assert out.sum() == 4_000_000_000 and (out <= left).all() and abs(out[0] - 2_000_000_000) < 500_000


def test_whole_law_of_a_small_matrix():
    """Every matrix with these margins occurs as often as permutations give it."""
    from itertools import product
    from math import comb, factorial
    rows, columns = [3, 1, 2], [2, 2, 2]
    law = {}
    for cells in product(range(3), repeat=9):
        m = np.array(cells).reshape(3, 3)
        if (m.sum(1) == rows).all() and (m.sum(0) == columns).all():
            law[cells] = (np.prod([factorial(x) for x in rows]) * np.prod([factorial(x) for x in columns])
                          / (factorial(6) * np.prod([factorial(x) for x in cells])))
    assert abs(sum(law.values()) - 1) < 1e-12 and comb(6, 2)
    rng, n = np.random.default_rng(5), 30_000
    seen = dict.fromkeys(law, 0)
    for _ in range(n):
        seen[tuple(sharding.draw_matrix(rng, np.array(rows), np.array(columns)).ravel().tolist())] += 1
    assert all(abs(seen[c] - n * p) < 5 * (n * p * (1 - p)) ** 0.5 for c, p in law.items())


def test_draws_by_inversion_have_the_exact_law(monkeypatch):
    from math import comb
    rng, n = np.random.default_rng(7), 20_000
    for good, bad, k in ((5, 9, 6), (1, 30, 4), (40, 3, 20), (7, 7, 14), (0, 4, 2)):
        seen = np.bincount([sharding._by_inversion(rng, good, bad, k) for _ in range(n)], minlength=good + 1)
        law = np.array([comb(good, x) * comb(bad, k - x) / comb(good + bad, k) if 0 <= k - x <= bad else 0 for x in range(good + 1)])
        assert (np.abs(seen - n * law) <= 5 * np.sqrt(n * law * (1 - law)) + 1e-9).all()
    # two draws from a huge urn: both good in a quarter of all cases, up to 1e-9
    pairs = np.bincount([sharding._one_cell(rng, 10**11, 10**11, 2) for _ in range(n)], minlength=3)
    assert (np.abs(pairs - n * np.array([.25, .5, .25])) < 5 * np.sqrt(n * .25)).all()


def test_every_row_has_one_place(spark):
    docs = spark.range(0, 5003, 1, 7).select(F.col("id").alias("doc_id"))
    out = sharding.shuffle_into_shards(docs, 40, bin_rows=30)
    rows = out.collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(5003))
    sizes = {}
    for r in rows:
        sizes.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(sizes) == list(range(40)) and {len(s) for s in sizes.values()} == {125, 126}
    assert all(sorted(s) == list(range(len(s))) for s in sizes.values())
    # neighbours in the input don't stay together: mean shard of each tenth is near the middle
    for k in range(10):
        part = [r["shard"] for r in rows if r["doc_id"] // 501 == k]
        assert abs(np.mean(part) - 19.5) < 2.5
    order = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    ids = np.array([r["doc_id"] for r in order])
    assert abs(np.corrcoef(ids, np.arange(len(ids)))[0, 1]) < 0.06


def test_same_seed_same_places(spark):
    docs = spark.range(0, 300, 1, 3).select(F.col("id").alias("doc_id"))
    a, b, c = ({tuple(r) for r in sharding.shuffle_into_shards(docs, 7, seed=s).collect()} for s in (1, 1, 2))
    assert a == b != c


def test_edges_and_empty(edge, empty):
    out = sharding.shuffle_into_shards(edge, 4)
    rows = out.collect()
    assert len(rows) == len(EDGE) and out.columns[-2:] == ["shard", "slot"] and out.columns.count("shard") == 1
    assert sorted(r["shard"] for r in rows) == sorted([0, 0, 0, 1, 1, 1, 2, 2, 3, 3])
    assert sharding.shuffle_into_shards(empty, 4).count() == 0
    assert sorted(r["shard"] for r in sharding.shuffle_into_shards(edge.limit(2), 40).collect()) == [0, 1]
