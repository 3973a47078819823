import random
import re
from collections import defaultdict

import xxhash
from pyspark.sql import functions as F

from lakesmith.llm import simhash

from .conftest import EDGE


def plain_fingerprint(text, k=4):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(fps, distance):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    todo = sorted(fps)
    for i, a in enumerate(todo):
        for b in todo[:i]:
            if (a ^ b).bit_count() <= distance:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {f: find(f) for f in fps}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprint_equals_plain_version():
    rng = random.Random(1)
    words = ["Ärger", "the", "OF", "x", "ção", "\u00a0", "1"]
    texts = [None, "", " \n", "one", "one Two three", *(" \t".join(rng.choices(words, k=n)) for n in range(2, 60))]
    for t in texts:
        assert simhash.fingerprint(t) == signed(plain_fingerprint(t)), t


def _check_links(spark, fps, distance=4):
    links = simhash.near_links(spark.createDataFrame([(signed(f),) for f in fps], "fp long"), distance).collect()
    got = {f: f for f in fps}
    parent = {signed(f): signed(f) for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for r in links:
        assert ((r["a"] ^ r["b"]) & (2**64 - 1)).bit_count() <= distance
        parent[max(find(r["a"]), find(r["b"]))] = min(find(r["a"]), find(r["b"]))
    want = plain_classes(fps, distance)
    groups, wanted = defaultdict(set), defaultdict(set)
    for f in got:
        groups[find(signed(f))].add(f)
        wanted[want[f]].add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def _near_family(seed, center_count, each):
    rng = random.Random(seed)
    out = set()
    for _ in range(center_count):
        center = rng.getrandbits(64)
        for _ in range(each):
            out.add(center ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))))
    return out


def test_links_join_the_same_classes_as_all_pairs(spark):
    _check_links(spark, _near_family(2, 12, 25) | {0, 2**64 - 1})


def test_keys_with_many_fingerprints_are_split(spark, monkeypatch):
    monkeypatch.setattr(simhash, "RUN", 8)
    _check_links(spark, _near_family(3, 2, 90))


def test_classes_of_documents(make):
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()
    docs = make([(9, " ".join(base)), (3, " ".join(base).upper()), (7, "something else entirely in this text"), (5, ""), (8, None)])
    got = {r["__id"]: r["component_id"] for r in simhash.near_duplicate_classes(docs).collect()}
    assert got == {9: 3, 3: 3, 7: 7, 5: 5, 8: 5}


def test_edges_and_empty(edge, empty):
    out = simhash.near_duplicates(edge)
    rows = out.collect()
    assert len(rows) == len(EDGE) and out.columns.count("fingerprint") == 1
    by_text = {(r["doc_id"], r["text"]): r for r in rows}
    assert by_text[3, None]["fingerprint"] == "0" * 16 == by_text[2, ""]["fingerprint"]
    assert by_text[None, None]["component_id"] == 2 and by_text[5, EDGE[6][1]]["component_id"] == 4
    assert by_text[None, EDGE[4][1]]["component_id"] is None
    assert simhash.near_duplicates(empty).count() == 0


def test_keep_one(edge, empty):
    kept = simhash.keep_one_per_group(edge)
    assert kept.columns == edge.columns
    assert sorted((r["doc_id"] or 0, (r["text"] or "")[:9]) for r in kept.collect()) == [
        (0, "A text wi"), (1, "The quick"), (2, ""), (4, "palabra l"), (5, "another t")]
    assert simhash.keep_one_per_group(empty).count() == 0


def test_components_survive_repeats_and_loops(spark):
    from lakesmith.llm.components import connected_components
    rng = random.Random(5)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 160)]
    edges += [(b, a) for a, b in edges[:10]] + [(3, 3)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a != b:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in list(parent)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).where(F.lit(True)).count() == 0
