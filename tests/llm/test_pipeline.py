from collections import Counter, defaultdict

import corpus_pipeline as p
import pytest
import regex

from lakesmith.llm import mixing, simhash
from lakesmith.llm.common import staged, table

from .test_decontaminate import all_overlaps
from .test_simhash import plain_classes, plain_fingerprint

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = table(spark, SF, "documents"), []
    for name, stage in p.STAGES:
        docs = staged(stage(spark, docs, SF), name)
        out.append((name, docs))
    return dict(out)


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stage_names_and_columns(spark, steps):
    columns = table(spark, SF, "documents").columns
    assert [n for n, _ in p.STAGES] == ["toxicity", "simhash", "decontamination", "mixing", "sharding"]
    assert all(steps[n].columns == columns for n in list(steps)[:-1])
    assert steps["sharding"].columns == [*columns, "shard", "slot"]


def test_toxicity_stage_drops_mostly_toxic_documents(spark, steps):
    toxic = {r["doc_id"] for r in table(spark, SF, "labels").where("toxic = 1").collect()}
    before, after = set(ids(table(spark, SF, "documents"))), set(ids(steps["toxicity"]))
    gone = before - after
    labelled = {r["doc_id"] for r in table(spark, SF, "labels").collect()}
    assert after < before and len(gone & labelled - toxic) <= 0.2 * len(gone & labelled)


def test_simhash_stage_equals_brute_force(steps):
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in steps["toxicity"].collect()]
    root = plain_classes({f for _, f in rows}, 4)
    first = {}
    for i, f in rows:
        first[root[f]] = min(i, first.get(root[f], i))
    assert ids(steps["simhash"]) == sorted(first.values())


def overlaps_any(doc, item):
    """The documented rule at every alignment that has enough equal tokens at all."""
    places = defaultdict(list)
    for i, t in enumerate(doc):
        places[t].append(i)
    shifts = Counter(i - k for k, t in enumerate(item) for i in places[t])
    needed = len(item) if len(item) < 6 else min(13, -(-8 * len(item) // 10))
    for shift, n in shifts.items():
        if n >= needed:
            part = doc[max(0, shift):max(0, shift) + len(item)]
            if all_overlaps(part, item):
                return True
    return False


def test_decontamination_stage(spark, steps):
    bench = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    tokens = lambda text: regex.findall(r"[\p{L}\p{N}]+", text.lower())
    items = [tokens(t) for _, t in bench]
    rows = steps["simhash"].collect()
    want = sorted(r["doc_id"] for r in rows if not any(overlaps_any(tokens(r["text"]), item) for item in items))
    assert ids(steps["decontamination"]) == want and len(want) < len(rows)
    # whole items never pass
    kept = [" ".join(r["text"].lower().split()) for r in steps["decontamination"].collect()]
    assert not any(" ".join(t.lower().split()) in k for _, t in bench if len(t.split()) >= 8 for k in kept)


def test_mixing_and_sharding_stages(steps):
    mixed = mixing.mix(steps["decontamination"]).where("sampled")
    assert ids(mixed) == ids(steps["mixing"]) == ids(steps["sharding"])
    sizes = [r["count"] for r in steps["sharding"].groupBy("shard").count().collect()]
    assert max(sizes) - min(sizes) <= 1


def test_edges(spark, edge, empty):
    for name, stage in p.STAGES:
        out = stage(spark, empty, SF)
        assert out.count() == 0, name
        assert stage(spark, edge, SF).count() <= edge.count(), name
    assert simhash.keep_one_per_group(edge).count() == 5
