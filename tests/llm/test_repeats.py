import random

import numpy as np
import pytest

from lakesmith.llm import repeats, suffix

from .conftest import EDGE


def plain(docs, length):
    """docs: (id, bytes) by id -> {id: (removed, spans, kept)}, ids distinct."""
    seen, out = set(), {}
    for i, b in sorted(docs):
        mask, new = bytearray(len(b)), set()
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            if w in seen:
                mask[p:p + length] = b"\1" * length
            new.add(w)
        seen |= new
        spans = sum(1 for p in range(len(b)) if mask[p] and (p == 0 or not mask[p - 1]))
        out[i] = (sum(mask), spans, bytes(x for x, m in zip(b, mask) if not m))
    return out


def random_docs(seed, n):
    rng = random.Random(seed)
    passages = ["".join(rng.choices("abcdé \n", k=rng.randint(30, 150))) for _ in range(8)]
    docs = []
    for i in range(n):
        parts = ["".join(rng.choices("abcdefgh é\0", k=rng.randint(0, 80))) if rng.random() < 0.5 else rng.choice(passages)
                 for _ in range(rng.randint(0, 6))]
        docs.append((i, "".join(parts)))
    docs += [(n, "z" * 400), (n + 1, "y" * 20 + "z" * 300), (n + 2, docs[3][1]), (n + 3, docs[3][1]), (n + 4, "\0" * 130)]
    return docs + [(n + 5, "\0" * 90), (n + 6, "ab" * 1500), (n + 7, "x" + "ab" * 1400)]


@pytest.mark.parametrize("length,gram,hot,shard", [(50, 16, 20_000, 1 << 22), (50, 32, 20_000, 1 << 22), (50, 16, 2, 300),
                                                   (20, 8, 1, 1 << 22), (16, 16, 5, 1)])
def test_equals_brute_force(make, monkeypatch, length, gram, hot, shard):
    monkeypatch.setattr(repeats, "SHARD_BYTES", shard)
    monkeypatch.setattr(repeats, "SEGMENT_WINDOWS", 100)
    monkeypatch.setattr(repeats, "HASHED_AT_ONCE", 300 if shard == 300 else 1 << 20)
    docs = random_docs(length + hot, 60)
    want = plain([(i, t.encode()) for i, t in docs], length)
    rows = repeats.cut_repeats(make(docs), length, gram, hot=hot).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert (r["n_removed"], r["n_spans"], bytes(r["kept"])) == want[r["no"]], r["no"]
    assert sum(x[0] for x in want.values()) > 1000


@pytest.mark.parametrize("small_alphabet", [3, 1024])
def test_suffix_array(monkeypatch, small_alphabet):
    monkeypatch.setattr(suffix, "BUCKETED_ALPHABET", small_alphabet)
    rng = random.Random(small_alphabet)
    for _ in range(200):
        k = rng.choice([1, 2, 4, 250])
        s = [rng.randint(1, k) for _ in range(rng.randint(0, 70))] + [0]
        order = suffix.suffix_array(np.array(s, np.uint16), k + 1)
        assert order.tolist() == sorted(range(len(s)), key=lambda i: s[i:])


def test_common_prefixes():
    rng = random.Random(8)
    data = bytes(rng.choices(b"ab\0", k=300)) * 2
    order = np.array(sorted(range(len(data)), key=lambda i: data[i:]))
    got = suffix.common_prefixes(np.frombuffer(data, np.uint8), order, 50)
    for a, b in zip(order[:-1], order[1:]):
        n = 0
        while n < 50 and max(a, b) + n < len(data) and data[a + n] == data[b + n]:
            n += 1
        # past the end the data counts as zero bytes; callers keep only whole windows
        assert got[b] == n or max(a, b) + n == len(data)


def test_equal_windows_have_equal_anchors():
    rng = random.Random(4)
    window = bytes(rng.choices(b"abcdef ", k=50))
    found = set()
    for _ in range(20):
        left, right = (bytes(rng.choices(b"abcdef ", k=rng.randint(0, 60))) for _ in range(2))
        found.add(int(repeats.window_anchors(np.frombuffer(left + window + right, np.uint8))[len(left)]))
    assert len(found) == 1


def test_edges_and_empty(edge, empty):
    out = repeats.remove_repeats(edge)
    rows = out.collect()
    assert len(rows) == len(EDGE) and out.columns.count("n_bytes") == 1
    by = {}
    for r in rows:
        by.setdefault((r["doc_id"], (r["text"] or "")[:7]), []).append(r)
    assert [r["n_removed"] for r in by[1, "The qui"]] == [0, 0]
    assert by[5, "palabra"][0]["n_removed"] == by[5, "palabra"][0]["n_bytes"] == len(EDGE[7][1])
    assert by[5, "palabra"][0]["n_spans"] == 1 and bytes(by[5, "palabra"][0]["kept"]) == b""
    assert by[4, "palabra"][0]["n_removed"] == 0 and by[3, ""][0]["n_bytes"] == 0
    assert by[None, "A text "][0]["n_removed"] == 0
    assert repeats.remove_repeats(empty).count() == 0


def test_null_ids_come_last(make):
    text = "a passage that is longer than fifty bytes and stands in several documents"
    rows = repeats.cut_repeats(make([(None, "u " + text), (7, "v " + text), (None, "w " + text)])).collect()
    assert sorted((r["no"] == repeats.LAST, r["n_removed"]) for r in rows) == [(False, 0), (True, len(text) + 1), (True, len(text) + 1)]


def test_texts_that_share_a_digest_keep_their_bytes(make, monkeypatch):
    """With a digest that half of all texts share, none gets another one's cuts
    (strings that only such texts share may stay: they look like one text)."""
    from pyspark.sql import functions as F
    real = F.xxhash64
    monkeypatch.setattr(repeats.F, "xxhash64", lambda *c: real(*c) if len(c) > 1 else F.length(c[0]).cast("long") % 2)
    docs = random_docs(77, 40) + [(None, "a null id with a text of its own that is longer than fifty bytes, surely")]
    want = plain([(repeats.LAST if i is None else i, t.encode()) for i, t in docs], 50)
    rows = repeats.cut_repeats(make(docs)).collect()
    assert len(rows) == len(docs) and sum(r["n_removed"] for r in rows) > 500
    assert all(r["n_removed"] <= want[r["no"]][0] for r in rows)
    assert {r["n_removed"] for r in rows if want[r["no"]][0] == 0} == {0}


def test_many_null_ids_keep_their_own_bytes(make):
    """Null ids share one place in the order; none loses bytes to another."""
    rng = random.Random(3)
    docs = [(None, f"{i} " + "".join(rng.choices("abcdefgh ", k=120))) for i in range(300)]
    passage = "a passage that is longer than fifty bytes and stands in several documents"
    docs += [(1, "x " + passage), (None, "y " + passage)]
    got = [r["n_removed"] for r in repeats.cut_repeats(make(docs)).collect()]
    assert sorted(got)[-2:] == [0, len(passage) + 1]


def test_large_alphabets_are_induced():
    rng = random.Random(6)
    for k in (5, 3000):
        s = [rng.randint(1, k) for _ in range(4000)]
        s = np.array(s + s[:2000] + [0], np.int64)
        order = suffix.suffix_array(s, 5000)
        values = s.tolist()
        assert order.tolist() == sorted(range(len(s)), key=lambda i: values[i:i + 4100])
