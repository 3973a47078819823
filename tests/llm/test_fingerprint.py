import hashlib
import random
import re

import pytest

from lakesmith.llm import fingerprint as fp

from .conftest import EDGE


def plain_pieces(text):
    return set(re.findall(rf"[^\n]{{1,{fp.SHORT}}}", text[:fp.OPENING])) | set(re.findall(rf"[^\n]{{1,{fp.LONG}}}", text[fp.OPENING:]))


def plain_likeness(a, b):
    a, b = plain_pieces(a), plain_pieces(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def check(rows, docs):
    docs = sorted(docs)
    for k, (i, text) in enumerate(docs):
        following = docs[(k + 1) % len(docs)][1]
        n = len(text) // 4
        edited = text[:len(text) - n] + following[:n]
        r = rows[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r["near_edited"] == pytest.approx(plain_likeness(text, edited))
        assert r["near_next"] == pytest.approx(plain_likeness(text, following))


def random_docs(seed, n):
    rng = random.Random(seed)
    words = ["alpha", "beta", "é", "\n", "😀", "gamma delta", "."]
    docs = [(i * 3 - 5, "".join(rng.choice(words) + rng.choice(" \n ") for _ in range(rng.choice([0, 1, 5, 60, 900])))) for i in range(n)]
    docs[4] = (docs[4][0], docs[3][1])
    docs[7] = (docs[7][0], docs[6][1] + "tail")
    return docs


def test_equals_brute_force(make):
    docs = random_docs(1, 40)
    rows = {r["id"]: r for r in fp.edited_fingerprints(make(docs)).collect()}
    assert len(rows) == len(docs)
    check(rows, docs)
    by_text = {}
    for i, t in docs:
        by_text.setdefault(t, set()).add(rows[i]["fingerprint"])
    assert all(len(x) == 1 for x in by_text.values())


def test_small_sketches_are_retried(make, monkeypatch):
    monkeypatch.setattr(fp, "WIDTH", 1)
    monkeypatch.setattr(fp, "RETRY_WIDTH", 4)
    monkeypatch.setattr(fp, "ROUNDS", 1)
    docs = random_docs(2, 14)
    check({r["id"]: r for r in fp.edited_fingerprints(make(docs)).collect()}, docs)


def test_edges_and_empty(edge, empty, make):
    rows = fp.edited_fingerprints(edge).collect()
    assert len(rows) == len(EDGE)
    assert all(r["fingerprint"] == "" for r in rows if r["n_chars"] == 0)
    assert len([r for r in rows if r["id"] == 1]) == 2
    assert fp.edited_fingerprints(empty).count() == 0
    lone = fp.edited_fingerprints(make([(1, "abcdefgh" * 30)])).first()
    assert lone["near_next"] == 1.0


def test_no_python(edge):
    plan = fp.edited_fingerprints(edge)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
