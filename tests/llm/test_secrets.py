import math
import random
import re

import pytest
from pyspark.sql import functions as F

from lakesmith.llm import secrets as s

from .conftest import EDGE

ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def plain_base(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def plain_windows(value, level):
    out = []
    for i in range(len(value) - s.WINDOW + 1):
        w = value[i:i + s.WINDOW]
        bits = -sum(c / len(w) * math.log2(c / len(w)) for c in map(w.count, set(w)))
        if bits >= level - 1e-9:
            if out and out[-1][1] >= i:
                out[-1] = (out[-1][0], i + s.WINDOW)
            else:
                out.append((i, i + s.WINDOW))
    return out


def plain_candidates(text):
    """Runs of a window of key characters or more with a digit, or with two changes from upper to lower case."""
    for m in re.finditer(rf"[{s._KEY}]+={{0,2}}", text):
        run = m[0].rstrip("=")
        letters = "".join(c for c in run if c.isalpha())
        if len(run) >= s.WINDOW and (any(c.isdigit() for c in run) or sum(
                a.isupper() and b.islower() for a, b in zip(letters, letters[1:])) >= 2):
            yield m


def plain_entropy(text):
    out = []
    for m in plain_candidates(text):
        v = m[0]
        if re.fullmatch("|".join(f"(?:{p})" for p in s.ALLOWED), v):
            continue
        kind = ("entropy_hex" if re.fullmatch("[0-9a-fA-F]+", v) else "entropy_letters" if v.isalpha() else
                "entropy_alnum" if re.fullmatch("[A-Za-z0-9]+", v) else "entropy_base64")
        out += [(m.start() + a, s.KINDS.index(kind), m.start() + b) for a, b in plain_windows(v, s.THRESHOLDS[kind])]
    return out


def random_texts():
    rng = random.Random(9)
    key = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    parts = ["password", "token", "Secret", "api_key", "APIKEY", "=", ":", " ", '"', "'", "abc", "é😀", "\n", "AKIA", "x.y",
             "AKIAABCDEFGHIJKL", "AKIA12", "deadbeef" * 4, "0" * 40, "token:secret:abcdefgh1", "a" * 31]
    for _ in range(150):
        bits = [rng.choice(parts) if rng.random() < 0.8 else "".join(rng.choices(key, k=rng.randint(15, 45)))
                for _ in range(rng.randint(1, 14))]
        yield "".join(bits)
    yield from ("".join(rng.choices("0123456789abcdef", k=60)) + "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa1" for _ in range(3))
    yield "id 123e4567-e89b-12d3-a456-426614174000 2024-01-01/2024-02-02/extra path/to/some/file/version_12"


def test_spans_equal_plain_version(make):
    texts = list(random_texts())
    rows = s.find_secrets(make(list(enumerate(texts)))).collect()
    assert len(rows) == len(texts)
    entropy = 0
    for r in rows:
        base, more = plain_base(texts[r["doc_id"]]), plain_entropy(texts[r["doc_id"]])
        more = [m for m in more if not any(b[0] <= m[0] and m[2] <= b[2] for b in base)]
        entropy += len(more)
        assert [(x["start"], x["rank"], x["end"]) for x in r["spans"]] == sorted(base + more), texts[r["doc_id"]]
    assert entropy > 10


def test_allow_list(make):
    rng = random.Random(2)
    secret = "".join(rng.sample("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", 30)) + "9"
    docs = make([(1, f"k {secret} k"), (2, "k 123e4567-e89b-12d3-a456-426614174000 k"), (3, f"k EXAMPLE{secret} k")])
    got = {r["doc_id"]: [x["kind"] for x in r["spans"]] for r in s.find_secrets(docs).collect()}
    assert got == {1: ["entropy_alnum"], 2: [], 3: []}
    assert {r["doc_id"]: len(r["spans"]) for r in s.find_secrets(docs, allowed=()).collect()}[3] >= 1


def test_allow_list_clears_no_random_parts(make):
    random_key = "q8Zr2LwX5vTn9KbY3mHc7PfJ1sGd6RaE4uWo0Nix"
    keys = ["7-F3kQ9zLmX2vB8nT-Yc5RwP1sDh6JgKe", "4821-K7Q9ZL-X2VB8N-TYC5RW", f"example/keys/{random_key}"]
    fine = ["2024/05/17/some-long-title-of-2-words", "archive/2024-05/Report_FINAL-12", f"path/to/EXAMPLE{random_key}",
            "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY9"]
    docs = make([(i, f"k {v} k") for i, v in enumerate(keys + fine)])
    got = {r["doc_id"] for r in s.find_secrets(docs).collect() if r["spans"]}
    assert got == set(range(len(keys)))


def test_redaction(make):
    docs = make([(1, "é password=abcdefgh12 and " + "0123456789abcdef" * 2 + " end"), (2, None), (3, "clean")])
    got = {r["doc_id"]: r["text"] for r in s.redact(docs).collect()}
    assert got == {1: "é [secret] and [secret] end", 2: None, 3: "clean"}


def test_edges_and_no_python(edge, empty):
    out = s.find_secrets(edge)
    assert out.columns.count("spans") == 1
    rows = out.collect()
    assert len(rows) == len(EDGE) and all(r["spans"] == [] for r in rows)
    assert s.find_secrets(empty).count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Exchange", plan)


@pytest.mark.parametrize("n", [20, 3000])
def test_long_candidates(make, n):
    rng = random.Random(n)
    text = "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=n)) + "7"
    rows = s.find_secrets(make([(1, text)])).select(F.col("spans")).first()[0]
    assert [(x["start"], x["rank"], x["end"]) for x in rows] == plain_entropy(text)


@pytest.mark.parametrize("length", [16, 17, 19])
def test_short_keys_and_letters(make, length):
    rng = random.Random(length)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    keys = ["".join(rng.sample(letters + "0123456789", length - 1)) + "7", "aB" + "".join(rng.sample(letters, length - 4)) + "qR"]
    plain = ["internationalisation", "Donaudampfschifffahrt", "INTERNATIONALISATION", "src/main/java/Example"]
    docs = make([(i, f"k {v} k") for i, v in enumerate(keys + plain)])
    found = {r["doc_id"]: [x["kind"] for x in r["spans"]] for r in s.find_secrets(docs).collect()}
    assert found == {0: ["entropy_alnum"], 1: ["entropy_letters"], 2: [], 3: [], 4: [], 5: []}


SHAPES = {"words": ("ab-1-", ""), "words and number": ("word/", "12"), "path": ("a/", "1z"), "numbers": ("12-", ""),
          "slug": ("Some-", "2"), "sample": ("EXAMPLE/", "1"), "plain words": ("Word_", "End")}


@pytest.mark.parametrize("shape", SHAPES)
def test_long_runs_of_every_allowed_shape(make, shape):
    part, end = SHAPES[shape]
    for n in (1_000, 200_000) if shape != "words" else (1_000,):
        text = "k " + part * n + end + " k"
        rows = s.find_secrets(make([(1, text)])).collect()
        if part.startswith(("word", "12", "Some", "EXAMPLE", "Word")):
            assert rows[0]["spans"] == [], shape


def test_million_random_characters(make):
    rng = random.Random(5)
    part = "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", k=20_000)) + "a" * 40
    text = part * 50
    row = s.find_secrets(make([(1, text)])).select(F.size("spans"), F.array_max(F.transform("spans", lambda x: x["end"]))).first()
    first = plain_entropy(part)
    assert row[0] >= 50 * len(first) // 2 and row[1] <= len(text)


def test_blocks_change_nothing(make, monkeypatch):
    rng = random.Random(7)
    text = " ".join("".join(rng.choices("abcABC012" if i % 2 else "ABCDEFGHIJabcdefghij0123456789+/", k=rng.randint(16, 300))) + "1"
                    for i in range(30))
    monkeypatch.setattr(s, "BLOCK", 8)
    rows = s.find_secrets(make([(1, text)])).first()["spans"]
    assert [(x["start"], x["rank"], x["end"]) for x in rows if x["rank"] > 2] == plain_entropy(text)
