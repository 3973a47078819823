import random

import pytest

from lakesmith.llm import line_dedup as ld

from .conftest import EDGE


def plain(docs, m, words=10**9, whole=True):
    """docs: distinct (id, text) in order -> {(id, text): (removed lines, kept text)}: every run that
    stands earlier, of any length, is looked at."""
    seen, out = set(), {}
    for i, text in docs:
        lines = (text or "").split("\n")
        full = [k for k, x in enumerate(lines) if x.strip(" ")]
        gone = set()
        for p in range(len(full)):
            for n in range(1, len(full) - p + 1):
                run = tuple(lines[k] for k in full[p:p + n])
                counts = n >= m or sum(len(x.split()) for x in run) >= words or (whole and n == len(full))
                if counts and run in seen:
                    gone |= set(full[p:p + n])
                seen.add(run)
        out[i, text] = (len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone))
    return out


def random_docs(seed, n):
    rng = random.Random(seed)
    lines = [f"line {i}" for i in range(9)] + ["", "  "]
    return [(i, "\n".join(rng.choices(lines, k=rng.randint(0, 25)))) for i in range(n)]


@pytest.mark.parametrize("m,words", [(1, 99), (2, 99), (3, 99), (3, 4), (5, 6), (6, 7)])
def test_equals_brute_force(make, m, words):
    docs = random_docs(m, 40)
    want = plain(docs, m, words)
    for r in ld.dedup_lines(make(docs), m, words).collect():
        assert (r["n_removed"], r["kept_text"]) == want[r["doc_id"], r["text"]]
        assert r["n_lines"] == len(r["text"].split("\n"))


def test_ranks_follow_the_suffix_classes(make):
    docs = [(1, "a\nb\nc\na\nb\nd"), (2, "x\na\nb\nc")]
    rows = ld.repeated_windows(make(docs), 2)[2].collect()
    by_rank = {}
    for r in rows:
        by_rank.setdefault(r["rank"], set()).add((r["id"], r["line"]))
    assert sorted(map(sorted, by_rank.values())) == [[(1, 0), (1, 3), (2, 1)], [(1, 1), (2, 2)]]


def test_long_lines_and_whole_documents(make):
    long = " ".join(f"w{i}" for i in range(50))
    docs = [(1, f"{long}\nother\nshort line\nend"), (2, f"own\n{long}\nmore"), (3, "short line\nend"), (4, "short line\nown end"), (5, "end"),
            (6, f"{long[:-4]}\nown")]
    got = {r["doc_id"]: (r["n_removed"], r["kept_text"]) for r in ld.dedup_lines(make(docs)).collect()}
    assert got == {1: (0, docs[0][1]), 2: (1, "own\nmore"), 3: (2, ""), 4: (0, docs[3][1]), 5: (1, ""), 6: (0, docs[5][1])}


def test_maximal_runs(make):
    docs = [(1, "a\nb\nc\nd\ne"), (2, "a\nb\nc\nnew\nc\nd\ne\n\nold"), (3, "short")]
    got = {r["doc_id"]: (r["n_removed"], r["runs"], r["kept_text"]) for r in ld.dedup_lines(make(docs), 3).collect()}
    assert got == {1: (0, 0, docs[0][1]), 2: (6, 2, "new\n\nold"), 3: (0, 0, "short")}


def test_edges_and_empty(edge, empty):
    out = ld.dedup_lines(edge, 1)
    rows = out.collect()
    assert len(rows) == len(EDGE) and out.columns.count("runs") == 1
    by = {}
    for r in rows:
        by.setdefault((r["doc_id"], (r["text"] or "")[:7]), []).append(r)
    # rows that repeat id and text are one document: neither removes the other
    assert [r["n_removed"] for r in by[1, "The qui"]] == [0, 0]
    assert by[4, "palabra"][0]["n_removed"] == 0 and by[5, "palabra"][0]["n_removed"] == 1
    assert by[5, "palabra"][0]["kept_text"] == "" and by[None, ""][0]["kept_text"] is None
    assert ld.dedup_lines(empty).count() == 0
