import hashlib
import random
import sys
from collections import Counter

import numpy as np
import pytest

from lakesmith.llm import alignment as al
from lakesmith.llm import sparse

from .conftest import EDGE

FOLDER = "/opt/tokenizers"


@pytest.fixture(scope="module")
def files():
    return al.Tokenizers.read(FOLDER)


def plain_tokens(files):
    """Encoders straight from the libraries, token bytes by their decoders' rules."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(f"{FOLDER}/byte_bpe_50k.json")
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=f"{FOLDER}/piece_bpe_32k.model")
    letters = al.byte_alphabet()

    def encode(text):
        x = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        y = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
             for i in b.encode(text)]
        return x, y
    return encode


def spans(tokens):
    out, at = [], 0
    for i, part in tokens:
        out.append((i, at, at + len(part)))
        at += len(part)
    return out


def plain(docs, encode):
    """The contract by brute force: every pair of tokens of every group is formed."""
    made = []
    for doc_id, text in docs:
        x, y = encode(text) if text else ([], [])
        whole = (" " + (text or "")).encode()
        if any(b"".join(p for _, p in side) != whole for side in (x, y)):
            x = y = []
        a, b = spans(x), spans(y)
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups = [([t for t in a if low < t[2] <= high], [t for t in b if low < t[2] <= high])
                  for low, high in zip([0, *cuts], cuts)]
        links = [(i, j) for p, q in groups for i, *_ in p for j, *_ in q]
        overlaps = sum(s < v and u < e for p, q in groups for _, s, e in p for _, u, v in q)
        digest = ";".join(",".join(str(t[0]) for t in p) + "|" + ",".join(str(t[0]) for t in q) for p, q in groups)
        made.append((doc_id, len(a), len(b), len(groups), links, overlaps, hashlib.sha256(digest.encode()).hexdigest() if digest else ""))
    held = Counter(pair for m in made for pair in set(m[4]))
    best: dict[int, int] = {}
    for (i, _), n in held.items():
        best[i] = max(best.get(i, 0), n)
    return sorted([(d, na, nb, g, len(links), o, sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links), s)
                   for d, na, nb, g, links, o, s in made], key=str)


def texts():
    rng = random.Random(3)
    odd = ["<|endoftext|> and <s> </s> <unk>", "a  b   c", " leading", "trailing ", "tab\tnew\nline\r\n", "▁lower bar", "é é ﬁ",
           "日本語のテキスト and 🙂🙂", "x" * 300, "1234567890" * 30, "\x00\x01", "  wide", "Mixed-Case_words.And/paths", "<0x41>", " ", "\n"]
    words = ["the", "quick", "Brown", "über", "naïve", "tokenization", "12,5", "don't", "…", "日本"]
    return odd + [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(60)]


@pytest.mark.parametrize("head", [0, 30, 1 << 20])
def test_equals_plain_version(spark, make, files, head):
    docs = list(enumerate(texts())) + [(1000, None), (1001, ""), (1002, texts()[40])]
    got = al.align(make(docs).repartition(3), files, head=head)
    assert got.columns == ["doc_id", *al.ADDED]
    want = plain(docs, plain_tokens(files))
    order = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_overlaps", "n_best", "count_sum", "groups_sha256"]
    assert sorted([tuple(r) for r in got.select(*order).collect()], key=str) == want
    assert any(w[1] == 0 and d[1] for w, d in zip(sorted(want), sorted(docs)))  # some text is not returned byte by byte


def test_chunks_change_nothing(make, files, monkeypatch):
    docs = list(enumerate(texts()))
    want = sorted(tuple(r) for r in al.align(make(docs), files).collect())
    monkeypatch.setattr(al, "CHUNK_BYTES", 100)
    monkeypatch.setattr(al, "COUNTED_AT_ONCE", 50)
    assert sorted(tuple(r) for r in al.align(make(docs), files).collect()) == want


def test_edges(edge, empty, files):
    rows = al.align(edge, files).collect()
    want = plain([(r[0], r[1]) for r in EDGE if len(r[1] or "") < 1000], plain_tokens(files))
    assert len(rows) == len(EDGE) and sum(r["doc_id"] is None for r in rows) == 2
    short = [r for r in rows if r["n_a"] < 1000]
    key = lambda r: (str(r[0]), r[1:6], r[8])  # noqa: E731 - pair counts also see the long texts
    assert sorted(key(tuple(r[c] for c in ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_overlaps", "n_best", "count_sum",
                                           "groups_sha256"])) for r in short) == sorted(key(w) for w in want)
    assert al.align(empty, files).count() == 0


def test_row_products_equal_dense_products():
    rng = np.random.default_rng(4)
    for most in (1, 7, 10_000):
        left, right = rng.integers(0, 3, (13, 9)) * (rng.random((13, 9)) < 0.4), rng.integers(0, 3, (9, 11)) * (rng.random((9, 11)) < 0.5)

        def csr(m):
            i, j = np.nonzero(m)
            reps = m[i, j]
            return sparse.Csr.of(np.repeat(i, reps), np.repeat(j, reps), m.shape)
        out = np.zeros((13, 11), np.int64)
        for r, c, v in sparse.row_products(csr(left), csr(right), most):
            np.add.at(out, (r, c), v)
        assert (out == left @ right).all()
        t = csr(left).transpose()
        back = np.zeros((9, 13), np.int64)
        back[t.row_of_entry(), t.indices] = t.values
        assert (back == left.T).all()


def test_pairs_survive_packing():
    rng = np.random.default_rng(5)
    pairs = np.unique(rng.integers(0, 1 << 48, 5000))
    links = rng.integers(1, 1 << 40, len(pairs))
    back = al.unpack_pairs(al.pack_pairs(pairs, links))
    assert (back[0] == pairs).all() and (back[1] == links).all()
    assert al.pack_pairs(pairs[:0], links[:0]) == b"" and len(al.unpack_pairs(b"")[0]) == 0


def test_one_large_group_is_not_expanded(make, files):
    """Tokens that never end together until the text ends: links are counted by id, not pair by pair."""
    n = 40_000
    a, b = [[1] * n], [[1, *[2] * (n - 1), 1]]
    sizes_a, sizes_b = np.array([1, 2]), np.array([1, 1, 2])
    out = al.align_chunk(a, b, sizes_a, sizes_b)
    assert out.counts.tolist() == [[n, n + 1, 1, n * (n + 1), 2 * n]]
    assert out.pairs.tolist() == [(1 << 32) | 1, (1 << 32) | 2] and out.links.tolist() == [2 * n, n * (n - 1)]
    assert sys.getsizeof(out.groups[0]) < 10 * n


def test_units_equal_whole_texts(files):
    """Texts cut at blanks give what the whole texts give."""
    a, b = files.load()
    assert a.cuts_at_blanks and b.cuts_at_blanks
    rng = random.Random(8)
    letters = "abcdefgh ABC  \t\n\r0123,.;'-_()<>/é ß ñ … “x” ’s  "
    many = ["".join(rng.choices(letters, k=rng.randint(1, 200))) for _ in range(600)] + texts()
    fast, slow = al._Aligner(a, b), al._Aligner(a, b)
    slow.cuts = False
    want = slow.align(many)
    for out in (fast.align(many), fast.align(many)):
        assert out.groups == want.groups and (out.counts == want.counts).all()
        assert (out.bounds == want.bounds).all() and (out.pairs == want.pairs).all() and (out.links == want.links).all()
    assert len(fast.numbers) > 100 and fast.good.mean() > 0.9


def test_remembered_units_are_bounded(files, monkeypatch):
    monkeypatch.setattr(al, "UNITS_HELD", 5)
    aligner = al._Aligner(*files.load())
    first = [aligner.align([t]).groups for t in texts()]
    assert first == [al._Aligner(aligner.a, aligner.b).align([t]).groups for t in texts()]
    assert len(aligner.numbers) < 100
