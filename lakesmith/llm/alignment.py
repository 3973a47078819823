"""Links between the tokens that two tokenizers give a text (operator 13).

Both tokenizers cut the same bytes, so tokens meet over bytes:

1. Per text, tokens x bytes incidence matrices in compressed rows; the product
   A.B' by rows (Gustavson) has a cell for every overlapping pair of tokens.
   Offsets where tokens of both end cut the text into groups; incidences of
   token ids with groups, multiplied likewise, count the links of every id pair.
   Groups are never expanded pair by pair: equal ids inside one count once.
   A blank after a non-blank ends tokens of both sides, so no group crosses it:
   texts of ordinary characters are cut there into units, and each task aligns
   a unit once and adds up the units of its texts.  Other texts are aligned whole.
2. The rows are written once, each text's id pairs packed into a few bytes a
   pair, so no text is tokenized twice.  Tasks count documents per id pair
   before the counts are shuffled.
3. Pairs held by the most documents (at most ``HEAD``: a fixed bound) go to all
   tasks, which settle most links where they are.  The other pairs are joined
   by key; as each is rare, no key of that join is hot.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesmith.llm.common import col, staged
from lakesmith.llm.sparse import Csr, add_equal, row_products, runs

#: Text bytes tokenized and multiplied at a time.
CHUNK_BYTES = 1 << 20
#: Different units that a task remembers, and units tokenized at a time.
UNITS_HELD, UNITS_AT_ONCE = 1 << 18, 1 << 13
#: Id pairs that a task counts before it passes them on.
COUNTED_AT_ONCE = 1 << 21
#: Most id pairs known to all tasks.
HEAD = 1 << 20
ADDED = ["n_a", "n_b", "n_groups", "n_links", "n_overlaps", "n_best", "count_sum", "groups_sha256"]

# Characters whose classes (letter, digit, blank) are the same to both tokenizers: ASCII text, Latin
# letters, common punctuation.  Among them only the first three are blank (some pieces join a carriage return to what
# stands before it).
_ORDINARY = re.compile("[ \t\n!-~\u00a1-\u024f\u2010-\u2027]*")
_UNIT = re.compile(r"[ \t\n]+[^ \t\n]*|[^ \t\n]+")


@dataclass
class Encoder:
    """A tokenizer: ids of a space and the text for many texts, the bytes of
    every id, and whether texts may be cut into units (see above)."""
    encode: Callable[[list[str]], list[list[int]]]
    parts: list[bytes]
    cuts_at_blanks: bool

    def sizes(self) -> np.ndarray:
        return np.array([len(p) for p in self.parts], np.int64)

    def returns(self, ids: list[int], text: str) -> bool:
        return b"".join(map(self.parts.__getitem__, ids)) == text.encode()


@dataclass(frozen=True)
class Tokenizers:
    """The files of both tokenizers, read once by the driver (their size is the
    only bound that the tasks' copy of them has)."""
    byte_level: str
    pieces: bytes

    @staticmethod
    def read(folder: str, byte_level: str = "byte_bpe_50k.json", pieces: str = "piece_bpe_32k.model") -> Tokenizers:
        with open(os.path.join(folder, byte_level), encoding="utf-8") as a, open(os.path.join(folder, pieces), "rb") as b:
            return Tokenizers(a.read(), b.read())

    def load(self) -> tuple[Encoder, Encoder]:
        """Both encoders; they give the ids of a space and the text."""
        return byte_level_encoder(self.byte_level), piece_encoder(self.pieces)


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary:
    printable ones for themselves, the others from U+0100 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_level_encoder(spec: str) -> Encoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer
    made = Tokenizer.from_str(spec)
    made.encode_special_tokens = True
    plan = json.loads(spec)
    letters, vocabulary = byte_alphabet(), made.get_vocab()
    added = {t["content"] for t in plan.get("added_tokens") or ()}
    parts = [b""] * (1 + max(vocabulary.values(), default=0))
    for token, i in vocabulary.items():
        parts[i] = token.encode() if token in added else bytes(letters[ch] for ch in token)

    def encode(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in made.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]

    # the byte-level pattern never joins a non-blank to a following blank, and no merge crosses its words
    cut = plan.get("pre_tokenizer") or {}
    apart = plan.get("normalizer") is None and cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space")
    return Encoder(encode, parts, bool(apart))


def piece_encoder(spec: bytes) -> Encoder:
    import sentencepiece
    made = sentencepiece.SentencePieceProcessor(model_proto=spec)
    pieces = made.id_to_piece(list(range(made.vocab_size())))
    parts = [bytes([int(p[3:5], 16)]) if made.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]

    def encode(texts: list[str]) -> list[list[int]]:  # the model itself puts the space in front
        return made.encode(texts, num_threads=1)

    across = any(re.search(r"[^ \t\n▁][ \t\n▁]", p) for i, p in enumerate(pieces) if not made.is_control(i) and not made.is_unknown(i))
    return Encoder(encode, parts, not across)


@dataclass
class Aligned:
    """Per text of a chunk: counts, the text of its groups, and its id pairs
    (``pairs[bounds[i]:bounds[i + 1]]``, ascending) with their links."""
    counts: np.ndarray
    groups: list[str]
    pairs: np.ndarray
    links: np.ndarray
    bounds: np.ndarray


def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a.astype(np.int64) << 32) | b


def align_chunk(a_ids: list[list[int]], b_ids: list[list[int]], a_sizes: np.ndarray, b_sizes: np.ndarray) -> Aligned:
    """Align texts whose tokens of both sides join to the same bytes; a text
    without tokens has zeros."""
    flat = [np.fromiter(chain.from_iterable(ids), np.int64) for ids in (a_ids, b_ids)]
    docs = [np.repeat(np.arange(len(ids)), [len(x) for x in ids]) for ids in (a_ids, b_ids)]
    return align_tokens(len(a_ids), *(Side(ids, doc, np.cumsum(sizes[ids]), len(sizes))
                                      for ids, doc, sizes in zip(flat, docs, (a_sizes, b_sizes))))


@dataclass(frozen=True)
class Side:
    """One tokenizer's tokens of many texts end to end: ids, their texts, the
    bytes at which they end; number of ids."""
    ids: np.ndarray
    doc: np.ndarray
    end: np.ndarray
    width: int


def align_tokens(n: int, left: Side, right: Side) -> Aligned:
    """Align ``n`` texts that stand end to end in one byte space: their ends are
    ends of both sides, so nothing crosses them."""
    a, a_doc, a_end, b, b_doc, b_end = left.ids, left.doc, left.end, right.ids, right.doc, right.end
    size = int(a_end[-1]) if len(a_end) else 0
    ends_a, ends_b = np.zeros(size, bool), np.zeros(size, bool)
    ends_a[a_end - 1] = True
    ends_b[b_end - 1] = True
    # tokens x bytes
    whose_b = np.cumsum(ends_b) - ends_b
    over_bytes = Csr(np.r_[0, a_end], np.arange(size), np.ones(size, np.int64), size)
    bytes_to_b = Csr(np.arange(size + 1), whose_b, np.ones(size, np.int64), max(1, len(b)))
    overlaps = np.zeros(n, np.int64)
    open_cell = -1  # a row cut between two blocks may end and begin with one cell
    for rows, cols, _ in row_products(over_bytes, bytes_to_b):
        cells = rows * max(1, len(b)) + cols
        fresh = cells != open_cell
        overlaps += np.bincount(a_doc[rows[fresh]], minlength=n)
        open_cell = cells[-1]
    # ids x groups
    shared = ends_a & ends_b
    group_at = np.cumsum(shared) - shared
    n_groups = int(shared.sum())
    a_group, b_group = group_at[a_end - 1], group_at[b_end - 1]
    width_a, width_b = max(1, left.width), max(1, right.width)
    doc_ids, row = np.unique(a_doc * width_a + a, return_inverse=True)
    in_a = Csr.of(row, a_group, (len(doc_ids), max(1, n_groups)))
    in_b = Csr.of(b_group, b, (max(1, n_groups), width_b))
    found = [(doc_ids[r], c, v) for r, c, v in row_products(in_a, in_b)]
    who, cols, links = (np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found) if found else [()] * 3))
    cells, links = add_equal(who * width_b + cols, links)
    who, cols = cells // width_b, cells % width_b
    doc = who // width_a
    pairs = pair_key(who % width_a, cols)
    bounds = np.r_[0, np.cumsum(np.bincount(doc, minlength=n))]
    totals = np.zeros(n, np.int64)
    np.add.at(totals, doc, links)
    group_doc = a_doc[np.searchsorted(a_group, np.arange(n_groups))] if n_groups else np.zeros(0, np.int64)
    counts = np.stack([np.bincount(a_doc, minlength=n), np.bincount(b_doc, minlength=n),
                       np.bincount(group_doc, minlength=n), totals, overlaps], axis=1)
    return Aligned(counts, _group_texts(n, a, a_doc, a_group, b, b_group, n_groups, counts), pairs, links, bounds)


def _group_texts(n, a, a_doc, a_group, b, b_group, n_groups, counts) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` of every text."""
    in_a, in_b = np.bincount(a_group, minlength=n_groups), np.bincount(b_group, minlength=n_groups)
    start = np.cumsum(in_a + in_b) - in_a - in_b
    a_first, b_first = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
    ids, marks = np.empty(len(a) + len(b), np.int64), np.zeros(len(a) + len(b), np.int64)
    ids[start[a_group] + np.arange(len(a)) - a_first[a_group]] = a
    ids[start[b_group] + in_a[b_group] + np.arange(len(b)) - b_first[b_group]] = b
    marks[start + in_a - 1] = 1
    marks[start + in_a + in_b - 1] = 2
    most = int(ids.max()) + 1 if len(ids) else 1
    known, where = np.unique(marks * most + ids, return_inverse=True)
    written = [f"{x % most}{',|;'[x // most]}" for x in known.tolist()]
    ends = np.cumsum(counts[:, 0] + counts[:, 1])
    flat = where.tolist()
    return ["".join(map(written.__getitem__, flat[low:high]))[:-1]
            for low, high in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist())]


# -- id pairs of a text as bytes -------------------------------------------------

def pack_pairs(pairs: np.ndarray, links: np.ndarray) -> bytes:
    """Ascending keys and their links; differences, byte plane by byte plane, compressed."""
    if not len(pairs):
        return b""
    table = np.stack([np.diff(pairs, prepend=0), links]).astype("<i8")
    planes = np.ascontiguousarray(table.reshape(-1).view(np.uint8).reshape(-1, 8).T).tobytes()
    return len(pairs).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(planes, asbytes=True)


def unpack_pairs(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    if not packed:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    n = int.from_bytes(packed[:8], "little")
    planes = pa.Codec("zstd").decompress(packed[8:], 16 * n, asbytes=True)
    table = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view("<i8").reshape(2, n)
    return np.cumsum(table[0]), table[1]


# -- Spark ----------------------------------------------------------------------

_KEPT = ["n_a", "n_b", "n_groups", "n_links", "n_overlaps"]


def _chunks(texts: pa.Array) -> Iterator[list[str]]:
    held, size = [], 0
    for t in texts:
        held.append(t.as_py() or "")
        size += len(held[-1])
        if size >= CHUNK_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


class _Aligner:
    """Alignments of texts, and of the units met so far."""

    def __init__(self, a: Encoder, b: Encoder) -> None:
        self.a, self.b = a, b
        self.sizes = a.sizes(), b.sizes()
        self.cuts = a.cuts_at_blanks and b.cuts_at_blanks
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.good, self.uses = np.zeros(0, bool), np.zeros(0, np.int64)
        self.known = Aligned(np.zeros((0, 5), np.int64), [], np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64))

    def forget_rare(self) -> None:
        """Keep the units used more than once, if they are not too many."""
        keep = np.flatnonzero(self.uses > 1)
        if len(keep) > UNITS_HELD // 2:
            return self.forget()
        units, known = list(self.numbers), self.known
        where, many = _spans(known.bounds, keep)
        self.numbers = {units[i]: k for k, i in enumerate(keep.tolist())}
        self.good, self.uses = self.good[keep], np.ones(len(keep), np.int64)
        self.known = Aligned(known.counts[keep], [known.groups[i] for i in keep.tolist()], known.pairs[where], known.links[where],
                             np.r_[0, np.cumsum(many)])

    def align(self, texts: list[str]) -> Aligned:
        """Alignments of whole texts."""
        out: list[tuple | None] = [None] * len(texts)
        ordinary = [i for i, t in enumerate(texts) if t and _ORDINARY.fullmatch(t)] if self.cuts else []
        if ordinary:
            if len(self.numbers) > UNITS_HELD:
                self.forget_rare()
            units = [_UNIT.findall(" " + texts[i]) for i in ordinary]
            self._learn(units)
            for i, mine in zip(ordinary, units):
                at = np.fromiter(map(self.numbers.__getitem__, mine), np.int64, len(mine))
                if self.good[at].all():
                    out[i] = self._added_up(at)
        rest = [i for i, found in enumerate(out) if found is None]
        whole = self._whole([texts[i] for i in rest])
        for k, i in enumerate(rest):
            x, y = whole.bounds[k], whole.bounds[k + 1]
            out[i] = whole.counts[k], whole.groups[k], whole.pairs[x:y], whole.links[x:y]
        counts, groups, pairs, links = zip(*out)
        return Aligned(np.stack(counts), list(groups), np.concatenate(pairs), np.concatenate(links),
                       np.r_[0, np.cumsum([len(p) for p in pairs])])

    def _whole(self, texts: list[str]) -> Aligned:
        a, b = self.a.encode(texts), self.b.encode(texts)
        for i, t in enumerate(texts):
            if not t or not (self.a.returns(a[i], " " + t) and self.b.returns(b[i], " " + t)):
                a[i], b[i] = [], []
        return align_chunk(a, b, *self.sizes)

    def _learn(self, units: list[list[str]]) -> None:
        fresh = list(set().union(*units).difference(self.numbers))
        if not fresh:
            return
        made, good = _joined([self._units(fresh[low:low + UNITS_AT_ONCE]) for low in range(0, len(fresh), UNITS_AT_ONCE)])
        old = self.known
        self.numbers.update(zip(fresh, range(len(old.groups), len(old.groups) + len(fresh))))
        self.good, self.uses = np.r_[self.good, good], np.r_[self.uses, np.zeros(len(fresh), np.int64)]
        self.known = Aligned(np.concatenate([old.counts, made.counts]), old.groups + made.groups, np.r_[old.pairs, made.pairs],
                             np.r_[old.links, made.links], np.r_[old.bounds, old.bounds[-1] + made.bounds[1:]])

    def _units(self, units: list[str]) -> tuple[Aligned, np.ndarray]:
        """Alignments of units, and which of them both sides return byte by byte.

        Units begin with blanks and are tokenized as one text; a first one, left
        out again, stands where the tokenizers put their space.
        """
        text = "x" + "".join(units)
        ends = 2 + np.cumsum(np.fromiter((len(u.encode()) for u in units), np.int64, len(units)))
        sides = []
        for encoder, sizes in zip((self.a, self.b), self.sizes):
            ids = encoder.encode([text])[0]
            if not encoder.returns(ids, " " + text):
                break
            ids = np.array(ids, np.int64)
            end = np.cumsum(sizes[ids])
            place = np.searchsorted(end, np.r_[2, ends])
            if (end[place] != np.r_[2, ends]).any():
                break
            own = slice(int(place[0]) + 1, None)
            sides.append(Side(ids[own], np.searchsorted(ends, end[own]), end[own] - 2, len(sizes)))
        if len(sides) == 2:
            return align_tokens(len(units), *sides), np.ones(len(units), bool)
        if len(units) == 1:
            return align_chunk([[]], [[]], *self.sizes), np.zeros(1, bool)
        half = len(units) // 2  # some unit is at fault
        return _joined([self._units(units[:half]), self._units(units[half:])])

    def _added_up(self, at: np.ndarray) -> tuple[np.ndarray, str, np.ndarray, np.ndarray]:
        known = self.known
        unit, times = runs(np.sort(at))
        self.uses[unit] += times
        where, many = _spans(known.bounds, unit)
        pairs, links = add_equal(known.pairs[where], known.links[where] * np.repeat(times, many))
        return known.counts[at].sum(axis=0), ";".join(map(known.groups.__getitem__, at.tolist())), pairs, links


def _joined(parts: list[tuple[Aligned, np.ndarray]]) -> tuple[Aligned, np.ndarray]:
    made = [m for m, _ in parts]
    many = np.concatenate([np.diff(m.bounds) for m in made])
    return Aligned(np.concatenate([m.counts for m in made]), list(chain.from_iterable(m.groups for m in made)),
                   np.concatenate([m.pairs for m in made]), np.concatenate([m.links for m in made]),
                   np.r_[0, np.cumsum(many)]), np.concatenate([good for _, good in parts])


def _spans(bounds: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the entries of some rows, and how many each row has."""
    low, many = bounds[rows], bounds[rows + 1] - bounds[rows]
    return np.repeat(low - (np.cumsum(many) - many), many) + np.arange(int(many.sum())), many


def _align_rows(files):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _Aligner(*files.value.load())
        for batch in batches:
            low = 0
            for texts in _chunks(batch.column("text")):
                out = aligner.align(texts)
                packed = [pack_pairs(out.pairs[x:y], out.links[x:y]) for x, y in zip(out.bounds[:-1], out.bounds[1:])]
                digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in out.groups]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(low, len(texts)),
                     *[pa.array(np.ascontiguousarray(out.counts[:, k])) for k in range(len(_KEPT))],
                     pa.array(digests, pa.string()), pa.array(packed, pa.binary())],
                    ["id", *_KEPT, "groups_sha256", "pairs"])
                low += len(texts)
    return run


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def packed() -> pa.RecordBatch:
        keys, counts = runs(np.sort(np.concatenate(held)))
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["key", "n"])

    for batch in batches:
        for row in batch.column("pairs"):
            keys, _ = unpack_pairs(row.as_py())
            held.append(keys)
            size += len(keys)
            if size > COUNTED_AT_ONCE:
                yield packed()
                held, size = [], 0
    if size:
        yield packed()


def _settle(head):
    """(row, key, links, best, total): one row of what the head settles, with a
    key of its own, and one for each pair outside the head."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, best = head.value
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                found = [unpack_pairs(x.as_py()) for x in part.column("pairs")]
                rows = part.column("row").to_numpy()
                owner = np.repeat(np.arange(len(found)), [len(k) for k, _ in found])
                pair, links = (np.concatenate([x[i] for x in found]) for i in (0, 1))
                at = np.minimum(np.searchsorted(keys, pair), max(0, len(keys) - 1))
                known = keys[at] == pair if len(keys) else np.zeros(len(pair), bool)
                at, who = at[known], owner[known]
                total, top = np.zeros(len(found), np.int64), np.zeros(len(found), np.int64)
                np.add.at(total, who, links[known] * counts[at])
                np.add.at(top, who, links[known] * best[at])
                rest = ~known
                none = np.zeros(int(rest.sum()), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (np.r_[rows, rows[owner[rest]]], np.r_[-1 - rows, pair[rest]],
                                           np.r_[np.zeros(len(found), np.int64), links[rest]],
                                           np.r_[top, none], np.r_[total, none])],
                    ["row", "key", "links", "best", "total"])
    return run


def head_threshold(counts: DataFrame, most: int) -> int:
    """The least count so that at most ``most`` pairs have it; a histogram of
    at most 1,000 cells tells, so nothing else reaches the driver."""
    cell = F.floor(F.log2(F.col("n").cast("double")) * 16)
    seen, least = 0, None
    for r in sorted(counts.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("n")).collect(),
                    key=lambda r: -r["cell"]):
        seen += r["k"]
        if seen > most:
            break
        least = r["n"]
    return least if least is not None else (1 << 62)


def align(docs: DataFrame, tokenizers: Tokenizers, id_col: str = "doc_id", text_col: str = "text",
          head: int = HEAD) -> DataFrame:
    """(``id_col``, n_a, n_b, n_groups, n_links, n_overlaps, n_best, count_sum,
    groups_sha256), one row per row of ``docs``; its other columns are not read.

    Null and empty texts, and texts that a tokenizer does not return byte by
    byte, have zeros and an empty digest.  Repeated rows are documents of their
    own, a null id is kept.  An empty table gives an empty result.
    """
    spark: SparkSession = docs.sparkSession
    files = spark.sparkContext.broadcast(tokenizers)
    rows = docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    counts = ", ".join(f"{c} long" for c in _KEPT)
    made = rows.mapInArrow(_align_rows(files), f"id {rows.schema['id'].dataType.simpleString()}, {counts}, "
                                               "groups_sha256 string, pairs binary")
    # the number is written with its row, so it stays whatever is computed again
    made = staged(made.withColumn("row", F.monotonically_increasing_id()), "alignment")
    partial = made.select("pairs").mapInArrow(_count_pairs, "key long, n long")
    counted = staged(partial.groupBy("key").agg(F.sum("n").alias("n")), "alignment-counts")
    highest = counted.groupBy(F.shiftright("key", 32).alias("a")).agg(F.max("n").alias("most"))
    judged = counted.withColumn("a", F.shiftright("key", 32)).join(highest, "a").select(
        "key", "n", (F.col("n") == F.col("most")).cast("long").alias("b"))
    known = judged.where(F.col("n") >= head_threshold(counted, head)).toArrow().sort_by("key")
    table = spark.sparkContext.broadcast(tuple(known.column(c).to_numpy() for c in ("key", "n", "b")))
    settled = made.select("row", "pairs").mapInArrow(_settle(table), "row long, key long, links long, best long, total long")
    sums = settled.join(judged, "key", "left").groupBy("row").agg(
        F.sum(F.col("best") + F.coalesce(F.col("links") * F.col("b"), F.lit(0))).alias("n_best"),
        F.sum(F.col("total") + F.coalesce(F.col("links") * F.col("n"), F.lit(0))).alias("count_sum"))
    return made.drop("pairs").join(sums, "row").select(F.col("id").alias(id_col), *ADDED)
