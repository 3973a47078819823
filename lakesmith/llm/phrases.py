"""Phrase mining with stripes (operator 11).

A stripe belongs to a prefix of words: a counter of the words that follow it,
and of its ends (no word follows).  Stripes of one prefix merge element by
element, and one merged stripe tells all that the method needs: its entries are
the counts of the prefix's extensions, its sum is the count of the prefix, and
its largest entry is the strongest extension.

Level by level (prefixes of one word, then two, ...):

* tasks build stripes of their texts in bounded chunks and pass them on, each
  stripe cut by a hash of the next word into ``PIECES``, so that the stripe of a
  word in a third of all places is merged by many tasks;
* merged entries below ``min_count`` become part of the stripe's remainder, so
  what is kept is one row a stripe piece and one a frequent extension;
* a phrase is no more frequent than its parts.  Frequent phrases of a level mark
  a bitmap of fixed size; the next level builds stripes only where prefix and
  following phrase are marked.  A false mark costs a row, never a result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakesmith.llm.common import UPPER, col, staged

#: Parts of a stripe that are merged apart.
PIECES = 16
#: Words that a task counts before it passes its stripes on.
WORDS_AT_ONCE = 1 << 21
#: Bits of the marks of frequent phrases, and bits of one part of them (fixed by Spark's bitmap functions).
MARK_BITS, BITMAP_BITS = 24, 1 << 15
#: Language of a null language.
UNKNOWN = "und"

# Characters that end a piece; blanks between words.
ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
#: One byte table does the lower case, the ends and the blanks (all are ASCII, so UTF-8 stays whole).
_PLAIN = bytes.maketrans(UPPER.encode() + ENDS + BLANKS, UPPER.lower().encode() + b"\n" * len(ENDS) + b" " * len(BLANKS))
_END = -1


class _Numbers(dict):
    """Words numbered as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def word_numbers(text: str, known: _Numbers) -> list[int]:
    """A text as word numbers, ``_END`` after each piece; empty words are left out."""
    out: list[int] = []
    for piece in text.encode("utf-8", "replace").translate(_PLAIN).split(b"\n"):
        words = piece.split(b" ")
        if words != [b""]:
            out += [known[w] for w in words if w]
            out.append(_END)
    return out


def phrase_hash(lang: Column, *words: Column) -> Column:
    """The mark of a phrase; ``_marks`` computes the same."""
    hashes = [F.xxhash64(F.concat(lang, F.lit("\0"), w)) for w in words]
    return reduce(lambda a, b: a.bitwiseXOR(b), [F.shiftrightunsigned(h, 5 * i) for i, h in enumerate(hashes)]).bitwiseAND(
        (1 << MARK_BITS) - 1)


def _marks(hashes: np.ndarray, phrase: list[np.ndarray]) -> np.ndarray:
    return reduce(np.bitwise_xor, [hashes[w] >> np.uint64(5 * i) for i, w in enumerate(phrase)]) & np.uint64((1 << MARK_BITS) - 1)


def marked(frequent: DataFrame, words: list[Column]) -> np.ndarray:
    """Bits of all phrases of ``frequent``: 2^MARK_BITS whatever their number."""
    at = frequent.select(phrase_hash(F.col("lang"), *words).alias("at"))
    parts = at.groupBy(F.shiftright("at", 15).cast("int").alias("part")).agg(
        F.bitmap_construct_agg(F.col("at") % BITMAP_BITS).alias("bits")).collect()
    out = np.zeros(1 << MARK_BITS >> 3, np.uint8)
    for r in parts:
        low = r["part"] * (BITMAP_BITS >> 3)
        out[low:low + (BITMAP_BITS >> 3)] = np.frombuffer(r["bits"], np.uint8)
    return np.unpackbits(out, bitorder="little").astype(bool)


def _stripe_rows(size: int, marks):
    """Stripes of prefixes of ``size`` words; with ``marks``, of marked ones only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[_Numbers, list[np.ndarray]]] = {}
        total = 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                known, parts = held.setdefault(lang, (_Numbers(), []))
                parts.append(np.array(word_numbers(text.as_py(), known), np.int64))
                total += len(parts[-1])
                if total >= WORDS_AT_ONCE:
                    yield from passed_on(held)
                    held, total = {}, 0
        yield from passed_on(held)

    def passed_on(held) -> Iterator[pa.RecordBatch]:
        for lang, (known, parts) in held.items():
            seq = np.r_[np.concatenate(parts), np.full(size, _END)]
            # word k of the prefix that starts at each place, and the word that follows it
            at = [seq[k:len(seq) - size + k] for k in range(size + 1)]
            ok = reduce(np.logical_and, [a >= 0 for a in at[:-1]])
            words = [a[ok] for a in at]
            if len(words[0]):
                yield from stripes(lang, list(known), words)

    def stripes(lang: str, known: list[bytes], words: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        hashes = np.array([xxhash.xxh64_intdigest(lang.encode() + b"\0" + w, 42) for w in known], np.uint64)
        if marks is not None:
            bits = marks.value
            keep = bits[_marks(hashes, words[:-1])]
            words = [w[keep] for w in words]
            if not len(words[0]):
                return
            follows = words[-1] >= 0
            phrase = [w[follows] for w in words[1:]]
            words[-1] = words[-1].copy()
            words[-1][np.flatnonzero(follows)[~bits[_marks(hashes, phrase)]]] = _END
        prefix, first = words[0], [np.arange(len(known))]
        for w in words[1:-1]:  # longer prefixes: numbered, with a place where each occurs
            _, where, prefix = np.unique(prefix * len(known) + w, return_index=True, return_inverse=True)
            first = [x[where] for x in words[:-1]]
        piece = np.r_[(hashes % np.uint64(PIECES)).astype(np.int64), 0]  # the last one is the end's
        cell = (prefix * PIECES + piece[words[-1]]) * (len(known) + 1) + words[-1] + 1
        cells, counts = np.unique(cell, return_counts=True)
        follow, stripe = cells % (len(known) + 1) - 1, cells // (len(known) + 1)
        starts = np.flatnonzero(np.r_[True, stripe[1:] != stripe[:-1]])
        bounds = pa.array(np.r_[starts, len(cells)].astype(np.int32))
        texts = pa.array([w.decode("utf-8", "replace") for w in known] + [None], pa.string())
        who = stripe[starts] // PIECES
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(starts)), pa.array((stripe[starts] % PIECES).astype(np.int32)),
             *[texts.take(pa.array(f[who])) for f in first],
             pa.ListArray.from_arrays(bounds, texts.take(pa.array(np.where(follow < 0, len(known), follow)))),
             pa.ListArray.from_arrays(bounds, pa.array(counts))],
            ["lang", "piece", *[f"w{k}" for k in range(size)], "follow", "n"])
    return run


def merged_stripes(texts: DataFrame, size: int, min_count: int, marks=None) -> DataFrame:
    """(lang, w0.., follow, n): merged stripes of prefixes of ``size`` words.
    ``follow`` is an extension of ``min_count`` or more, or null for the
    remainder of a stripe piece: its ends and rarer extensions."""
    prefix = [f"w{k}" for k in range(size)]
    partial = texts.mapInArrow(_stripe_rows(size, marks), "lang string, piece int, " + ", ".join(f"{w} string" for w in prefix)
                               + ", follow array<string>, n array<long>")
    key = ["lang", *prefix, "piece"]
    # all groupings below are finer than this one exchange and add none
    entries = partial.repartition(*key).select(*key, F.explode(F.arrays_zip("follow", "n")).alias("e")).select(
        *key, "e.follow", "e.n").groupBy(*key, "follow").agg(F.sum("n").alias("n"))
    kept = F.when(F.col("n") >= min_count, F.col("follow"))
    return entries.groupBy(*key, kept.alias("follow")).agg(F.sum("n").alias("n")).drop("piece")


def _phrase(words: list[str]) -> Column:
    return F.concat_ws(" ", *words)


def mine_phrases(docs: DataFrame, max_words: int = 3, min_count: int = 10, top: int | None = 2000,
                 subsumed_percent: int = 50, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of phrases of 2 to ``max_words``
    words, the first ``top`` (all for None) of every language by score, count, phrase.

    A phrase lies inside a piece of text; ``a`` is its count, at least
    ``min_count``; ``l`` and ``r`` are the counts of both sides of the cut with
    the lowest score floor(10^6 a a / (l r)), the first of equal ones; ``n``
    counts the language's words.  A phrase inside a longer one that has
    ``subsumed_percent`` of its count or more is left out.  Null texts are
    empty, a null language is ``und``; no phrases give an empty result.
    """
    spark = docs.sparkSession
    lang = F.coalesce(col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang")
    texts = docs.select(lang, col(text_col).cast("string").alias("text")).where("text <> ''")
    marks, levels, totals = None, {}, None
    for size in range(1, max_words):
        merged = staged(merged_stripes(texts, size, min_count, marks), f"stripes-{size}")
        if size == 1:
            totals = merged.groupBy("lang", F.col("w0").alias("phrase")).agg(F.sum("n").alias("f"))
        words = [*[f"w{k}" for k in range(size)], "follow"]
        levels[size + 1] = merged.where("follow is not null").select(
            "lang", *[F.col(w).alias(f"w{k}") for k, w in enumerate(words)], F.col("n").alias("a"))
        if size + 1 < max_words:
            marks = spark.sparkContext.broadcast(marked(levels[size + 1], [F.col(f"w{k}") for k in range(size + 1)]))

    # parts of phrases: frequent words and the shorter phrases
    parts = reduce(DataFrame.unionByName, [totals.where(F.col("f") >= min_count)] + [
        levels[m].select("lang", _phrase([f"w{k}" for k in range(m)]).alias("phrase"), F.col("a").alias("f"))
        for m in range(2, max_words)])
    scored = reduce(DataFrame.unionByName, [
        _scored(levels[m], m, parts, _strongest(levels.get(m + 1), m), subsumed_percent) for m in levels])
    n = totals.groupBy("lang").agg(F.sum("f").alias("n"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    if top is not None:  # a frequent language is limited in parts first, so at most PIECES * top of its phrases meet
        part = F.pmod(F.xxhash64("phrase"), F.lit(PIECES))
        place = F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))
        scored = scored.withColumn("place", place).where(F.col("place") <= top).drop("place")
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(n, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _strongest(longer: DataFrame | None, size: int) -> DataFrame | None:
    """(lang, phrase, most): the largest count of a longer phrase around a phrase.
    Longer ones by two or more words are no stronger than those between."""
    if longer is None:
        return None
    inner = [_phrase([f"w{k}" for k in range(low, low + size)]) for low in (0, 1)]
    return (longer.select("lang", F.explode(F.array(*inner)).alias("phrase"), "a")
            .groupBy("lang", "phrase").agg(F.max("a").alias("most")))


def _scored(phrases: DataFrame, size: int, parts: DataFrame, strongest: DataFrame | None, percent: int) -> DataFrame:
    words = [f"w{k}" for k in range(size)]
    rows = phrases.select("lang", _phrase(words).alias("phrase"), "a", *words)
    if strongest is not None:
        rows = rows.join(strongest, ["lang", "phrase"], "left").where(
            F.coalesce(100 * F.col("most") < percent * F.col("a"), F.lit(True))).drop("most")
    cuts = []
    for k in range(1, size):
        for side, cut in (("l", words[:k]), ("r", words[k:])):
            known = parts.select("lang", F.col("phrase").alias("__part"), F.col("f").alias(f"{side}{k}"))
            # inner join: parts of a frequent phrase are frequent; adaptive execution splits hot words
            rows = rows.withColumn("__part", _phrase(cut)).join(known, ["lang", "__part"]).drop("__part")
        cuts.append(F.struct(_score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"),
                             F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
    lowest = F.least(*cuts) if len(cuts) > 1 else cuts[0]
    return rows.withColumn("c", lowest).select("lang", "phrase", "a", "c.l", "c.r", "c.score")


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(10^6 a a / (l r)), exact: products have up to 38 digits."""
    a, left, right = (x.cast("decimal(15,0)") for x in (a, left, right))
    return F.call_function("div", a * a * F.lit(1_000_000).cast("decimal(7,0)"), left * right)
