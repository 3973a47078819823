"""Benchmark decontamination by spaced seeds (operator 3).

A seed is a fixed mask over consecutive tokens: ``##-#`` looks at three of four
tokens and ignores one, so a substituted token there does no harm.  Each length
of benchmark item has a family of masks (``SPACED_SEEDS``) of which at least
one fits somewhere in every stretch that the rule accepts; tests prove that by
exhaustion over all patterns of substitutions.

1. Every window of every item is hashed under the masks of its length; the
   hashes are a DataFrame, and a filter of bounded size (``FILTER_BITS``) is
   made from them on Spark.  Nothing else of the benchmark reaches the driver.
2. Training windows are hashed the same way.  Texts in which a hash passes the
   filter are written with their token numbers and those hashes, equal texts once.
3. Both sides' hashes are joined.  A common hash places an item beside a text;
   each such alignment is cut out of the text and compared token by token, and
   every maximal stretch that is long and similar enough is an overlap.
4. Overlaps return to the documents by text digest, so copies of a text need no
   work of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesmith.llm.common import col, kept_columns, staged, text_of

#: Matched tokens that make an overlap, and the least share of its stretch.
MIN_OVERLAP, MIN_SHARE = 13, 0.8
#: Items under this many tokens match as a whole and exactly; a single token is no sequence and never matches.
MIN_TOKENS, LEAST_TOKENS = 6, 2
#: Document bytes tokenised at a time inside a task.
SLICE_BYTES = 2 << 20
#: Bits of the filter a seed, and the least and most bits of the whole (128 MB).
FILTER_BITS, FILTER_LEAST, FILTER_MOST = 64, 1 << 20, 1 << 30
CELLS, BITMAP_BITS = 4, 1 << 15

# Masks by item length, the last ones for all longer items.  Every stretch accepted under
# MIN_OVERLAP and MIN_SHARE holds one of them.
SPACED_SEEDS = {
    6: ("#####", "####-#", "###-##", "##-###", "#-####"),
    7: ("######", "#####-#", "####-##", "###-###", "##-####", "#-#####"),
    8: ("#######", "######-#", "#####-##", "####-###", "###-####", "##-#####", "#-######"),
    9: ("########", "#######-#", "######-##", "#####-###", "####-####", "###-#####", "##-######", "#-#######"),
    10: ("####-##", "##--####", "##-##--##", "####-#-#", "#-#-####"),
    11: ("#####-##", "##-#-####", "###-###-#", "##-##-#-##", "##--##-###", "#####--##", "#-#--#####"),
    12: ("######-##", "##-#-#####", "###-####-#", "####-##--##", "##-###-#-##", "##-##---####", "##--######", "#-#-##--####"),
    13: ("#####-###", "##-#-#####", "#####--#-##", "###--##--###", "##-######"),
    14: ("######-###", "##-#-######", "####-##--#-##", "##-##--#-####", "###-####-##", "###--####--##"),
    15: ("####-#-##", "##--#--####", "##-#-#---#--##", "##---###--##", "###-##-#----#"),
    16: ("###-#--###", "####-###", "##-#-----#-###", "#-#####-#", "#####---#-----#"),
}

OVERLAP = "struct<item_id:bigint,start:int,end:int,matched:int,item_tokens:int>"
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def tokenize(texts: pa.Array) -> pa.ListArray:
    """Lower-cased runs of letters and digits; null texts have none."""
    lowered = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    return pc.split_pattern_regex(lowered, r"[^\p{L}\p{N}]+")


def _flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens and the first token of each text (and the end)."""
    lists = tokenize(texts)
    tokens, owner = lists.flatten(), pc.list_parent_indices(lists)
    real = pc.not_equal(tokens, "")  # empty tokens at the edges go
    tokens, owner = tokens.filter(real).dictionary_encode(), owner.filter(real).to_numpy(zero_copy_only=False)
    known = np.array([xxhash.xxh64_intdigest(t) for t in tokens.dictionary.to_pylist()], np.uint64)
    ids = known[tokens.indices.to_numpy(zero_copy_only=False)] if len(known) else known
    return ids, np.searchsorted(owner, np.arange(len(texts) + 1))


def _needed(n_tokens: int, min_overlap: int, share: Fraction) -> int:
    """Equal tokens that an overlap with an item of ``n_tokens`` tokens must have."""
    return n_tokens if n_tokens < MIN_TOKENS else max(1, min(min_overlap, math.ceil(share * n_tokens)))


def seed_length(n_tokens: int, min_overlap: int, min_share: float) -> int:
    """Length of the exact run that every accepted stretch of such an item
    holds: m substitutions leave m + 1 runs at most."""
    share = Fraction(str(min_share))
    least = n_tokens
    for equal in range(_needed(n_tokens, min_overlap, share), n_tokens + 1):
        replaced = min(n_tokens - equal, math.floor(equal * (1 - share) / share)) if share else n_tokens - equal
        least = min(least, -(-equal // (replaced + 1)))
    return least


def seed_masks(n_tokens: int, min_overlap: int = MIN_OVERLAP, min_share: float = MIN_SHARE) -> tuple[str, ...]:
    """The masks for items of ``n_tokens`` tokens.  Rules other than the default
    one use the exact run that their stretches hold."""
    if n_tokens < LEAST_TOKENS:
        return ()
    if n_tokens < MIN_TOKENS:
        return ("#" * n_tokens,)
    if (min_overlap, min_share) == (MIN_OVERLAP, MIN_SHARE):
        return SPACED_SEEDS[min(n_tokens, max(SPACED_SEEDS))]
    return ("#" * seed_length(n_tokens, min_overlap, min_share),)


def mask_codes(ids: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the tokens that ``mask`` looks at, for every window of ``ids``."""
    n = len(ids) - len(mask) + 1
    code = np.full(max(n, 0), xxhash.xxh64_intdigest(mask), np.uint64)
    if n > 0:
        for i, mark in enumerate(mask):
            if mark == "#":
                code = (code ^ ids[i:i + n]) * _MULTIPLY
                code ^= code >> np.uint64(29)
    return code


def accepted_stretches(same: np.ndarray, n_tokens: int, min_overlap: int, share: Fraction) -> list[tuple[int, int, int]]:
    """(begin, end, equal tokens) of every maximal stretch of an alignment with
    enough equal tokens and a large enough share of them."""
    needed = _needed(n_tokens, min_overlap, share)
    if int(same.sum()) < needed:
        return []
    # a stretch [i, j) is similar enough if above[j] >= above[i]; whole numbers, so ties are exact
    equal = np.r_[0, np.cumsum(same)]
    above = share.denominator * equal - share.numerator * np.arange(len(same) + 1)
    ends = np.flatnonzero(same) + 1
    floor = np.minimum.accumulate(above)
    begins = np.searchsorted(-floor, -above[ends])  # earliest begin of each end
    begins = (ends - 1)[np.searchsorted(ends - 1, begins)]  # moved on to its first match
    matched = equal[ends] - equal[begins]
    long = matched >= needed
    ends, begins, matched = ends[long], begins[long], matched[long]
    # a stretch within another one has a later end's begin at or before its own
    later = np.r_[np.minimum.accumulate(begins[::-1])[::-1][1:], len(same)]
    return [(i, j, m) for i, j, m, outer in zip(begins.tolist(), ends.tolist(), matched.tolist(), later.tolist()) if i < outer]


# -- benchmark side --------------------------------------------------------------

def _item_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, first = _flat(batch.column("text"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("item_id"), pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids.view(np.int64)))],
            ["item_id", "tokens"])


def _item_seeds(min_overlap: int, min_share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, items, places = [np.zeros(0, np.uint64)], [], []
            for item, tokens in zip(batch.column("item").to_pylist(), batch.column("tokens")):
                ids = np.array(tokens.as_py(), np.int64).view(np.uint64)
                for mask in seed_masks(len(ids), min_overlap, min_share):
                    found = mask_codes(ids, mask)
                    codes.append(found)
                    items += [item] * len(found)
                    places += range(len(found))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(codes).view(np.int64)), pa.array(items, pa.int64()),
                                              pa.array(places, pa.int32())], ["code", "item", "place"])
    return run



def seed_filter(seeds: DataFrame) -> np.ndarray:
    """A bit for each of the cells of every seed; ``FILTER_MOST`` bits at most."""
    bits = FILTER_LEAST
    while bits < FILTER_MOST and bits < FILTER_BITS * seeds.count():
        bits *= 2
    cells = F.array(*[F.col("code").bitwiseXOR(F.shiftrightunsigned("code", 7 * i + 13)).bitwiseAND(bits - 1) for i in range(CELLS)])
    parts = seeds.select(F.explode(cells).alias("at")).groupBy(F.shiftright("at", 15).cast("int").alias("part")).agg(
        F.bitmap_construct_agg(F.col("at") % BITMAP_BITS).alias("bits"))
    out = np.zeros(bits >> 3, np.uint8)
    for r in parts.toLocalIterator():
        low = r["part"] * (BITMAP_BITS >> 3)
        out[low:low + (BITMAP_BITS >> 3)] = np.frombuffer(r["bits"], np.uint8)
    return out


# -- document side ----------------------------------------------------------------

def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of about ``SLICE_BYTES``; one longer text is a range of its own."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes) // SLICE_BYTES
    edges = np.flatnonzero(np.diff(part)) + 1
    yield from zip(np.r_[0, edges].tolist(), np.r_[edges, len(texts)].tolist())


def _text_seeds(masks: list[str], known):
    """Texts with a seed that passes the filter: digests, token hashes, seeds."""
    names = ["x", "y", "tokens", "seeds"]
    kind = pa.list_(pa.struct([("code", pa.int64()), ("at", pa.int32())]))

    def passed(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        bitmap = known.value
        owners, codes, places = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
        for mask in masks:
            code = mask_codes(ids, mask)
            spots = np.flatnonzero(owner[:len(code)] == owner[len(mask) - 1:])
            code = code[spots]
            for i in range(CELLS):
                cell = (code ^ (code >> np.uint64(7 * i + 13))) & np.uint64(len(bitmap) * 8 - 1)
                hit = (bitmap[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 > 0
                code, spots = code[hit], spots[hit]
            owners.append(owner[spots])
            codes.append(code)
            places.append(spots - first[owner[spots]])
        return tuple(np.concatenate(x) for x in (owners, codes, places))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            for a, b in _slices(batch.column("text")):
                part = batch.slice(a, b - a)
                ids, first = _flat(part.column("text"))
                owner, code, at = passed(ids, first)
                order = np.argsort(owner, kind="stable")
                texts, sizes = np.unique(owner, return_counts=True)
                hits = pa.StructArray.from_arrays([pa.array(code[order].view(np.int64)), pa.array(at[order].astype(np.int32))], ["code", "at"])
                rows = pa.array(texts)
                tokens = pa.array([ids[first[t]:first[t + 1]].view(np.int64) for t in texts], pa.list_(pa.int64()))
                bounds = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
                yield pa.RecordBatch.from_arrays([part.column("x").take(rows), part.column("y").take(rows), tokens,
                                                  pa.ListArray.from_arrays(bounds, hits).cast(kind)], names)
    return run


def _verified(min_overlap: int, min_share: float):
    share = Fraction(str(min_share))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = [], []
            columns = [batch.column(c) for c in ("mine", "theirs", "n_tokens", "begin")]
            for i in range(batch.num_rows):
                mine, theirs, n, begin = (c[i].as_py() for c in columns)
                for a, b, m in accepted_stretches(np.array(mine, np.int64) == np.array(theirs, np.int64), n, min_overlap, share):
                    rows.append(i)
                    found.append((begin + a, begin + b, m))
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).take(at) for c in ("x", "y", "item_id")], *[pa.array([f[k] for f in found], pa.int32()) for k in range(3)],
                 batch.column("n_tokens").take(at)], ["x", "y", "item_id", "start", "end", "matched", "item_tokens"])
    return run


def _digests(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("x"), F.xxhash64(F.lit(1), text).alias("y")]


def text_overlaps(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", min_overlap: int = MIN_OVERLAP, min_share: float = MIN_SHARE) -> DataFrame:
    """(x, y, overlaps): the overlaps of every different text that has any, by its two digests."""
    spark = docs.sparkSession
    unique = (benchmark.groupBy(col(item_text_col).cast("string").alias("text")).agg(F.min(col(item_col).cast("long")).alias("item_id"))
              .where("text is not null").select("item_id", "text"))
    # the number is written with its item, so it stays whatever is computed again
    items = staged(unique.mapInArrow(_item_tokens, "item_id long, tokens array<long>")
                   .withColumn("item", F.monotonically_increasing_id()), "benchmark-items")
    seeds = staged(items.select("item", "tokens").mapInArrow(
        _item_seeds(min_overlap, min_share), "code long, item long, place int"), "benchmark-seeds")
    sizes = [r[0] for r in items.select(F.least(F.size("tokens"), F.lit(max(min_overlap, *SPACED_SEEDS) * 2))).distinct().collect()]
    masks = sorted({m for n in sizes for m in seed_masks(n, min_overlap, min_share)})
    known = spark.sparkContext.broadcast(seed_filter(seeds))
    text = text_of(text_col)
    candidates = docs.select(*_digests(text), text.alias("text")).mapInArrow(
        _text_seeds(masks, known), "x long, y long, tokens array<long>, seeds array<struct<code:long,at:int>>")
    candidates = staged(candidates.groupBy("x", "y").agg(F.first("tokens").alias("tokens"), F.first("seeds").alias("seeds")),
                        "benchmark-candidates")
    places = (candidates.select("x", "y", F.inline("seeds")).join(seeds, "code")
              .select("x", "y", "item", (F.col("at") - F.col("place")).alias("shift")).distinct())
    begin, skipped = F.greatest(F.col("shift"), F.lit(0)), F.greatest(-F.col("shift"), F.lit(0))
    size = F.least(F.size("theirs") - skipped, F.size("mine") - begin)
    aligned = (places.join(items.select("item", "item_id", F.col("tokens").alias("theirs")), "item")
               .join(candidates.select("x", "y", F.col("tokens").alias("mine")), ["x", "y"])
               .select("x", "y", "item_id", F.size("theirs").alias("n_tokens"), begin.alias("begin"),
                       F.slice("mine", begin + 1, size).alias("mine"), F.slice("theirs", skipped + 1, size).alias("theirs")))
    rows = aligned.mapInArrow(_verified(min_overlap, min_share),
                              "x long, y long, item_id long, start int, end int, matched int, item_tokens int")
    found = rows.groupBy("x", "y").agg(F.array_sort(F.collect_set(
        F.struct("item_id", "start", "end", "matched", "item_tokens"))).alias("overlaps"))
    return staged(found, "benchmark-overlaps")  # its written size decides whether it is sent to all tasks or shuffled


def contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", min_overlap: int = MIN_OVERLAP,
                  min_share: float = MIN_SHARE) -> DataFrame:
    """``docs`` plus ``overlaps``: an array of (item_id, start, end, matched,
    item_tokens), token offsets in the document, empty where clean.

    An overlap is an aligned stretch of at least ``min_overlap`` equal tokens
    (or ``min_share`` of the item, if that is less) with at most 1 -
    ``min_share`` substitutions.  It begins and ends with equal tokens and lies
    in no longer one of the same alignment; two overlaps of an alignment may
    share tokens.  Items of 2 to 5 tokens overlap where they stand whole and
    exact.  Null and empty texts are clean; items of one token, null or empty
    ones never match; a repeated item text counts once, under its smallest id.
    Repeated rows each get their result; an empty benchmark leaves all documents
    clean.  An input column named overlaps is replaced.
    """
    found = text_overlaps(docs, benchmark, text_col, item_col, item_text_col, min_overlap, min_share)
    keep = kept_columns(docs, ["overlaps"])
    rows = docs.select(*[col(c).alias(f"c{i}") for i, c in enumerate(keep)], *_digests(text_of(text_col)))
    return rows.join(found, ["x", "y"], "left").select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)],
        F.coalesce("overlaps", F.array().cast(f"array<{OVERLAP}>")).alias("overlaps"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without a verified benchmark overlap; same columns as ``docs``."""
    found = text_overlaps(docs, benchmark, **options).select("x", "y")
    rows = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("__row"), *_digests(text_of(options.get("text_col", "text"))))
    return rows.join(found, ["x", "y"], "left_anti").select("__row.*")
