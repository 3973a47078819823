"""SimHash near-duplicates (operator 1).

1. Each text gives a 64-bit fingerprint: word shingles are hashed and every
   bit takes the majority (one Arrow pass, no shuffle).
2. Equal fingerprints collapse to one node before anything is compared, so
   groups of copies of any size cost one row.
3. Pigeonhole blocks: fingerprints are split into ``distance + agree`` blocks.
   Two that differ in at most ``distance`` bits agree on at least ``agree`` of
   them, so they share a key for some choice of ``agree`` blocks.  Keys of
   several blocks together stay selective as the corpus grows.
4. Fingerprints that share a key are compared (Hamming distance), inside
   sorted runs of one partition.  A run reports the links that connect it, not
   all its pairs.  A key with more than ``RUN`` fingerprints is split into
   chunks and each pair of chunks is a run of its own.
5. Links become classes by alternating stars.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesmith.llm.common import checkpointed, col, document_key, kept_columns
from lakesmith.llm.components import connected_components

SEED = 42
#: Most fingerprints of one key compared in one run; longer ones are split.
RUN = 4096
ADDED = ["fingerprint", "component_id"]


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """64-bit SimHash of one text (signed), see ``fingerprints``."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, ASCII blanks only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    last = ends[min(shingle, len(words)) - 1:].tolist()
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, last)], dtype=np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65_536):  # bounded memory for very long texts
        part = hashes[i:i + 65_536]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    value = np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0]
    return int(value.astype(np.int64))


def fingerprints(docs: DataFrame, shingle: int = 4, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``__fp``: lower-cased A-Z, words between ASCII blanks,
    ``shingle``-word shingles with repeats (fewer words: all of them; none: 0),
    XXH64 with seed 42, a bit set where over half the hashes have it."""
    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t.as_py(), shingle) for t in texts], pa.int64())
    return docs.withColumn("__fp", of(col(text_col)))


def block_masks(distance: int, agree: int) -> list[int]:
    """Bit masks, one for each choice of ``agree`` of ``distance + agree`` blocks."""
    n = distance + agree
    edges = [64 * i // n for i in range(n + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    masks = [sum(c) for c in combinations(blocks, agree)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def _link_runs(distance: int):
    """Batches sorted by (run, fp) -> links (a, b) that connect each run's
    fingerprints at ``distance`` or fewer bits."""
    def pairs(run: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
        sizes = np.diff(np.r_[starts, len(run)])
        left, right = [], []
        # short runs: compare neighbours at each offset, for all runs at once
        short = np.repeat(sizes <= 16, sizes)
        for d in range(1, 16):
            if not (sizes > d).any():
                break
            i = np.flatnonzero((run[d:] == run[:-d]) & short[:-d])
            i = i[np.bitwise_count((fp[i] ^ fp[i + d]).view(np.uint64)) <= distance]
            left.append(fp[i])
            right.append(fp[i + d])
        # long runs: grow each class from a member; every fingerprint is linked once
        for s in np.flatnonzero(sizes > 16):
            rest = np.unique(fp[starts[s]:starts[s] + sizes[s]])
            front: list[int] = []
            while len(rest):
                if not front:
                    front, rest = [rest[0]], rest[1:]
                    continue
                x = front.pop()
                near = np.bitwise_count((rest ^ x).view(np.uint64)) <= distance
                if near.any():
                    hit, rest = rest[near], rest[~near]
                    left.append(np.full(len(hit), x, np.int64))
                    right.append(hit)
                    front.extend(hit)
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *left]), np.concatenate([none, *right])

    def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, fp = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            run = np.r_[run, batch.column("run").to_numpy(zero_copy_only=False)]
            fp = np.r_[fp, batch.column("fp").to_numpy(zero_copy_only=False)]
            cut = int(np.searchsorted(run, run[-1])) if len(run) else 0  # the last run may go on
            if cut > 65_536 or len(run) > 4 * 65_536:
                yield _edges(*pairs(run[:cut], fp[:cut]))
                run, fp = run[cut:], fp[cut:]
        if len(run):
            yield _edges(*pairs(run, fp))
    return run_batches


def _edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def near_links(fps: DataFrame, distance: int = 4, agree: int = 3) -> DataFrame:
    """Links (a, b), a < b, between the distinct fingerprints of ``fps.fp``
    that connect exactly those classes that all pairs at ``distance`` or fewer
    differing bits connect."""
    keys = F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m)))
                     for i, m in enumerate(block_masks(distance, agree))])
    keyed = fps.select(F.explode(keys).alias("run"), "fp").repartition("run")
    hot = (keyed.groupBy("run").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > RUN)
           .select("run", F.ceil(F.col("n") / RUN).cast("int").alias("chunks")))
    linked = keyed.join(hot, "run", "left")  # same partitioning: no further exchange
    one = linked.where("chunks is null").select("run", "fp")
    own = F.pmod(F.xxhash64(F.lit(7), "fp"), F.col("chunks")).cast("int")
    split = (linked.where("chunks is not null").withColumn("own", own)
             .select("run", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
             .select(F.xxhash64("run", F.least("own", "other"), F.greatest("own", "other")).alias("run"), "fp")
             .repartition("run"))
    schema = "a long, b long"
    found = [x.sortWithinPartitions("run", "fp").mapInArrow(_link_runs(distance), schema) for x in (one, split)]
    return found[0].unionByName(found[1]).distinct()


def near_duplicate_classes(docs: DataFrame, shingle: int = 4, distance: int = 4, agree: int = 3,
                           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One narrow row per input row: ``__id``, ``__th`` (text digest), ``__fp``,
    ``__root`` (smallest fingerprint of the class) and ``component_id``, the
    smallest id reachable over links of ``distance`` or fewer differing bits,
    itself included.

    Null texts count as empty; empty texts have fingerprint zero and are linked
    like any other.  A null id names a class only if all its ids are null.
    Repeated rows each get their result; an empty table gives an empty result.
    """
    texts = docs.select(*document_key(id_col, text_col), col(text_col).alias("text"))
    marked = checkpointed(fingerprints(texts, shingle).drop("text"))
    nodes = checkpointed(marked.groupBy(F.col("__fp").alias("fp")).agg(F.min("__id").alias("least")))
    roots = connected_components(near_links(nodes.select("fp"), distance, agree))
    member = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("__root"))
    first = member.groupBy("__root").agg(F.min("least").alias("component_id"))
    named = member.join(first, "__root").select("fp", "__root", "component_id")
    return marked.join(named, marked["__fp"] == named["fp"]).drop("fp")


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4, agree: int = 3) -> DataFrame:
    """``docs`` plus ``fingerprint`` (16 hex digits) and ``component_id``, see
    ``near_duplicate_classes``.  Input columns so named are replaced."""
    keep = kept_columns(docs, ADDED)
    found = near_duplicate_classes(docs, shingle, distance, agree).dropDuplicates(["__id", "__th"])
    found = found.select(F.col("__id").alias("__i"), F.col("__th").alias("__t"),
                         hex_digits(F.col("__fp")).alias("fingerprint"), "component_id")
    rows = docs.select(*[col(c) for c in keep], *document_key())
    return rows.join(found, F.col("__id").eqNullSafe(F.col("__i")) & (F.col("__th") == F.col("__t"))).select(
        *[col(c) for c in keep], *ADDED)


def hex_digits(c: Column) -> Column:
    return F.lower(F.lpad(F.hex(c), 16, "0"))


def keep_one_per_group(docs: DataFrame, shingle: int = 4, distance: int = 4, agree: int = 3) -> DataFrame:
    """One document of each near-duplicate group: the smallest (doc_id, text
    digest), null ids last.  Same columns as ``docs``; of rows that repeat both
    id and text one stays."""
    found = near_duplicate_classes(docs, shingle, distance, agree)
    order = F.struct(F.col("__id").isNull().alias("n"), F.col("__id").alias("i"), F.col("__th").alias("h"))
    firsts = found.groupBy("__root").agg(F.min(order).alias("o")).select("o.i", "o.h").distinct()
    rows = docs.select("*", *document_key())
    kept = rows.join(firsts, rows["__id"].eqNullSafe(firsts["i"]) & (rows["__th"] == firsts["h"]), "left_semi")
    return kept.dropDuplicates(["__id", "__th"]).drop("__id", "__th")
