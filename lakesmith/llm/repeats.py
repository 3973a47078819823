"""Removal of repeated byte strings by suffix arrays (operator 7).

A byte goes if it lies in a string of ``length`` bytes that also starts in a
document with a smaller id.  Suffix arrays find those strings, shard by shard;
routing sees to it that equal strings always meet in one shard:

1. Every window of ``length`` bytes has an anchor, the smallest hash among its
   grams.  Equal windows have equal anchors, and neighbouring windows mostly
   share one, so a text is cut into segments of windows with one anchor.
2. Anchors of a single text cannot repeat; a grouped minimum and maximum of the
   text digests per anchor leaves the others (a fraction of the text).
3. The segments of shared anchors are routed by anchor.  An anchor with more
   than ``HOT`` occurrences routes each of its windows by the window's own hash,
   so that a passage in a third of all documents spreads over the shards.
4. Segments arrive sorted by bytes, then id.  Windows routed by themselves, and
   keys that all rows fill with the same bytes, are decided as they stream by:
   the first row has the least id.  The other segments are gathered in shards of about ``SHARD_BYTES``, sorted by
   induced sorting, and permuted common prefixes of ``length`` bytes delimit
   groups of equal windows; the least id of a group decides for all its windows.
5. Decisions return to the documents as intervals, which remove the bytes.

Documents with the text of a smaller id repeat as a whole: of equal texts only
the first one's segments are looked at.  The three phases (shared anchors,
decisions, removal) are queries of their own whose results are written, so the
disk holds the shuffles of one phase at a time.  Texts meet their anchors and
decisions by a 64-bit digest; what the joins bring is told apart by id, size and
a second digest, so texts that share a digest get none of each other's results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesmith.llm.common import col, finished, kept_columns, text_of
from lakesmith.llm.suffix import common_prefixes, suffix_array

#: Longer grams meet by chance less often, shorter ones make fewer anchors.
LENGTH, GRAM = 50, 16
#: Occurrences of an anchor before its windows are routed one by one.
HOT = 20_000
#: Bytes of distinct segments sorted at a time.
SHARD_BYTES = 1 << 20
#: Most windows of one segment.
SEGMENT_WINDOWS = 256
#: Windows of a long text hashed at a time.
HASHED_AT_ONCE = 1 << 20
#: Order of a null id: after all others, which then never repeat one another.
LAST = (1 << 63) - 1
ADDED = ["n_bytes", "n_removed", "n_spans", "kept"]

_MULTIPLY, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def window_anchors(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """The anchor of every window: the least hash of its grams (gram: a power of two)."""
    if len(data) < length:
        return np.zeros(0, np.uint64)
    value, k = (data.astype(np.uint64) + np.uint64(1)) * _MULTIPLY, 1
    while k < gram:  # hashes of twice as many bytes
        value = value[:-k] * _MIX + value[k:]
        value ^= value >> np.uint64(32)
        value *= _MULTIPLY
        k *= 2
    span, k = length - gram + 1, 1
    while 2 * k <= span:  # minimum of twice as many grams
        value, k = np.minimum(value[:-k], value[k:]), 2 * k
    return np.minimum(value[:len(value) - (span - k)], value[span - k:]) if span > k else value


def window_hashes(data: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """A hash of every whole window, put together from hashes of 1, 2, 4, ... bytes."""
    n = len(data) - length + 1
    value, k = (data.astype(np.uint64) + np.uint64(1)) * _MULTIPLY, 1
    total, done = np.zeros(max(n, 0), np.uint64), 0
    while n > 0 and k <= length:
        if length & k:
            total = total * _MIX + value[done:done + n]
            total ^= total >> np.uint64(29)
            done += k
        value = value[:-k] * _MIX + value[k:]
        value ^= value >> np.uint64(32)
        value *= _MULTIPLY
        k *= 2
    return total


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _blocks(data: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """Parts of a long text that together hold each of its windows once."""
    for low in range(0, max(0, len(data) - length + 1), HASHED_AT_ONCE):
        yield low, data[low:low + HASHED_AT_ONCE + length - 1]


def _anchor_rows(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, owners = [np.zeros(0, np.uint64)], []
            for text in batch.column("bytes"):
                parts = [np.unique(window_anchors(part, length, gram))
                         for _, part in _blocks(np.frombuffer(text.as_py(), np.uint8), length)]
                found = np.unique(np.concatenate(parts)) if len(parts) > 1 else parts[0] if parts else hashes[0]
                hashes.append(found)
                owners.append(len(found))
            rows = pa.array(np.repeat(np.arange(batch.num_rows), owners))
            yield pa.RecordBatch.from_arrays([pa.array(_signed(np.concatenate(hashes))), batch.column("th").take(rows)], ["h", "th"])
    return run


def _member(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which values occur in ``of``: ``np.isin`` for the short arrays of one text."""
    if not len(of):
        return np.zeros(len(values), bool)
    known = np.sort(of)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def cut_segments(data: np.ndarray, shared: np.ndarray, hot: np.ndarray, length: int = LENGTH,
                 gram: int = GRAM) -> Iterator[tuple[bool, int, int, int]]:
    """(hot, key, start, end) of the text's segments whose anchors are shared;
    windows of hot anchors one by one."""
    for low, part in _blocks(data, length):
        anchors = _signed(window_anchors(part, length, gram))
        starts = np.flatnonzero(np.r_[True, anchors[1:] != anchors[:-1]])
        ends = np.r_[starts[1:], len(anchors)]
        for k in np.flatnonzero(_member(anchors[starts], shared)):
            for a in range(starts[k], ends[k], SEGMENT_WINDOWS):
                yield False, int(anchors[a]), low + a, low + min(a + SEGMENT_WINDOWS, ends[k]) - 1 + length
        for k in np.flatnonzero(_member(anchors[starts], hot)):
            keys = _signed(window_hashes(part[starts[k]:ends[k] - 1 + length], length))
            for i, key in enumerate(keys.tolist(), low + int(starts[k])):
                yield True, key, i, i + length


def _segment_rows(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, rows, parts, size = [], [], [], 0
            columns = [batch.column(c) for c in ("bytes", "cold", "hot")]
            for i in range(batch.num_rows):
                text, cold, hot = columns[0][i].as_py(), *(c[i].values.to_numpy() for c in columns[1:])
                for segment in cut_segments(np.frombuffer(text, np.uint8), cold, hot, length, gram):
                    found.append(segment[:3])
                    rows.append(i)
                    parts.append(text[segment[2]:segment[3]])
                    size += len(parts[-1]) + 100
                    if size > SHARD_BYTES:
                        yield pack(batch, found, rows, parts)
                        found, rows, parts, size = [], [], [], 0
            yield pack(batch, found, rows, parts)

    def pack(batch, found, rows, parts) -> pa.RecordBatch:
        at = pa.array(rows, pa.int64())
        hot, keys, starts = zip(*found) if found else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(hot, pa.bool_()), pa.array(keys, pa.int64()), *[batch.column(c).take(at) for c in ("th", "no", "nb")],
             pa.array(starts, pa.int32()), pa.array(parts, pa.binary())], ["hot", "key", "th", "no", "nb", "start", "seg"])
    return run


def with_shared_windows(data: np.ndarray, owner: np.ndarray, whole: np.ndarray, length: int) -> np.ndarray:
    """Which owners may share a window with another one: equal windows have equal hashes."""
    at = np.flatnonzero(whole)
    out = np.zeros(int(owner[-1]) + 1, bool)
    if len(at):
        hashes, mine = window_hashes(data, length)[at], owner[at]
        order = np.argsort(hashes, kind="stable")
        hashes, mine = hashes[order], mine[order]
        starts = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
        several = np.minimum.reduceat(mine, starts) < np.maximum.reduceat(mine, starts)
        out[mine[np.repeat(several, np.diff(np.r_[starts, len(mine)]))]] = True
    return out


def shard_groups(segments: list[bytes], least: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For every position of the joined segments (one byte apart), the least id
    that has the window starting there; ``LAST`` where no whole window starts."""
    data = np.frombuffer(b"\0".join(segments) + b"\0", np.uint8)
    sizes = np.array([len(x) for x in segments])
    ends = np.cumsum(sizes + 1) - 1
    text = data.astype(np.uint16) + np.uint16(2)
    text[ends] = 1
    order = suffix_array(np.r_[text, np.uint16(0)], 258)[1:]
    prefixes = common_prefixes(data, order, length)
    owner = np.repeat(np.arange(len(segments)), sizes + 1)
    whole = np.arange(len(data)) + length <= ends[owner]
    # positions without a whole window stand for themselves: their prefixes run over a boundary
    prefixes[~whole] = 0
    values = np.where(whole, least[owner], LAST)[order]
    starts = np.flatnonzero(prefixes[order] < length)
    out = np.empty(len(data), np.int64)
    out[order] = np.repeat(np.minimum.reduceat(values, starts), np.diff(np.r_[starts, len(order)]))
    out[~whole] = LAST
    return out


class _Shard:
    """Segments of whole keys: different bytes once, with the least id that has
    them, and the rows that stand behind them."""

    def __init__(self) -> None:
        self.parts: list[bytes] = []
        self.least: list[int] = []
        self.owners: list[np.ndarray] = []
        self.rows: list[pa.RecordBatch] = []
        self.size = 0

    def add(self, rows: pa.RecordBatch, runs: np.ndarray, fresh: bool) -> None:
        """``runs``: first rows of runs of equal bytes; unless ``fresh``, the first run goes on with the last bytes."""
        numbers = np.zeros(rows.num_rows, np.int64)
        numbers[runs] = 1
        if not fresh:
            numbers[0] = 0
        self.owners.append(np.cumsum(numbers) + len(self.parts) - 1)
        taken = runs if fresh else runs[1:]
        segs, least = rows.column("seg").take(pa.array(taken)).to_pylist(), rows.column("no").take(pa.array(taken)).to_pylist()
        self.parts += segs
        self.least += least
        self.rows.append(rows.select(_ROW))
        self.size += sum(map(len, segs))

    def decided(self, length: int) -> Iterator[pa.RecordBatch]:
        """(th, no, nb, a, b): bytes a to b of a document stand in one with a smaller id."""
        least, sizes = np.array(self.least, np.int64), np.array([len(x) + 1 for x in self.parts])
        first, owner = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(sizes)), sizes)
        whole = np.arange(int(sizes.sum())) + length < (first + sizes)[owner]
        groups = np.where(whole, least[owner], LAST)
        # only segments that may share a window with another one are sorted
        mixed = with_shared_windows(np.frombuffer(b"\0".join(self.parts) + b"\0", np.uint8), owner, whole, length)
        if mixed.any():
            groups[mixed[owner]] = shard_groups([x for x, m in zip(self.parts, mixed) if m], least[mixed], length)
        # runs of positions of a segment whose windows have one least id
        edge = np.flatnonzero(np.r_[True, (groups[1:] != groups[:-1]) | (owner[1:] != owner[:-1])])
        stop = np.r_[edge[1:], len(groups)]
        real = groups[edge] != LAST
        edge, stop = edge[real], stop[real]
        runs_of = np.searchsorted(owner[edge], np.arange(len(sizes) + 1))  # runs of each segment
        for rows, owners in zip(self.rows, self.owners):
            many = np.diff(runs_of)[owners]
            at = np.repeat(np.arange(len(owners)), many)
            run = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many) + runs_of[owners][at]
            later = groups[edge[run]] < rows.column("no").to_numpy()[at]
            at, run = at[later], run[later]
            start = rows.column("start").to_numpy()[at] - first[owners[at]]
            yield _cut_rows(rows, at, start + edge[run], start + stop[run] - 1 + length)


_ROW = ["th", "no", "nb", "start"]
_CUT = ["th", "no", "nb", "a", "b"]


def _cut_rows(rows: pa.RecordBatch, at: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    where = pa.array(at)
    return pa.RecordBatch.from_arrays([*[rows.column(c).take(where) for c in _ROW[:3]],
                                       pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))], _CUT)


def _shard_rows(length: int):
    """Decisions about sorted (hot, key, seg, no) rows."""

    def changes(rows: pa.RecordBatch, column: str) -> np.ndarray:
        values = rows.column(column)
        return np.r_[True, pc.not_equal(values.slice(1), values.slice(0, len(values) - 1)).to_numpy(zero_copy_only=False)]

    def whole_keys(key: np.ndarray, seg: np.ndarray, closed: bool) -> np.ndarray:
        """Rows of keys that begin and end in the batch and hold one segment's bytes only."""
        if not len(key):
            return np.zeros(0, bool)
        group = np.cumsum(key)  # 0: goes on from the batch before
        n_segs = np.bincount(group, weights=seg, minlength=group[-1] + 1)
        good = n_segs == 1
        good[0] = False
        if not closed:
            good[-1] = False
        return good[group]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, last, least = _Shard(), None, LAST
        for batch in batches:
            if not batch.num_rows:
                continue
            key, seg, hot = changes(batch, "key"), changes(batch, "seg"), changes(batch, "hot")
            key |= hot
            seg |= key
            now = [batch.column(c)[0].as_py() for c in ("hot", "key", "seg")]
            key[0] = last is None or now[:2] != last[:2]
            seg[0] = key[0] or now[2] != last[2]
            n_cold = batch.num_rows - int(np.count_nonzero(batch.column("hot").to_numpy(zero_copy_only=False)))  # these come first
            cold, cold_key, cold_seg = batch.slice(0, n_cold), key[:n_cold], seg[:n_cold]
            sizes = pc.binary_length(cold.column("seg")).to_numpy(zero_copy_only=False)
            same = whole_keys(cold_key, cold_seg, n_cold < batch.num_rows)
            if same.any():  # all rows of a key hold the same bytes: the first one has the least id
                numbers = cold.column("no").to_numpy()
                mine = numbers[np.maximum.accumulate(np.where(cold_key, np.arange(n_cold), 0))]
                later = np.flatnonzero(same & (mine < numbers))
                start = cold.column("start").to_numpy()[later]
                yield _cut_rows(cold, later, start, start + sizes[later])
                cold, cold_key, cold_seg, sizes = cold.filter(pa.array(~same)), cold_key[~same], cold_seg[~same], sizes[~same]
            upto = np.r_[0, np.cumsum(np.where(cold_seg, sizes, 0))]
            low = 0
            while low < cold.num_rows:  # whole keys up to a full shard; the last key of the batch may go on
                if cold_key[low] and shard.size > SHARD_BYTES:
                    yield from shard.decided(length)
                    shard = _Shard()
                ends = low + 1 + np.flatnonzero(cold_key[low + 1:])
                full = ends[shard.size + upto[ends] - upto[low] > SHARD_BYTES]
                high = int(full[0]) if len(full) else cold.num_rows
                runs, fresh = np.flatnonzero(cold_seg[low:high]), bool(cold_seg[low])
                shard.add(cold.slice(low, high - low), runs if fresh else np.r_[0, runs], fresh)
                low = high
            if n_cold < batch.num_rows:  # windows routed by themselves: ids ascend in a run
                numbers = batch.column("no").to_numpy()[n_cold:]
                fresh = seg[n_cold:]
                starts = np.flatnonzero(fresh)
                firsts = np.r_[least, numbers[starts]]
                mine = firsts[np.cumsum(fresh)]
                later = np.flatnonzero(mine < numbers)
                least = int(mine[-1])
                start = batch.column("start").to_numpy()[n_cold:][later]
                yield _cut_rows(batch, later + n_cold, start, start + length)
            last = [batch.column(c)[batch.num_rows - 1].as_py() for c in ("hot", "key", "seg")]
        if shard.parts:
            yield from shard.decided(length)
    return run


def removed_spans(size: int, intervals, whole: bool, length: int = LENGTH) -> list[tuple[int, int]]:
    """Maximal removed runs of a text of ``size`` bytes."""
    if whole:
        return [(0, size)] if size >= length else []
    out: list[tuple[int, int]] = []
    for a, b in sorted(intervals or ()):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _finish(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, gone, spans, kept = [], [], [], []
            for text, no, y, firsts, found in zip(*(batch.column(c) for c in ("bytes", "no", "y", "firsts", "found"))):
                text, me, y = text.as_py(), no.as_py(), y.as_py()
                copy = any(f["first"] < me for f in firsts.as_py() or () if (f["nb"], f["y"]) == (len(text), y))
                mine = []
                if found.is_valid:
                    owner, size, a, b = (x.to_numpy() for x in found.values.flatten())
                    own = (owner == me) & (size == len(text))
                    mine = list(zip(a[own].tolist(), b[own].tolist()))
                cut = removed_spans(len(text), mine, copy, length)
                sizes.append(len(text))
                gone.append(sum(b - a for a, b in cut))
                spans.append(len(cut))
                edges = [0, *(x for ab in cut for x in ab), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("no"), batch.column("th"), *(pa.array(x, pa.int64()) for x in (sizes, gone, spans)),
                 pa.array(kept, pa.binary())], ["no", "th", *ADDED])
    return run


def _present(rows: DataFrame) -> DataFrame:
    """The same rows, stated to hold no null: joins and groupings then infer no
    filters of their own, and all uses of an exchange of them have one plan."""
    return rows.where(" and ".join(f"{c} is not null" for c in rows.columns))


def order_number(id_col: str) -> Column:
    return F.coalesce(col(id_col).cast("long"), F.lit(LAST))


def _anchor_lists(texts: DataFrame, length: int, gram: int, hot: int) -> DataFrame:
    """(th, cold, hot): the anchors that each text shares with another one."""
    keyed = _present(texts.select("th", "bytes").mapInArrow(_anchor_rows(length, gram), "h long, th long")).repartition("h")
    # all uses of the exchange read the same columns, so it is made once
    shared = keyed.groupBy("h").agg(F.min("th").alias("a"), F.max("th").alias("b"), F.count("th").alias("n")).where("a < b")
    marked = keyed.join(shared.select("h", (F.col("n") > hot).alias("hot")), "h")
    return marked.groupBy("th").agg(F.collect_set(F.when(~F.col("hot"), F.col("h"))).alias("cold"),
                                    F.collect_set(F.when(F.col("hot"), F.col("h"))).alias("hot"))


def _decided_cuts(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """(th, found): the intervals that go, by text."""
    segments = texts.mapInArrow(_segment_rows(length, gram), "hot boolean, key long, th long, no long, nb int, start int, seg binary")
    decided = segments.repartition("key").sortWithinPartitions("hot", "key", "seg", "no").mapInArrow(
        _shard_rows(length), "th long, no long, nb int, a int, b int")
    return decided.groupBy("th").agg(F.collect_list(F.struct("no", "nb", "a", "b")).alias("found"))


def cut_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id",
                text_col: str = "text", hot: int = HOT) -> DataFrame:
    """(no, th, n_bytes, n_removed, n_spans, kept), one row per input row: id
    order (``LAST`` for a null id), text digest, sizes, maximal removed runs and
    the remaining bytes.  ``gram`` is a power of two up to ``length``.

    Null texts count as empty; texts shorter than ``length`` keep all bytes.
    Rows with one id never remove each other's strings; null ids come after
    all others.  An empty table gives an empty result.
    """
    text = text_of(text_col)
    who = [F.xxhash64(text).alias("th"), order_number(id_col).alias("no"), F.octet_length(text).alias("nb"),
           F.xxhash64(F.lit(1), text).alias("y")]
    rows = docs.select(*who, text.cast("binary").alias("bytes"))
    # the first document of every text: narrow rows, counted map-side
    texts = docs.select(*who).groupBy("th", "nb", "y").agg(F.min("no").alias("first"), F.max("no").alias("last"))
    firsts = finished(texts.groupBy("th").agg(F.collect_list(F.struct("nb", "y", "first")).alias("firsts"),
                                              F.bool_or(F.col("first") < F.col("last")).alias("copied")), "repeats-texts")
    lists = finished(_anchor_lists(rows, length, gram, hot), "repeats-anchors")

    own = F.exists("firsts", lambda f: (f["nb"] == F.col("nb")) & (f["y"] == F.col("y")) & (f["first"] == F.col("no")))
    marked = rows.join(lists.join(firsts.drop("copied"), "th"), "th").where(own)
    cut = finished(_decided_cuts(marked.select("th", "no", "nb", "bytes", "cold", "hot"), length, gram), "repeats-cuts")

    known = firsts.where("copied").drop("copied").join(cut, "th", "full")
    return rows.join(known, "th", "left").select("no", "th", "y", "bytes", "firsts", "found").mapInArrow(
        _finish(length), "no long, th long, n_bytes long, n_removed long, n_spans long, kept binary")


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``docs`` plus n_bytes, n_removed, n_spans and ``kept`` (binary), see
    ``cut_repeats``; input columns so named are replaced."""
    keep = kept_columns(docs, ADDED)
    found = cut_repeats(docs, length, gram).dropDuplicates(["no", "th", "n_bytes"])
    rows = docs.select(*[col(c).alias(f"c{i}") for i, c in enumerate(keep)], order_number("doc_id").alias("no"),
                       F.xxhash64(text_of()).alias("th"), F.octet_length(text_of()).cast("long").alias("n_bytes"))
    return rows.join(found, ["no", "th", "n_bytes"]).select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], *ADDED)
