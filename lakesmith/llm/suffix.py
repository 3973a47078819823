"""Suffix arrays by induced sorting, in numpy (used inside tasks).

``suffix_array`` classifies suffixes as smaller or larger than their right
neighbour, sorts the leftmost-smaller substrings, names them, sorts the string
of names recursively and induces the order of all suffixes from it in linear
work.  Over a small alphabet the induction goes bucket by bucket, and all
entries of a bucket that are known at a time are handled at once; over a large
one (names) buckets hold few entries, so it goes entry by entry.
"""

from __future__ import annotations

import numpy as np

#: Alphabets up to this size are induced bucket by bucket.
BUCKETED_ALPHABET = 1024


def suffix_array(s: np.ndarray, alphabet: int) -> np.ndarray:
    """Sorted suffixes of ``s``, whose last value 0 occurs nowhere else."""
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int64)
    small = _smaller(s)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    sizes = np.bincount(s, minlength=alphabet)
    first = _induce(s, small, lms, sizes)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    by_substring = first[is_lms[first]]
    names = _names(s, lms, by_substring)
    if names[-1] + 1 < len(lms):  # equal substrings: their order comes from what follows
        place = np.empty(n, np.int64)
        place[by_substring] = names
        order = suffix_array(place[lms], int(names[-1]) + 1)
        by_substring = lms[order]
    return _induce(s, small, by_substring, sizes)


def _smaller(s: np.ndarray) -> np.ndarray:
    """Suffixes smaller than their right neighbour; the last one is."""
    n = len(s)
    change = np.flatnonzero(s[1:] != s[:-1])  # every run of equal values ends at a change, as the last value is unique
    decided = change[np.searchsorted(change, np.arange(n - 1))]
    return np.r_[s[decided] < s[decided + 1], True]


def _names(s: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Names of the sorted leftmost-smaller substrings: equal ones share a name."""
    end = np.empty(len(s), np.int64)
    end[lms] = np.r_[lms[1:], lms[-1]] - lms
    length = end[ordered]
    differ = np.r_[True, length[1:] != length[:-1]]
    open_rows, k = np.flatnonzero(~differ), 0
    while len(open_rows):
        a, b = ordered[open_rows] + k, ordered[open_rows - 1] + k
        unequal = s[a] != s[b]
        differ[open_rows[unequal]] = True
        open_rows = open_rows[~unequal]
        open_rows = open_rows[length[open_rows] > k]
        k += 1
    return np.cumsum(differ) - 1


def _spread(ch: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Stable grouping: order, grouped values, rank inside the group, (value, size) pairs."""
    order = np.argsort(ch, kind="stable")
    grouped = ch[order]
    starts = np.flatnonzero(np.r_[True, grouped[1:] != grouped[:-1]])
    sizes = np.diff(np.r_[starts, len(grouped)])
    rank = np.arange(len(grouped)) - np.repeat(starts, sizes)
    return order, grouped, rank, np.stack([grouped[starts].astype(np.int64), sizes])


def _induce(s: np.ndarray, small: np.ndarray, lms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Order of all suffixes from the order of the leftmost-smaller ones."""
    if len(sizes) > BUCKETED_ALPHABET:
        return _induce_one_by_one(s, small, lms, sizes)
    n, buckets = len(s), np.flatnonzero(sizes)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    out = np.full(n, -1, np.int64)
    # leftmost-smaller suffixes at the ends of their buckets, in the given order
    order, grouped, rank, (values, counts) = _spread(s[lms])
    seed_from = ends.copy()
    seed_from[values] -= counts
    out[seed_from[grouped] + rank] = lms[order]

    def put(entries: np.ndarray, wanted: bool, edge: np.ndarray, step: int) -> None:
        before = entries[entries > 0] - 1
        before = before[small[before] == wanted]
        if len(before):
            order, grouped, rank, (values, counts) = _spread(s[before])
            out[edge[grouped] + step * rank] = before[order]
            edge[values] += step * counts

    head = starts.copy()
    for c in buckets:  # larger suffixes, from the left
        at = starts[c]
        while at < head[c]:
            stop = head[c]
            put(out[at:stop], False, head, 1)
            at = stop
        put(out[seed_from[c]:ends[c]], False, head, 1)
    tail = ends - 1
    for c in buckets[::-1]:  # smaller suffixes, from the right, replacing the seeds
        at = ends[c] - 1
        while at > tail[c]:
            stop = tail[c]
            put(out[stop + 1:at + 1][::-1], True, tail, -1)
            at = stop
        put(out[starts[c]:head[c]][::-1], True, tail, -1)
    out[0] = n - 1  # the end itself is smaller than all and follows from none
    return out


def _induce_one_by_one(s: np.ndarray, small: np.ndarray, lms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    n, letters, is_small = len(s), s.tolist(), small.tolist()
    ends = np.cumsum(sizes)
    order, grouped, rank, (values, counts) = _spread(s[lms])
    from_end = ends.copy()
    from_end[values] -= counts
    seeded = np.full(n, -1, np.int64)
    seeded[from_end[grouped] + rank] = lms[order]
    out, head, tail = seeded.tolist(), (ends - sizes).tolist(), ends.tolist()
    for i in range(n):  # larger suffixes, from the left
        j = out[i] - 1
        if j >= 0 and not is_small[j]:
            c = letters[j]
            out[head[c]] = j
            head[c] += 1
    for i in range(n - 1, -1, -1):  # smaller suffixes, from the right, replacing the seeds
        j = out[i] - 1
        if j >= 0 and is_small[j]:
            c = letters[j]
            tail[c] -= 1
            out[tail[c]] = j
    out[0] = n - 1
    return np.array(out, np.int64)


def common_prefixes(data: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Permuted common prefixes: for each position, the length of the prefix it
    shares with its predecessor in ``order``, capped at ``most``; 0 for the
    first.  ``data``: bytes."""
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    padded = np.r_[data, np.zeros(most + 16, np.uint8)]
    words = np.zeros(len(padded) - 8, np.uint64)
    for i in range(8):
        words |= padded[i:i + len(words)].astype(np.uint64) << np.uint64(8 * i)
    out = np.zeros(n, np.int64)
    mine = np.flatnonzero(before >= 0)
    for k in range(0, most, 8):
        unequal = words[mine + k] ^ words[before[mine] + k]
        # equal low bytes of the words: trailing zero bits over 8
        low = unequal & (~unequal + np.uint64(1))
        out[mine] += np.where(unequal == 0, 8, np.bitwise_count(low - np.uint64(1)).astype(np.int64) // 8)
        mine = mine[unequal == 0]
    return np.minimum(out, most)
