"""Sparse matrices in compressed-row form and their products by rows (numpy, inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Products formed at a time.
PRODUCTS = 1 << 21


@dataclass(frozen=True)
class Csr:
    """Row r holds columns ``indices[indptr[r]:indptr[r + 1]]`` (ascending) with their ``values``."""
    indptr: np.ndarray
    indices: np.ndarray
    values: np.ndarray
    columns: int

    @staticmethod
    def of(rows: np.ndarray, cols: np.ndarray, shape: tuple[int, int]) -> Csr:
        """The incidence counts of (row, column) occurrences in any order."""
        cells, counts = runs(_sorted(rows * np.int64(shape[1]) + cols))
        at = cells // shape[1]
        return Csr(np.r_[0, np.cumsum(np.bincount(at, minlength=shape[0]))], cells - at * shape[1], counts, shape[1])

    def row_of_entry(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))

    def transpose(self) -> Csr:
        order = np.argsort(self.indices, kind="stable")
        sizes = np.bincount(self.indices, minlength=self.columns)
        return Csr(np.r_[0, np.cumsum(sizes)], self.row_of_entry()[order], self.values[order], len(self.indptr) - 1)


def _sorted(x: np.ndarray) -> np.ndarray:
    return x if len(x) < 2 or (x[1:] >= x[:-1]).all() else np.sort(x)


def runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different values of a sorted array and how often each occurs."""
    starts = np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else np.zeros(0, np.int64)
    return x[starts], np.diff(np.r_[starts, len(x)])


def add_equal(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, ascending, and the sum of the values of each."""
    if len(keys) > 1 and not (keys[1:] >= keys[:-1]).all():
        order = np.argsort(keys, kind="stable")
        keys, values = keys[order], values[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.add.reduceat(values, starts) if len(starts) else values


def row_products(a: Csr, b: Csr, most: int = PRODUCTS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Gustavson's product a x b: row i is the sum of b's rows k, scaled by a[i, k].

    Yields (row, column, value) blocks in row order.  A block forms about
    ``most`` products, so no dense group is ever expanded whole; a row cut
    between two blocks appears in both, its cells to be added up.
    """
    row, per_entry = a.row_of_entry(), np.diff(b.indptr)[a.indices]
    upto = np.cumsum(per_entry)
    low = 0
    while low < len(row):
        done = upto[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(upto, done + most, side="right")))
        sizes = per_entry[low:high]
        first = b.indptr[a.indices[low:high]]
        at = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        cells, values = add_equal(np.repeat(row[low:high], sizes) * np.int64(b.columns) + b.indices[at],
                                  np.repeat(a.values[low:high], sizes) * b.values[at])
        if len(cells):
            yield cells // b.columns, cells % b.columns, values
        low = high
