"""Sparse incidence matrices in compressed rows, and their products row by row."""

from typing import NamedTuple

import numpy as np


class Csr(NamedTuple):
    """Row i holds the columns indices[indptr[i]:indptr[i + 1]], each with its value."""

    indptr: np.ndarray
    indices: np.ndarray
    values: np.ndarray
    width: int

    @property
    def rows(self):
        return np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))


def incidence(lengths, width):
    """Rows that cover consecutive runs of columns, of the given lengths."""
    indptr = np.concatenate([[0], np.cumsum(lengths)])
    return Csr(indptr, np.arange(indptr[-1]), np.ones(indptr[-1], dtype=np.int64), width)


def membership(columns, width):
    """Rows with one column each."""
    return Csr(np.arange(len(columns) + 1), columns, np.ones(len(columns), dtype=np.int64), width)


def transpose(m):
    order = np.argsort(m.indices, kind="stable")
    indptr = np.concatenate([[0], np.cumsum(np.bincount(m.indices, minlength=m.width))])
    return Csr(indptr, m.rows[order], m.values[order], len(m.indptr) - 1)


def _product(a, b, first, last):
    """Rows first to last of a times b: each entry of a brings in the row of b that it names."""
    picked = slice(a.indptr[first], a.indptr[last])
    named = a.indices[picked]
    sizes = b.indptr[named + 1] - b.indptr[named]
    at = np.arange(sizes.sum()) + np.repeat(b.indptr[named] - np.cumsum(sizes) + sizes, sizes)
    row = np.repeat(np.repeat(np.arange(first, last), np.diff(a.indptr[first:last + 1])), sizes)
    key = row * b.width + b.indices[at]
    value = np.repeat(a.values[picked], sizes) * b.values[at]
    if len(key) and (key[1:] < key[:-1]).any():
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
    heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else key
    return key[heads] // b.width, key[heads] % b.width, np.add.reduceat(value, heads) if len(key) else value


def row_products(a, b, most=1 << 21):
    """Gustavson's product of a and b as (row, column, value), in pieces of whole rows.

    A piece expands to `most` entries, or to those of one row if that has more.
    """
    sizes = np.concatenate([[0], np.cumsum(b.indptr[a.indices + 1] - b.indptr[a.indices])])
    before = sizes[a.indptr]
    first = 0
    while first < len(before) - 1:
        last = max(first + 1, int(np.searchsorted(before, before[first] + most, side="right")) - 1)
        yield _product(a, b, first, last)
        first = last
