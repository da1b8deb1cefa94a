"""Comparing all members of a group with each other in blocks, without a row per pair and without a whole group."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(table, where its groups begin) with whole groups of rows equal in ``keys``, out of batches sorted by them."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        if not table.num_rows:
            continue
        new = _bounds(table, keys)
        rest = table.slice(new[-1])
        if new[-1]:
            yield table.slice(0, new[-1]).combine_chunks(), new[:-1]
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks(), np.array([0])


def _bounds(table: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """Where groups begin."""
    changed = np.zeros(table.num_rows, bool)
    changed[0] = True
    for key in keys:
        column = table.column(key)
        same = pc.fill_null(pc.equal(column.slice(1), column.slice(0, table.num_rows - 1)), False)
        changed[1:] |= ~np.asarray(same)
    return np.flatnonzero(changed)


def lists(table: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column."""
    array = table.column(column).combine_chunks()
    return np.asarray(array.flatten()), np.concatenate(([0], np.cumsum(np.asarray(pc.list_value_length(array)))))


def local_roots(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest id reachable from each row by links i-j."""
    root = ids.copy()
    while True:
        before = root.copy()
        least = np.minimum(root[i], root[j])
        np.minimum.at(root, i, least)
        np.minimum.at(root, j, least)
        if (before == root).all():
            return root


def intersections(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sizes of all pairwise intersections of a few sets; only members of two sets at least are counted out."""
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.argsort(values)
    v, r = values[order], rows[order]
    start = np.flatnonzero(np.append(True, v[1:] != v[:-1]))
    count = np.diff(np.append(start, len(v)))
    column = np.repeat(np.cumsum(count > 1) - 1, count)
    shared = np.repeat(count > 1, count)
    column, r = column[shared], r[shared]
    n = len(bounds) - 1
    both = np.zeros((n, n), np.float64)
    step = 4096
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        a, b = np.searchsorted(column, (low, low + step))
        part = np.zeros((n, step), np.float32)
        part[r[a:b], column[a:b] - low] = 1
        both += part @ part.T
    return both
