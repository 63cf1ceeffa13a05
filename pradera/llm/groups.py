"""Rows of one group in one task, many groups to a batch: streaming over sorted partitions, and forests of links.

Used where every pair of a group's rows is compared: only links that join what wasn't joined yet leave the task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pradera.session import ship_package

SMALL = 64  # rows of a group that is compared together with others


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups and the places where each begins; the input is sorted by the (whole number) keys."""
    held: list[pa.RecordBatch] = []

    def starts_of(t: pa.Table) -> np.ndarray:
        new = np.zeros(t.num_rows, dtype=bool)
        new[:1] = True
        for k in keys:
            x = t.column(k).to_numpy()
            new[1:] |= x[1:] != x[:-1]
        return np.flatnonzero(new)

    def same(a: pa.RecordBatch, i: int, b: pa.RecordBatch, j: int) -> bool:
        return all(a.column(k)[i].as_py() == b.column(k)[j].as_py() for k in keys)

    for b in batches:
        if not b.num_rows:
            continue
        if held and same(held[0], 0, b, 0) and same(b, 0, b, b.num_rows - 1):
            held.append(b)  # the group goes on
            continue
        t = pa.Table.from_batches([*held, b]).combine_chunks()
        starts = starts_of(t)
        last = int(starts[-1])
        if last:
            yield t.slice(0, last), starts[:-1]
        held = t.slice(last).combine_chunks().to_batches()
    if held:
        t = pa.Table.from_batches(held).combine_chunks()
        yield t, starts_of(t)


def over_groups(rows: DataFrame, keys: list[str], order: str, fn: Callable, schema: str) -> DataFrame:
    """``fn(table, starts)`` -> record batches, over whole groups; a group's rows come in the order of ``order``."""
    ship_package(rows.sparkSession)

    def run(batches):
        for table, starts in whole_groups(batches, keys):
            yield from fn(table, starts)
    return rows.repartition(*keys).sortWithinPartitions(*keys, order).mapInArrow(run, schema)


def binary_rows(column: pa.ChunkedArray, width: int, dtype) -> np.ndarray:
    """Matrix of a binary column whose values all have ``width`` elements."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype).reshape(len(column), width)


class Forest:
    """Labels of joined rows, and the links that joined them."""

    def __init__(self, n: int):
        self.label, self.a, self.b = np.arange(n), [], []

    def _root(self, i: int) -> int:
        up = self.label
        while up[i] != i:
            up[i] = up[up[i]]
            i = int(up[i])
        return i

    def add(self, pairs_i: np.ndarray, pairs_j: np.ndarray) -> None:
        for i, j in zip(pairs_i.tolist(), pairs_j.tolist(), strict=True):
            x, y = self._root(i), self._root(j)
            if x != y:
                self.label[max(x, y)] = min(x, y)
                self.a.append(i)
                self.b.append(j)


def link_forest(starts: np.ndarray, blk: np.ndarray, within: np.ndarray, like: Callable) -> Forest:
    """Forest of the like pairs of every group.

    ``blk``: each row's block; ``within``: whether the row's group is one block compared with itself, else only rows of
    different blocks are compared.  ``like(i, j)``: mask for index arrays, or for one index and an array.
    Small groups are compared all at once, a distance at a time; in a large one a row is compared with those that it
    isn't joined with yet.
    """
    n = len(blk)
    size = np.diff(np.r_[starts, n])
    forest = Forest(n)
    place = np.arange(n) - np.repeat(starts, size)
    room = np.repeat(size, size) - place  # rows of the group from here on
    room[np.repeat(size, size) > SMALL] = 0
    for d in range(1, int(room.max(initial=0))):
        i = np.flatnonzero(room > d)
        i = i[within[i] | (blk[i] != blk[i + d])]
        if len(i):
            hit = i[like(i, i + d)]
            forest.add(hit, hit + d)
    for s, k in zip(starts[size > SMALL].tolist(), size[size > SMALL].tolist(), strict=True):
        label = np.arange(k)  # flat labels of this group
        first = blk[s]
        rows = np.arange(k) if within[s] else np.flatnonzero(blk[s:s + k] == first)
        for i in rows.tolist():
            other = np.arange(i + 1, k) if within[s] else np.flatnonzero(blk[s:s + k] != first)
            other = other[label[other] != label[i]]
            if not len(other):
                continue
            hit = other[like(s + i, s + other)]
            new, at = np.unique(label[hit], return_index=True)
            for x, j in zip(new.tolist(), hit[at].tolist(), strict=True):
                low, high = min(x, label[i]), max(x, label[i])
                label[label == high] = low
                forest.a.append(s + i)
                forest.b.append(s + j)
    return forest
