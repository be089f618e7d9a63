"""Rows of a task against claims on their columns: that some tell rows apart, that some determine another.

A claim is numbered, and stands at its base, the columns that form groups: the key itself, or the
determinant of a dependency. Rows that agree on a base contradict it; rows alone in
their group contradict nothing that has more columns, and are left out from there on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

#: Of the rows of a task, one in so many is looked at first: claims that many rows contradict end there.
FIRST = 16
#: Number that a task returns if it did not hold all its rows.
NOT_ALL = -1
Base = tuple[int, ...]


@dataclass
class Claims:
    """Numbers of the claims at a base: that it is a key, and that it determines a column."""

    key: int | None = None
    dependents: dict[int, int] = field(default_factory=dict)

    def numbers(self) -> set[int]:
        return {*self.dependents.values()} | ({self.key} if self.key is not None else set())


class _Node:
    def __init__(self) -> None:
        self.claims, self.after = Claims(), {}


def contradictions(
    by_task: dict[int, dict[Base, Claims]], most_bytes: int, whole: bool
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow``: the numbers of the claims that the rows of a task contradict.

    Rows name the claims that they meet in column ``task``; the others are in the order of the bases'
    places. A task holds ``most_bytes``; of further rows it knows nothing, and says so if ``whole``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, all_held = [], 0, True
        for batch in batches:
            all_held = all_held and size + batch.nbytes <= most_bytes
            if all_held and batch.num_rows:
                held.append(batch)
                size += batch.nbytes
        found: set[int] = set() if all_held or not whole else {NOT_ALL}
        if held:
            table = pa.Table.from_batches(held)
            held.clear()
            tasks = table.column("task").to_numpy()
            columns = table.drop_columns("task")
            for task in np.unique(tasks):
                own = columns if len(by_task) == 1 else columns.filter(pa.array(tasks == task))
                found |= contradicted([_codes(c) for c in own.columns], by_task[int(task)])
        yield pa.record_batch({"claim": pa.array(sorted(found), pa.int32())})

    return run


def contradicted(codes: list[np.ndarray], claims: dict[Base, Claims]) -> set[int]:
    """Numbers of the claims that rows, given as a code per value, contradict."""
    if not claims or not codes or len(codes[0]) < 2:
        return set()
    sizes = [int(c.max()) + 1 for c in codes]
    # What all bases begin with is seen in whole groups.
    lead = {base[0] if base else None for base in claims}
    one = lead.pop() if len(lead) == 1 else None
    order = np.arange(len(codes[0])) if one is None else codes[one]
    first = np.flatnonzero(order < (int(order.max()) + 1) // FIRST)
    found = _seen(_tree(claims, set()), codes, sizes, first)
    return found | _seen(_tree(claims, found), codes, sizes, np.arange(len(codes[0])))


def _tree(claims: dict[Base, Claims], without: set[int]) -> _Node:
    root = _Node()
    for base, own in claims.items():
        left = Claims(
            None if own.key in without else own.key, {c: n for c, n in own.dependents.items() if n not in without}
        )
        if left.numbers():
            node = root
            for c in base:
                node = node.after.setdefault(c, _Node())
            node.claims = left
    return root


def _seen(root: _Node, codes: list[np.ndarray], sizes: list[int], rows: np.ndarray) -> set[int]:
    found: set[int] = set()

    def visit(node: _Node, rows: np.ndarray, groups: np.ndarray) -> None:
        if len(rows) < 2:
            return
        if node.claims.key is not None:
            found.add(node.claims.key)
        if node.claims.dependents:
            same = groups[1:] == groups[:-1]
            for c, number in node.claims.dependents.items():
                values = codes[c][rows]
                if (same & (values[1:] != values[:-1])).any():
                    found.add(number)
        for c, child in node.after.items():
            visit(child, *_refined(rows, groups, codes[c], sizes[c]))

    visit(root, rows, np.zeros(len(rows), np.int64))
    return found


def _refined(rows: np.ndarray, groups: np.ndarray, codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The groups cut by a further column, those of one row left out; a group's rows are neighbours."""
    both = groups * size + codes[rows]
    bits = len(rows).bit_length()
    if (int(groups[-1]) + 1) * size < 1 << (62 - bits):  # values that hold their places sort faster
        both = np.sort((both << bits) | np.arange(len(rows)))
        order, both = both & ((1 << bits) - 1), both >> bits
    else:
        order = np.argsort(both)
        both = both[order]
    begins = np.ones(len(both) + 1, bool)
    begins[1:-1] = both[1:] != both[:-1]
    several = ~(begins[:-1] & begins[1:])
    return rows[order[several]], np.cumsum(begins[:-1])[several]


def _codes(column: pa.ChunkedArray) -> np.ndarray:
    """A number for each different value; null is one of them."""
    return column.combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)


def largest_groups(bases: list[Base], enough: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow`` over one task: rows in the largest group of what the bases hold, and bytes of the columns.

    Sets are tried smallest first, and not beyond one whose largest group has
    at most the share ``enough`` of the rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        found: list[tuple[list[int], int, int]] = []
        if held:
            table = pa.Table.from_batches(held)
            codes = [_codes(c) for c in table.columns]
            sizes = [int(c.max()) + 1 for c in codes]
            found.append(([], table.num_rows, 0))
            large: set[frozenset[int]] = {frozenset()}
            wanted = {frozenset([i]) for i in range(len(codes))}
            while wanted:
                for s in wanted:
                    rows, groups = np.arange(table.num_rows), np.zeros(table.num_rows, np.int64)
                    for c in s:
                        if len(rows):
                            rows, groups = _refined(rows, groups, codes[c], sizes[c])
                    top = int(np.bincount(groups).max()) if len(rows) else 1
                    found.append((sorted(s), top, table.column(min(s)).nbytes if len(s) == 1 else 0))
                    if top > enough * table.num_rows:
                        large.add(s)
                further = {s | {c} for s in wanted & large for base in bases if s < set(base) for c in set(base) - s}
                wanted = {s for s in further if all(s - {c} in large for c in s)}
        columns, top, size = zip(*found, strict=True) if found else ((), (), ())
        yield pa.record_batch(
            {
                "columns": pa.array(list(columns), pa.list_(pa.int32())),
                "top": pa.array(list(top), pa.int64()),
                "bytes": pa.array(list(size), pa.int64()),
            }
        )

    return run
