"""Row patterns along an order, for keys of any size.

A pattern is compiled to a table of transitions between few states. A stretch of rows is then
a function from the state before it to the state behind it, and functions of neighbouring
stretches compose. So the rows are cut into slices of (key, order); of a key that crosses
a border the slices are summed up as functions, these are composed along the key (one row a slice), and
then every slice runs on its own from the state that it is entered with. There is one way for all
keys, and a key may span any number of tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.ordered import SLICE, slice_groups

THREADS = "array<struct<source: int, ident: bigint, place: bigint>>"
OTHER = "_other"


@dataclass(frozen=True)
class Step:
    """One row whose symbol is among ``symbols``, or one and more such rows."""

    symbols: frozenset[str]
    many: bool = False


def one(*symbols: str) -> Step:
    return Step(frozenset(symbols))


def some(*symbols: str) -> Step:
    return Step(frozenset(symbols), many=True)


class Pattern:
    """Transitions of a list of steps that rows have to take one after the other.

    A state is the steps reached by the attempts under way, oldest first; of two attempts at one
    step the older stays. ``table[state][symbol]`` is the next state, for each of its
    attempts which it was before (-1: begun now), and the attempt that is complete, if any.
    A match is complete at the first row that can end it; of several attempts that end there the
    oldest counts, and behind a match all begin anew.
    """

    def __init__(self, steps: list[Step]):
        if not steps or steps[-1].many:
            raise ValueError("a pattern has steps, and ends with a step of one row")
        self.steps = steps
        self.symbols = sorted({s for step in steps for s in step.symbols})
        states: dict[tuple[int, ...], int] = {(): 0}
        self.table: list[list[tuple[int, tuple[int, ...], int | None]]] = []
        for state in (waiting := [()]):
            row = []
            for symbol in [*self.symbols, OTHER]:
                reached, complete = self._next(state, symbol)
                following = tuple(reached)
                if following not in states:
                    states[following] = len(states)
                    waiting.append(following)
                row.append((states[following], tuple(reached.values()), complete))
            self.table.append(row)

    def _next(self, state: tuple[int, ...], symbol: str) -> tuple[dict[int, int], int | None]:
        reached: dict[int, int] = {}
        last = len(self.steps) - 1
        for attempt, step in [*enumerate(state), (-1, -1)]:
            if symbol in self.steps[step + 1].symbols:
                if step + 1 == last:
                    return {}, attempt
                reached.setdefault(step + 1, attempt)
            if step >= 0 and self.steps[step].many and symbol in self.steps[step].symbols:
                reached.setdefault(step, attempt)
        return reached, None

    def run(self, codes: list[int], idents: list, state: int, attempts: list[tuple], place: int):
        """Matches as ((ident, place) of the first row, index of the last); the state and attempts behind."""
        matches = []
        for k, code in enumerate(codes):
            state, sources, complete = self.table[state][code]
            if complete is not None:
                matches.append((attempts[complete] if complete >= 0 else (idents[k], place + k), k))
            if sources or attempts:
                attempts = [attempts[s] if s >= 0 else (idents[k], place + k) for s in sources]
        return matches, state, attempts


def match_rows(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    ident: str,
    symbol: Column,
    pattern: Pattern,
    slices: int | None = None,
) -> DataFrame:
    """(keys, first, last, n_rows): ``ident`` of the first and last row of each match, and its rows.

    Rows of a key follow ``order`` (a full tie-break, null first) without a gap: a row whose symbol no step
    names ends what is under way; one whose symbol is null is passed over. ``ident`` is a bigint. A null key is a
    key. Steps, and so states, are few; slices are ranges of rows, and the tables of
    borders have one or two rows a slice.
    """
    code = reduce(
        lambda rest, at: F.when(symbol == pattern.symbols[at], at).otherwise(rest),
        range(len(pattern.symbols)),
        F.lit(len(pattern.symbols)),
    )
    rows = df.filter(symbol.isNotNull()).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        *[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)],
        F.col(ident).cast("bigint").alias("_ident"),
        code.alias("_code"),
    )
    key_names, order_names = [f"_k{i}" for i in range(len(keys))], [f"_o{i}" for i in range(len(order))]
    cut = slice_groups(rows, key_names, order_names, slices)
    kinds = ", ".join(f"{k} {cut.schema[k].dataType.simpleString()}" for k in key_names)
    entered = _entered(cut, key_names, order_names, kinds, pattern)
    matched = cut.groupBy(SLICE).cogroup(entered.groupBy(SLICE))
    found = matched.applyInArrow(
        _matches(key_names, order_names, pattern), f"{kinds}, first bigint, last bigint, n_rows bigint"
    )
    return found.select(*[F.col(n).alias(k) for n, k in zip(key_names, keys, strict=True)], "first", "last", "n_rows")


def _entered(cut: DataFrame, keys: list[str], order: list[str], kinds: str, pattern: Pattern) -> DataFrame:
    """For slices that begin within a key: that key, and the state, attempts and place they are entered with."""
    key = F.struct(*keys)
    ends = cut.groupBy(SLICE).agg(F.min(key).alias("_first"), F.max(key).alias("_last"))
    line = Window.orderBy(SLICE)  # one row a slice
    crossing = ends.withColumn("_before", F.lag("_last").over(line)).filter(F.col("_before") == F.col("_first"))
    crossing = F.broadcast(crossing.select(F.col("_first").alias("_crossing")).distinct())
    parts = cut.join(crossing, key == F.col("_crossing"), "left_semi")
    functions = parts.groupBy(SLICE).applyInArrow(
        _function(keys, order, pattern),
        f"{SLICE} int, {kinds}, entry int, exit int, attempts {THREADS}, n_rows bigint",
    )
    return functions.groupBy(*keys).applyInArrow(
        _composed(keys), f"{SLICE} int, {kinds}, state int, attempts {THREADS}, place bigint"
    )


def _segments(rows: pa.Table, keys: list[str], order: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Rows of each key in order."""
    by = [(name, "ascending") for name in (*keys, *order)]
    rows = rows.take(pc.sort_indices(rows, by, null_placement="at_start")).combine_chunks()
    changes = np.zeros(max(len(rows) - 1, 0), bool)
    for name in keys:
        column = rows.column(name)
        here, before = column.slice(1), column.slice(0, max(len(rows) - 1, 0))
        differs = pc.fill_null(pc.not_equal(here, before), False).to_numpy()
        changes |= differs | (pc.is_null(here).to_numpy() != pc.is_null(before).to_numpy())
    cuts = [0, *(np.flatnonzero(changes) + 1).tolist(), len(rows)]
    for begin, end in zip(cuts, cuts[1:], strict=False):
        if end > begin:
            part = rows.slice(begin, end - begin)
            yield tuple(part.column(k)[0].as_py() for k in keys), part


def _function(keys: list[str], order: list[str], pattern: Pattern) -> Callable:
    """What a slice does to each state that a key may enter it with."""

    def run(rows: pa.Table) -> pa.Table:
        out = []
        number = rows.column(SLICE)[0].as_py()
        for key, part in _segments(rows, keys, order):
            codes, idents = part.column("_code").to_pylist(), part.column("_ident").to_pylist()
            for entry, attempts in enumerate(_attempts(pattern)):
                _, state, behind = pattern.run(codes, idents, entry, attempts, 0)
                found = [
                    {"source": ident, "ident": None, "place": None} if place == ENTERED
                    else {"source": -1, "ident": ident, "place": place}
                    for ident, place in behind
                ]
                out.append((number, *key, entry, state, found, len(codes)))
        return _table(out, _schema(rows, keys, "entry", "exit"))

    return run


#: Place of an attempt that was under way before the slice; its ident is which of the state's it is.
ENTERED = -1


def _attempts(pattern: Pattern) -> list[list[tuple]]:
    """Stand-ins for the attempts of each state."""
    sizes = [0] * len(pattern.table)
    for row in pattern.table:
        for state, sources, _ in row:
            sizes[state] = len(sources)
    return [[(k, ENTERED) for k in range(size)] for size in sizes]


def _composed(keys: list[str]) -> Callable:
    """The functions of a key's slices one after the other: what each but the first is entered with."""

    def run(rows: pa.Table) -> pa.Table:
        functions = sorted(rows.to_pylist(), key=lambda r: r[SLICE])
        out, state, attempts, place = [], 0, [], 0
        for number in sorted({r[SLICE] for r in functions}):
            taken = next(r for r in functions if r[SLICE] == number and r["entry"] == state)
            if place:
                found = [{"source": -1, "ident": i, "place": p} for i, p in attempts]
                out.append((number, *[taken[k] for k in keys], state, found, place))
            attempts = [
                attempts[a["source"]] if a["source"] >= 0 else (a["ident"], place + a["place"])
                for a in taken["attempts"]
            ]
            state, place = taken["exit"], place + taken["n_rows"]
        return _table(out, _schema(rows, keys, "state"))

    return run


def _matches(keys: list[str], order: list[str], pattern: Pattern) -> Callable:
    def run(rows: pa.Table, entered: pa.Table) -> pa.Table:
        known = {tuple(e[k] for k in keys): e for e in entered.to_pylist()}  # one at most
        out = []
        for key, part in _segments(rows, keys, order):
            codes, idents = part.column("_code").to_pylist(), part.column("_ident").to_pylist()
            state, attempts, place = 0, [], 0
            if key in known:
                state, place = known[key]["state"], known[key]["place"]
                attempts = [(a["ident"], a["place"]) for a in known[key]["attempts"]]
            for (first, begun), k in pattern.run(codes, idents, state, attempts, place)[0]:
                out.append((*key, first, idents[k], place + k - begun + 1))
        fields = [rows.schema.field(k) for k in keys] + [(n, pa.int64()) for n in ("first", "last", "n_rows")]
        return _table(out, pa.schema(fields))

    return run


def _schema(rows: pa.Table, keys: list[str], *states: str) -> pa.Schema:
    attempt = pa.struct([("source", pa.int32()), ("ident", pa.int64()), ("place", pa.int64())])
    return pa.schema(
        [
            (SLICE, pa.int32()),
            *[rows.schema.field(k) for k in keys],
            *[(name, pa.int32()) for name in states],
            ("attempts", pa.list_(attempt)),
            ("n_rows" if "entry" in states else "place", pa.int64()),
        ]
    )


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.table([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
