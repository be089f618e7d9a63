"""Recompression of word sequences: rounds that name runs and pairs of symbols.

A symbol starts as a word. A run round turns each maximal run of one symbol into a
symbol named by that symbol and the run's length. A pair round splits all names into left
and right ones by a bit of their hash and turns each left symbol with a right one
behind it into a symbol named by both. Names are hashes of what they stand for, so tasks
that never meet give equal names to equal content, without a dictionary.

Whether a symbol arises depends on a few neighbours. Each symbol carries the span of words
that decided it: where another text has the same words in that span, it has the same symbol there.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from millrace.llm.words import MIX_1, MIX_2, U, mixed

#: More rounds give fewer, longer symbols, and fewer of them decided within a window.
ROUNDS = ("runs", *["pairs"] * 7)


@dataclass
class Symbols:
    """Symbols of many texts end to end; positions count words over all of them."""

    names: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    #: Span of deciding words; it leaves the text where the text's edge decided.
    low: np.ndarray
    high: np.ndarray
    texts: np.ndarray


def words_as_symbols(numbers: np.ndarray, sizes: np.ndarray) -> Symbols:
    at = np.arange(len(numbers))
    return Symbols(numbers, at, at + 1, at, at + 1, np.repeat(np.arange(len(sizes)), sizes))


def recompressed(numbers: np.ndarray, sizes: np.ndarray, rounds: tuple[str, ...] = ROUNDS) -> Symbols:
    """Symbols after all rounds, of texts given by their words' numbers and word counts."""
    symbols = words_as_symbols(numbers, sizes)
    first = np.concatenate([[0], np.cumsum(sizes)])
    # Beyond both edges of a text lies a span that no window of the text can hold.
    edges = first[:-1] - 1, first[1:] + 1
    for number, kind in enumerate(rounds):
        if len(symbols.names) < 2:
            break
        symbols = (_runs if kind == "runs" else _pairs)(symbols, number, edges)
    return symbols


def _neighbours(symbols: Symbols, edges) -> tuple[np.ndarray, ...]:
    """Deciding spans of the symbols before and behind each one, or the text's edge."""
    same = symbols.texts[1:] == symbols.texts[:-1]
    before, behind = edges[0][symbols.texts], edges[1][symbols.texts]
    low_before = before.copy()
    low_before[1:][same] = symbols.low[:-1][same]
    high_before = symbols.high.copy()
    high_before[1:][same] = symbols.high[:-1][same]
    high_behind = behind.copy()
    high_behind[:-1][same] = symbols.high[1:][same]
    low_behind = symbols.low.copy()
    low_behind[:-1][same] = symbols.low[1:][same]
    return low_before, high_before, low_behind, high_behind


def _pairs(symbols: Symbols, number: int, edges) -> Symbols:
    salt = U((number + 1) * int(MIX_2) % (1 << 64))
    left = (mixed(symbols.names + salt) >> U(63)).astype(bool)
    same = symbols.texts[1:] == symbols.texts[:-1]
    joins = np.zeros(len(left), bool)
    joins[:-1] = left[:-1] & ~left[1:] & same
    low_before, high_before, low_behind, high_behind = _neighbours(symbols, edges)
    # A left symbol depends on what follows it, a right one on what precedes it.
    low = np.minimum(symbols.low, np.where(left, low_behind, low_before))
    high = np.maximum(symbols.high, np.where(left, high_behind, high_before))
    second = np.zeros(len(left), bool)
    second[1:] = joins[:-1]
    kept = ~second
    at = np.flatnonzero(joins)
    names, ends = symbols.names.copy(), symbols.ends.copy()
    names[at] = mixed(mixed(names[at] * MIX_1 + U(number)) + symbols.names[at + 1] * MIX_2)
    ends[at] = symbols.ends[at + 1]
    low[at] = np.minimum(symbols.low[at], symbols.low[at + 1])
    high[at] = np.maximum(symbols.high[at], symbols.high[at + 1])
    return Symbols(names[kept], symbols.starts[kept], ends[kept], low[kept], high[kept], symbols.texts[kept])


def _runs(symbols: Symbols, number: int, edges) -> Symbols:
    begins = np.ones(len(symbols.names), bool)
    begins[1:] = (symbols.names[1:] != symbols.names[:-1]) | (symbols.texts[1:] != symbols.texts[:-1])
    at = np.flatnonzero(begins)
    last = np.concatenate([at[1:], [len(begins)]]) - 1
    low_before, _, _, high_behind = _neighbours(symbols, edges)
    length = (last - at + 1).astype(U)
    names = symbols.names[at]
    names = np.where(length > 1, mixed(mixed(names + U(number)) * MIX_1 + length), names)
    # A run's extent is decided by the symbols on both its sides, and so is that of a single symbol.
    low = np.minimum(np.minimum.reduceat(symbols.low, at), low_before[at])
    high = np.maximum(np.maximum.reduceat(symbols.high, at), high_behind[last])
    return Symbols(names, symbols.starts[at], symbols.ends[last], low, high, symbols.texts[at])


def candidate_windows(symbols: Symbols, unique: np.ndarray, sizes: np.ndarray, window: int) -> np.ndarray:
    """Starts of the windows that hold the deciding span of no symbol marked as unique.

    A window that occurs elsewhere shares each symbol whose deciding span it holds, so all
    others are ruled out.
    """
    first = np.concatenate([[0], np.cumsum(sizes)])
    total = int(first[-1])
    ruled = np.zeros(total + 2, np.int64)
    narrow = unique & (symbols.high - symbols.low <= window)
    texts = symbols.texts[narrow]
    begin = np.maximum(symbols.high[narrow] - window, first[:-1][texts])
    end = symbols.low[narrow] + 1
    fits = (begin < end) & (symbols.low[narrow] >= first[:-1][texts]) & (symbols.high[narrow] <= first[1:][texts])
    np.add.at(ruled, begin[fits], 1)
    np.add.at(ruled, end[fits], -1)
    open_starts = np.cumsum(ruled[:total]) == 0
    last_start = np.repeat(first[1:] - window, sizes)
    return np.flatnonzero(open_starts & (np.arange(total) <= last_start))
