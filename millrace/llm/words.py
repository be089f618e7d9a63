"""Words of a text as 64-bit numbers.

A word is a run of bytes other than space and tab to carriage return, which is
what ``bytes.split()`` gives. A word's number is a polynomial of its bytes modulo
2**64, mixed with its length, so the words of many texts are numbered by a few array
operations. Equal words have equal numbers everywhere, and two of n distinct ones share
a number with a chance in the order of n*n/2**65.
"""

from __future__ import annotations

import re
import string
from bisect import bisect_right

import numpy as np

U = np.uint64
MIX_1, MIX_2 = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F)
#: A to Z lowered, for ``bytes.translate``.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

#: The same, and ASCII punctuation as space.
PLAIN = LOWER.translate(bytes(32 if chr(c) in string.punctuation else c for c in range(256)))


class Taken:
    """Stretches that do not overlap, kept in order; a new one is found its place by bisection."""

    def __init__(self, spans: list[tuple[int, int]] = ()):
        self.begins: list[int] = []
        self.ends: list[int] = []
        for begin, end in sorted(spans):
            if self.ends and begin < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.begins.append(begin)
                self.ends.append(end)

    def take(self, begin: int, end: int) -> bool:
        """Take a stretch if none of it is taken yet."""
        if not self.free(begin, end):
            return False
        at = bisect_right(self.ends, begin)
        self.begins.insert(at, begin)
        self.ends.insert(at, end)
        return True

    def free(self, begin: int, end: int) -> bool:
        at = bisect_right(self.ends, begin)
        return at == len(self.begins) or self.begins[at] >= end


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole number (a bijection)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def shingles(numbers: np.ndarray, size: int) -> np.ndarray:
    """Number of each run of ``size`` words, in text order; empty with fewer words."""
    count = len(numbers) - size + 1
    if count <= 0:
        return np.empty(0, U)
    out = np.zeros(count, U)
    for k in range(size):
        out = mixed(out * MIX_1 + numbers[k : k + count])
    return out


def shingle_set(numbers: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingles; fewer words than ``size`` count as one shingle."""
    if 0 < len(numbers) < size:
        return shingles(numbers, len(numbers)) + U(len(numbers))
    return np.unique(shingles(numbers, size))


_SPACE = re.compile(rb"[\x20\x09-\x0d]")
_IS_WORD = np.array([not _SPACE.match(bytes([code])) for code in range(256)])
_CODES = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 64, 256, dtype=U)
_BASE = 0x9D39247E33776D41
#: Bytes numbered at once.
CHUNK = 1 << 20
_powers = {sign: np.ones(1, U) for sign in (1, -1)}


def _powers_of(sign: int, count: int) -> np.ndarray:
    """Powers of the base, or of its inverse."""
    if len(_powers[sign]) < count:
        factors = np.full(count, pow(_BASE, sign, 1 << 64), U)
        factors[0] = 1
        _powers[sign] = np.multiply.accumulate(factors)
    return _powers[sign][:count]


def text_numbers(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of all texts end to end, and the words of each text."""
    joined = b" ".join(texts)
    data = np.frombuffer(joined, np.uint8)
    numbers, starts, at = [np.empty(0, U)], [np.empty(0, np.int64)], 0
    while at < len(data):
        cut = _SPACE.search(joined, at + CHUNK) if at + CHUNK < len(data) else None
        end = cut.start() if cut else len(data)
        part = data[at:end]
        edges = np.diff(_IS_WORD[part].astype(np.int8), prepend=0, append=0)
        begin, stop = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        sums = np.zeros(len(part) + 1, U)
        np.cumsum(_CODES[part] * _powers_of(1, len(part)), out=sums[1:])
        value = (sums[stop] - sums[begin]) * _powers_of(-1, len(part) + 1)[begin]
        numbers.append(mixed(value + (stop - begin).astype(U) * MIX_2))
        starts.append(begin + at)
        at = end
    first = np.cumsum([0, *[len(text) + 1 for text in texts]])
    return np.concatenate(numbers), np.diff(np.searchsorted(np.concatenate(starts), first))


def word_tails(texts: list[bytes], count: int) -> np.ndarray:
    """Number below ``count`` of the last three bytes of each word of all texts end to end."""
    joined = b" ".join(texts)
    data = np.concatenate([np.full(3, 32, np.uint8), np.frombuffer(joined, np.uint8), np.full(1, 32, np.uint8)])
    word = _IS_WORD[data]
    last = np.flatnonzero(word[:-1] & ~word[1:])
    tail = data[last].astype(U)
    whole = np.ones(len(last), bool)
    for k in (1, 2):
        whole &= word[last - k]  # bytes before a short word's start do not count
        tail = tail << U(8) | np.where(whole, data[last - k], 0).astype(U)
    return (mixed(tail) % U(count)).astype(np.int64)


def numbers_by_text(texts: list[bytes]) -> list[np.ndarray]:
    numbers, sizes = text_numbers(texts)
    return np.split(numbers, np.cumsum(sizes)[:-1]) if texts else []
