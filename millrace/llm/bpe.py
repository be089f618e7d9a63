"""Byte-level BPE encoding and decoding with a rank queue.

A text is cut by the pre-token pattern and every pre-token is merged on its own.
Pairs wait in buckets, one per merge rank. Which buckets hold something is kept in a
bitmap of two levels, so that two find-first-set steps give the lowest rank; within a
bucket the leftmost position comes first. Positions form a linked list. A merge does not
search the queue for the pairs it destroys: an entry whose pair no longer has the
bucket's rank is stale and skipped. n bytes therefore take O(n log n) steps, however long
a pre-token is. Pre-tokens do not touch each other, so those of many texts share a queue.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Callable, Iterator
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrow import extended, slices, without

#: Entries of the vocabulary that are broadcast at most.
MAX_VOCABULARY = 2_000_000
#: Pre-tokens whose ids a worker remembers, and their characters, in each of two generations.
REMEMBERED, REMEMBERED_BYTES = 250_000, 32 << 20
#: Pre-tokens that share one queue.
QUEUED = 1 << 15
#: Positions of a bucket from which array operations pay.
MANY = 96
_BYTES = [bytes([code]) for code in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank, from a file of base64 token and rank per line."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    if len(pairs) > MAX_VOCABULARY:
        raise ValueError(f"{len(pairs)} tokens; at most {MAX_VOCABULARY} are broadcast")
    tokens = {int(rank): base64.b64decode(token) for token, rank in pairs}
    return [tokens.get(rank, b"") for rank in range(max(tokens) + 1)]


class _Queue:
    """Linked positions of the bytes of many pre-tokens, and those that wait, by rank.

    ``part`` is the token that begins at a position, ``rank_at`` the rank of the pair that it
    begins (-1: none), ``after`` and ``before`` link positions. Each is an array that single
    steps index and a numpy view (``v_``) of the same memory.
    """

    def __init__(self, bpe: Bpe, data: np.ndarray, ends: np.ndarray):
        self.bpe, size = bpe, len(data)
        part = bpe.of_byte[data]
        if (part < 0).any():
            raise ValueError("the vocabulary lacks a byte of the text")
        first_ranks = np.append(bpe.ranks_of(part[:-1], part[1:]), np.int32(-1)).astype(np.int32)
        first_ranks[ends - 1] = -1
        after = np.arange(1, size + 1, dtype=np.int32)
        before = np.arange(-1, size - 1, dtype=np.int32)
        after[ends - 1] = -1
        before[np.append(0, ends[:-1])] = -1
        self.part, self.v_part = _shared(part)
        self.rank_at, self.v_rank_at = _shared(first_ranks)
        self.after, self.v_after = _shared(after)
        self.before, self.v_before = _shared(before)
        self.alive = np.ones(size, bool)
        self.buckets: dict[int, list[int]] = {}
        self.words: dict[int, int] = {}
        self.summary = 0
        waiting = np.flatnonzero(first_ranks >= 0)
        self.push_all(waiting, first_ranks[waiting])

    def lowest(self) -> int:
        """The lowest rank that waits, by two find-first-set steps; its bit is cleared."""
        word = (self.summary & -self.summary).bit_length() - 1
        low = self.words[word] & -self.words[word]
        self.words[word] ^= low
        if not self.words[word]:
            self.summary ^= 1 << word
        return (word << 8) + low.bit_length() - 1

    def push(self, rank: int, positions: list[int]) -> None:
        entries = self.buckets.get(rank)
        if entries is not None:
            entries.extend(positions)
            return
        self.buckets[rank] = positions
        word = rank >> 8
        self.words[word] = self.words.get(word, 0) | 1 << (rank & 255)
        self.summary |= 1 << word

    def push_all(self, positions: np.ndarray, ranks: np.ndarray) -> None:
        order = np.argsort(ranks, kind="stable")
        positions, ranks = positions[order].tolist(), ranks[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        at = 0
        for end in [*cuts.tolist(), len(positions)]:
            if end > at:
                self.push(int(ranks[at]), positions[at:end])
            at = end

    def merge_all(self, rank: int, bucket: list[int]) -> bool:
        """Merge all pairs of a bucket at once; False, and nothing done, if a lower rank could come up."""
        part, rank_at, after, before = self.v_part, self.v_rank_at, self.v_after, self.v_before
        at = np.array(bucket, np.int32)
        at = at[rank_at[at] == rank]  # others are stale
        if not len(at):
            return True
        at.sort()
        right = after[at]
        shares = right[:-1] == at[1:]
        if shares.any():
            # Pairs that share a token, as in "aaa": of each run every second one, from the left.
            place = np.arange(len(at))
            begins = np.append(True, ~shares)
            taken = (place - np.maximum.accumulate(np.where(begins, place, 0))) & 1 == 0
            at, right = at[taken], right[taken]
        following, previous = after[right], before[at]
        has_right, touches = following >= 0, np.append(False, following[:-1] == at[1:])
        has_left = (previous >= 0) & ~touches
        follows = following[has_right]
        precedes, begun = previous[has_left], at[has_right]
        token = np.int32(rank)
        right_ranks = self.bpe.ranks_of(np.full(len(follows), token), part[follows])
        left_ranks = self.bpe.ranks_of(part[precedes], np.full(len(precedes), token))
        twice = self.bpe.joined.get(rank << 32 | rank, -1)
        lowest = min((r[r >= 0].min(initial=rank) for r in (right_ranks, left_ranks)), default=rank)
        if lowest < rank or (0 <= twice < rank and touches.any()):
            return False
        part[at] = rank
        self.alive[right] = False
        rank_at[right] = -1
        rank_at[at] = -1
        after[at] = following
        before[follows] = begun
        # The next token may have been merged as well.
        right_ranks[np.append(touches[1:], False)[has_right]] = twice
        rank_at[begun] = right_ranks
        rank_at[precedes] = left_ranks
        positions, ranks = np.concatenate([begun, precedes]), np.concatenate([right_ranks, left_ranks])
        waits = ranks >= 0
        if waits.any():
            self.push_all(positions[waits], ranks[waits])
        return True

    def merge_each(self, rank: int, bucket: list[int]) -> None:
        """Merge the pairs of a bucket from the left; the rest waits once a lower rank comes up."""
        get, part, rank_at, after, before = self.bpe.joined.get, self.part, self.rank_at, self.after, self.before
        buckets, words, alive = self.buckets, self.words, self.alive
        bucket.sort()  # entries came in a few ascending stretches
        least, high = rank, rank << 32
        for done, at in enumerate(bucket):
            if rank_at[at] != rank:
                continue
            right = after[at]
            part[at] = rank
            alive[right] = False
            rank_at[right] = rank_at[at] = -1
            following, previous = after[right], before[at]
            after[at] = following
            for left, pair in (
                (at, high | part[following] if following >= 0 else -1),
                (previous, part[previous] << 32 | rank if previous >= 0 else -1),
            ):
                if pair < 0:
                    continue
                if left == at:
                    before[following] = at
                new = rank_at[left] = get(pair, -1)
                if new < 0:
                    continue
                entries = buckets.get(new)
                if entries is not None:
                    entries.append(left)
                    continue
                buckets[new] = [left]
                word = new >> 8
                words[word] = words.get(word, 0) | 1 << (new & 255)
                self.summary |= 1 << word
                if new < least:
                    least = new
            if least < rank:
                if rest := bucket[done + 1 :]:
                    self.push(rank, rest)
                return


def _shared(values: np.ndarray) -> tuple[array, np.ndarray]:
    """The values as an array of Python's, and a view of it."""
    own = array("i", values.astype(np.int32).tobytes())
    return own, np.frombuffer(own, np.int32)


class Bpe:
    """Encoder and decoder of one worker."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens = tokens
        self.ranks = {token: rank for rank, token in enumerate(tokens) if token}
        self.of_byte = np.array([self.ranks.get(one, -1) for one in _BYTES], np.int32)
        #: Rank of two tokens that make one, by both their ranks; as a dictionary, and sorted.
        self.joined = {
            left << 32 | right: rank
            for token, rank in self.ranks.items()
            for cut in range(1, len(token))
            if (left := self.ranks.get(token[:cut])) is not None
            and (right := self.ranks.get(token[cut:])) is not None
        }
        pairs = np.fromiter(self.joined, np.int64, len(self.joined))
        order = np.argsort(pairs)
        self.pairs = np.append(pairs[order], np.int64(-1))
        self.pair_ranks = np.append(np.fromiter(self.joined.values(), np.int32, len(order))[order], np.int32(-1))
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.sizes = np.array([len(token) for token in tokens])
        self.firsts = np.cumsum(self.sizes) - self.sizes
        self.pieces = regex.compile(pattern).findall
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.size = 0

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of tokens, -1 where they make none."""
        wanted = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.pairs[:-1], wanted)
        return np.where(self.pairs[at] == wanted, self.pair_ranks[at], np.int32(-1))

    def merged(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each pre-token."""
        ids, ends = self.queued(pieces)
        return [part.tolist() for part in np.split(ids, ends[:-1])]

    def queued(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pre-tokens end to end, and where each one's ids end.

        All wait in one queue, and no pair crosses two. A bucket of many positions is
        merged by array operations where no merge of it makes a pair of lower rank; else its
        positions are merged one by one, from the left, until a lower rank comes up.
        """
        data = np.frombuffer(b"".join(pieces), np.uint8)
        ends = np.cumsum([len(piece) for piece in pieces])
        queue = _Queue(self, data, ends)
        while queue.summary:
            rank = queue.lowest()
            bucket = queue.buckets.pop(rank)
            if len(bucket) < MANY or not queue.merge_all(rank, bucket):
                queue.merge_each(rank, bucket)
        kept = np.concatenate([[0], np.cumsum(queue.alive)])[ends]
        return queue.v_part[queue.alive], kept

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as 32-bit integers; what pre-tokens gave is remembered."""
        pieces = [self.pieces(text) for text in texts]
        if len(self.recent) > REMEMBERED or self.size > REMEMBERED_BYTES:
            self.older, self.recent, self.size = self.recent, {}, 0
        recent, older = self.recent, self.older
        new = set(filterfalse(recent.__contains__, chain.from_iterable(pieces)))
        queued = []
        for piece in new:
            self.size += len(piece)
            ids = older.get(piece)
            if ids is not None:
                recent[piece] = ids
            else:
                coded = piece.encode()
                whole = self.ranks.get(coded)
                if whole is None:
                    queued.append((piece, coded))
                else:
                    recent[piece] = np.int32(whole).tobytes()
        for at in range(0, len(queued), QUEUED):
            names, coded = zip(*queued[at : at + QUEUED], strict=True)
            ids, ends = self.queued(list(coded))
            packed, begin = ids.tobytes(), 0
            for piece, end in zip(names, (ends * 4).tolist(), strict=True):
                recent[piece] = packed[begin:end]
                begin = end
        return [b"".join(map(recent.__getitem__, of_text)) for of_text in pieces]

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the tokens end to end, and where each row's bytes end; ``ends`` cut the ids into rows."""
        sizes = self.sizes[ids]
        stops = np.cumsum(sizes)
        total = int(stops[-1]) if len(stops) else 0
        # Each byte's place in the vocabulary: its token's first byte, and how far it is from there.
        at = np.repeat(self.firsts[ids] - (stops - sizes), sizes) + np.arange(total)
        return self.flat[at], np.concatenate([[0], stops])[ends]


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add array<int> column ``ids``: the tokens of the whole text.

    A null or empty text has no tokens. Special tokens are not known: their strings
    are ordinary text. Rows, ties and repeated rows stay as they are; an existing
    column named like the new one is replaced. The vocabulary (bounded by
    ``MAX_VOCABULARY``) is read on the driver and broadcast.
    """
    return _mapped(df, path, pattern, text, ids, None)


def decode(df: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add binary column ``decoded``: the bytes of ``ids``; null ids count as empty.

    Bytes and not a string, since a part of the ids may end inside a character.
    """
    return _mapped(df, path, "", None, ids, decoded)


def round_trip(
    df: DataFrame,
    path: str,
    pattern: str,
    text: str = "text",
    ids: str = "ids",
    decoded: str = "decoded",
) -> DataFrame:
    """``decode(encode(df))`` in one pass over the rows."""
    return _mapped(df, path, pattern, text, ids, decoded)


def _mapped(
    df: DataFrame, path: str, pattern: str, text: str | None, ids: str, decoded: str | None
) -> DataFrame:
    added = {ids: "array<int>"} if text else {}
    added |= {decoded: "binary"} if decoded else {}
    kept = without(df, *added)
    schema = extended(kept, ", ".join(f"`{name}` {kind}" for name, kind in added.items()))
    tokens = read_ranks(path)
    vocabulary = df.sparkSession.sparkContext.broadcast(tokens)
    digest = xxhash.xxh3_64_hexdigest(b"\n".join(tokens))
    run = _task(vocabulary, digest, pattern, text, ids, decoded)
    return kept.mapInArrow(run, schema)


_coders: dict[tuple[str, str], Bpe] = {}


def _coder(vocabulary, digest: str, pattern: str) -> Bpe:
    """The coder of this worker process, kept with what it remembers from task to task."""
    if (digest, pattern) not in _coders:
        _coders.clear()
        _coders[digest, pattern] = Bpe(vocabulary.value, pattern)
    return _coders[digest, pattern]


def _task(
    vocabulary, digest: str, pattern: str, text: str | None, ids: str, decoded: str | None
) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _coder(vocabulary, digest, pattern)
        for batch in slices(batches, text):
            if text:
                packed = bpe.encode([t or "" for t in batch.column(text).to_pylist()])
                values = np.frombuffer(b"".join(packed), np.int32)
                ends = np.cumsum([len(p) >> 2 for p in packed])
                column = pa.ListArray.from_arrays(np.append(0, ends).astype(np.int32), values)
                batch = batch.append_column(ids, column)
            else:
                column = batch.column(ids)
                values = np.asarray(column.flatten())
                ends = np.cumsum(pc.fill_null(column.value_lengths(), 0))
            if decoded:
                data, stops = bpe.decode(values, ends)
                stops = np.append(0, stops).astype(np.int32)
                buffers = [None, pa.py_buffer(stops), pa.py_buffer(data)]
                batch = batch.append_column(decoded, pa.Array.from_buffers(pa.binary(), len(ends), buffers))
            yield batch

    return run


def digests(df: DataFrame, ids: str = "ids", decoded: str = "decoded") -> list:
    """Contract columns: token count, and hex digests of the ids and of the decoded bytes."""
    return [
        F.size(ids).cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col(ids).cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col(decoded), 256).alias("decoded_sha256"),
    ]
