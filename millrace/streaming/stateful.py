"""Stream jobs whose state needs more than an aggregate: several variables, timers, a state to begin with."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import batched
from math import nan
from operator import itemgetter

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructField, StructType, TimestampNTZType, TimestampType

from millrace.streaming.jobs import DELAY

MICROS = 1_000_000
#: Groups of state that the keys of a stretch are dealt to.
BUCKETS = 1024
#: Rows of a message to the state: Spark does not read one of more than some kilobytes to its end.
MESSAGE_ROWS = 20


class LeftOpen(StatefulProcessor):
    """Rows that open something, until one closes it or their time is up.

    State of a group, which holds several keys: openings that nothing closed so far, and closings that a late
    opening of their key may still need. An opening is due just after its gap; no row of the time before can
    come once the watermark is there. Closings are kept as long as an opening as old can come.

    A call to the state is a message to another process, so a group has one list and, as long as it has
    one, a timer no later than the first moment at which something of it is due. Once the timer fires, all that
    the watermark has passed is worked off, and the next moment gets a timer.
    """

    def __init__(self, gap: int, key: str, ident: str):
        self.gap, self.row = gap, f"key {key}, at bigint, id {ident}, closes boolean"
        self.begun, self.first = None, 0

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getListState("kept", self.row)

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:  # noqa: N802, N803
        if initialState["at"] is None:
            return
        opening = (_one(initialState["key"]), initialState["at"], initialState["id"], False)
        self.kept.appendValue(opening)
        # The rows of a group follow each other; only an earlier moment needs another timer.
        if self.begun != key or self._due(opening) < self.first:
            self.begun, self.first = key, self._due(opening)
            self.handle.registerTimer(self.first)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        before = self._list()
        now = list(before)
        for row in rows:
            if row["opens"]:
                now.append((_one(row["key"]), row["at"], row["id"], False))
            if row["closes"]:
                now.append((_one(row["key"]), row["at"], None, True))
        times: dict = {}
        for k, at in sorted(((r[0], r[1]) for r in now if r[3]), key=itemgetter(1)):
            times.setdefault(k, []).append(at)
        now = [r for r in now if r[3] or not self._closed(r[1], times.get(r[0], []))]
        if now != before:
            self._put(now)
        # The state of before has a timer at its first moment, or earlier.
        if now and not (before and self._wake(before) <= self._wake(now)):
            self.handle.registerTimer(self._wake(now))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        before = self._list()
        after = [r for r in before if self._due(r) > now]
        if len(after) < len(before):
            self._put(after)
        if after:
            self.handle.registerTimer(self._wake(after))
        due = [r for r in before if not r[3] and self._due(r) <= now]
        return iter([Row(key=k, id=ident, at=at) for k, at, ident, _ in due])

    def _closed(self, at: int, times: list[int]) -> bool:
        place = bisect_left(times, at)
        return place < len(times) and times[place] <= at + self.gap

    def _due(self, row: tuple) -> int:
        _, at, _, closes = row
        return _after(at if closes else at + self.gap)

    def _wake(self, rows: list[tuple]) -> int:
        """The first moment at which an opening is due, or the last at which a closing is."""
        opened = min((self._due(r) for r in rows if not r[3]), default=None)
        closed = max((self._due(r) for r in rows if r[3]), default=None)
        return min(moment for moment in (opened, closed) if moment is not None)

    def _list(self) -> list[tuple]:
        return [(_one(k), *rest) for k, *rest in self.kept.get()]

    def _put(self, rows: list[tuple]) -> None:
        self.kept.clear()
        for part in batched(rows, MESSAGE_ROWS):
            self.kept.appendList(list(part))


def _one(key):
    """A key as a grouping has it: one zero, and one that is no number."""
    if isinstance(key, float):
        return nan if key != key else key + 0.0
    return bytes(key) if isinstance(key, bytearray) else key


def _after(micros: int) -> int:
    """The first whole millisecond behind a time."""
    return micros // 1000 + 1


def stream_left_open(
    stream: DataFrame,
    key: str,
    ts: str,
    ident: str,
    opens: Column,
    closes: Column,
    gap_seconds: int,
    known: DataFrame | None = None,
    delay: str = DELAY,
    stretch_seconds: int = 7 * 86_400,
    buckets: int = BUCKETS,
) -> DataFrame:
    """(key, ident, opened_at, left_at) of rows that open something which no row of the key
    closes from then to ``gap_seconds`` later.

    A row comes out once the watermark, of rows that open or close, has passed the end of its
    gap, so order of arrival does not matter; a row as old as the watermark, or older, is too late. ``known`` has columns
    ``key``, ``ts`` and ``ident`` of openings from before the stream; it counts at the first start.
    Keys and identifiers are of any simple type (Spark's timers take no structs) and may be null;
    rows without a time are left out.

    A group of state is a bucket of keys and a stretch of time, so that the history of a busy key is spread over
    tasks. A group costs some milliseconds of Python whatever it holds, and a micro-batch rewrites the open rows of the
    groups it touches: ``buckets`` bounds the one, and more of them keep the other small. It stays as the
    checkpoint began. A closing also goes to the stretch in which its openings may lie. ``stretch_seconds``
    is at least the gap. Needs the state store that ``run.state_settings`` names.
    """
    if stretch_seconds < gap_seconds:
        raise ValueError("a stretch is shorter than the gap")
    gap, micros = gap_seconds * MICROS, F.unix_micros(F.col(ts))

    bucket = F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket")

    def stretch(at: Column) -> Column:
        return F.floor(at / (stretch_seconds * MICROS))

    kind = stream.select(F.col(key).alias("key")).schema["key"].dataType
    # Python gives a time another zone once it has been in the state.
    is_time = isinstance(kind, (TimestampType, TimestampNTZType))
    as_key = F.unix_micros(F.col(key).cast("timestamp")) if is_time else F.col(key).cast(kind)
    rows = (
        stream.filter((opens | closes) & F.col(ts).isNotNull())
        .withWatermark(ts, delay)
        .select(as_key.alias("key"), F.col(ts).alias("_ts"), F.col(ident).alias("id"), micros.alias("at"),
                F.coalesce(opens, F.lit(False)).alias("opens"), F.coalesce(closes, F.lit(False)).alias("closes"))
    )
    own, before = stretch(F.col("at")), stretch(F.col("at") - gap)
    rows = rows.withColumn(
        "stretch", F.explode(F.when(F.col("closes"), F.array_distinct(F.array(own, before))).otherwise(F.array(own)))
    ).withColumn("opens", F.col("opens") & (F.col("stretch") == own))
    types = rows.schema
    out = StructType(
        [StructField("key", types["key"].dataType), StructField("id", types["id"].dataType)]
    ).add("at", "long")
    initial = None
    if known is not None:
        old = known.filter(F.col(ts).isNotNull()).select(
            as_key.alias("key"), F.col(ident).alias("id"), micros.alias("at")
        )
        initial = old.select("*", bucket, own.alias("stretch")).groupBy("bucket", "stretch")
    found = rows.select("*", bucket).groupBy("bucket", "stretch").transformWithState(
        LeftOpen(gap, *(types[c].dataType.simpleString() for c in ("key", "id"))), out, "Append", "EventTime", initial
    )
    return found.select(
        (F.timestamp_micros("key").cast(kind) if is_time else F.col("key")).alias(key),
        F.col("id").alias(ident),
        F.timestamp_micros("at").alias("opened_at"),
        F.timestamp_micros(F.col("at") + gap).alias("left_at"),
    )
