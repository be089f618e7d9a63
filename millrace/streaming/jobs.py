"""Transformations of event streams. All take and return streaming DataFrames."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions.money import total
from millrace.functions.parsing import checked_json, once, readable

DELAY = "1 hour"


def event_time(stream: DataFrame, ts: str = "ts") -> DataFrame:
    """``ts`` as an instant, which a watermark needs."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp"))


def stream_decode(stream: DataFrame, col: str, schema: StructType) -> DataFrame:
    """Typed columns from a JSON payload, and ``rejected``: whether it does not parse.

    One stream for both kinds of rows, parsed once; several sinks may share it.
    """
    rows = once(stream, checked_json(col, schema), "_json")
    bad = ~readable("_json")
    fields = [F.when(~bad, F.col(f"_json.{n}")).alias(n) for n in schema.names]
    return rows.select(*stream.columns, *fields, bad.alias("rejected"))


def stream_dedupe(
    stream: DataFrame, keys: list[str], ts: str = "ts", delay: str = DELAY
) -> DataFrame:
    """First arrival per key; duplicates are recognised within the delay.

    One state store, which the watermark empties.
    """
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def stream_tumbling(
    stream: DataFrame,
    width: str,
    ts: str = "ts",
    delay: str = DELAY,
    value: str = "value",
    scale: int | None = None,
) -> DataFrame:
    """Count and total per closed window; meant for append mode. ``scale`` is 2 for money."""
    return _windowed(stream.withWatermark(ts, delay), F.window(ts, width), value, scale)


def with_dropped(
    counted: DataFrame, arrived: DataFrame, width: str, ts: str = "ts", delay: str = DELAY
) -> DataFrame:
    """Per closed window: rows counted by the stream, and rows that arrived too late for it.

    A window is closed once the newest arrival lies ``delay`` past its end. One whose rows all
    came too late was never counted and is reported as well. The progress of a query reports
    drops after partial aggregation; comparing with all rows that arrived gives the exact number.
    """
    newest = arrived.agg(F.max(ts)).first()[0]
    window = F.window(ts, width).alias("_w")
    closed = F.col("_w.end") <= F.lit(newest) - F.expr(f"interval {delay}")
    all_rows = (
        arrived.groupBy(window)
        .agg(F.count(F.lit(1)).alias("_arrived"))
        .filter(closed)
        .select(F.col("_w.start").alias("_start"), F.col("_w.end").alias("_end"), "_arrived")
    )
    n_counted = F.coalesce("n_rows", F.lit(0))
    return all_rows.join(counted, F.col("_start") == F.col("window_start"), "left").select(
        F.col("_start").alias("window_start"),
        F.col("_end").alias("window_end"),
        n_counted.alias("n_counted"),
        (F.col("_arrived") - n_counted).alias("n_dropped"),
    )


def stream_sliding(
    stream: DataFrame,
    width: str,
    slide: str,
    ts: str = "ts",
    delay: str = DELAY,
    value: str = "value",
    scale: int | None = None,
) -> DataFrame:
    """Count and total per overlapping window; meant for update mode. ``scale`` is 2 for money.

    The watermark removes closed windows from the state.
    """
    return _windowed(stream.withWatermark(ts, delay), F.window(ts, width, slide), value, scale)


def newest_windows(updates: DataFrame) -> DataFrame:
    """The last of all updates of each window, which is the one with most rows."""
    return updates.groupBy("window_start", "window_end").agg(
        F.max("n_rows").alias("n_rows"), F.max_by("total", "n_rows").alias("total")
    )


def _windowed(stream: DataFrame, window: Column, value: str, scale: int | None) -> DataFrame:
    return (
        stream.groupBy(window.alias("_w"))
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            total(value, scale=scale).cast("double").alias("total"),
        )
        .select(
            F.col("_w.start").alias("window_start"),
            F.col("_w.end").alias("window_end"),
            "n_rows",
            "total",
        )
    )


def stream_session(
    stream: DataFrame, key: str, gap: str, ts: str = "ts", delay: str = DELAY
) -> DataFrame:
    """Sessions per key that end ``gap`` after their last row; meant for append mode."""
    return (
        stream.withWatermark(ts, delay)
        .groupBy(key, F.session_window(ts, gap).alias("_w"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(
            key,
            F.col("_w.start").alias("session_start"),
            F.col("_w.end").alias("session_end"),
            "n_rows",
        )
    )


def stream_enrich(stream: DataFrame, dim: DataFrame, on: dict[str, str]) -> DataFrame:
    """Left join to a static table that is unique on its key; unmatched rows stay."""
    return stream.join(dim, _equal(on), "left").drop(*on.values())


def _equal(on: dict[str, str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(x) == F.col(y) for x, y in on.items()])


def enrich_each_batch(
    dim: DataFrame, on: dict[str, str], write: Callable[[DataFrame, int], None]
) -> Callable[[DataFrame, int], None]:
    """``stream_enrich`` for every micro-batch, as a batch join.

    Adaptive execution then picks the join by the sizes of this batch and splits a
    key that is frequent in it, which a streaming plan cannot do.
    """

    def enrich(batch: DataFrame, batch_id: int) -> None:
        write(batch.join(dim, _equal(on), "left").drop(*on.values()), batch_id)

    return enrich


def stream_interval_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_ts: str,
    right_ts: str,
    max_gap_seconds: int,
    delay: str = DELAY,
) -> DataFrame:
    """Pairs of one key with ``left_ts <= right_ts <= left_ts + gap``.

    Both sides are watermarked, so state stays bounded. Rows meet by key and
    stretch of time: the left row in its own stretch and the next, where every
    partner must lie. A busy key is thereby spread over many tasks.
    """
    stretch = lambda c: F.floor(F.unix_seconds(c) / max_gap_seconds)
    spread = left.withWatermark(left_ts, delay).withColumn(
        "_stretch",
        F.explode(F.array(stretch(F.col(left_ts)), stretch(F.col(left_ts)) + 1)),
    )
    placed = (
        right.withWatermark(right_ts, delay)
        .withColumn("_right_stretch", stretch(F.col(right_ts)))
        .withColumnRenamed(key, "_right_key")
    )
    latest = F.col(left_ts) + F.expr(f"interval {max_gap_seconds} seconds")
    pairs = spread.join(
        placed,
        (F.col(key) == F.col("_right_key"))
        & (F.col("_stretch") == F.col("_right_stretch"))
        & (F.col(right_ts) >= F.col(left_ts))
        & (F.col(right_ts) <= latest),
    )
    return pairs.drop("_stretch", "_right_stretch", "_right_key")


def stream_keyed_state(stream: DataFrame, key: str, ts: str = "ts") -> DataFrame:
    """Running row count and latest time per key; meant for update mode.

    A built-in aggregate: the state holds two values per key, and rows of a busy key are added
    up by the tasks that read them. Keys of any type; a null key is a key, a null time no time.
    """
    return stream.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_rows"), F.max(ts).alias(f"last_{ts}")
    )


def latest_state(updates: DataFrame, key: str, ts: str = "ts") -> DataFrame:
    """The last of all updates per key: counts and latest times only grow."""
    return updates.groupBy(key).agg(
        F.max("n_rows").alias("n_rows"), F.max(f"last_{ts}").alias(f"last_{ts}")
    )
