"""Openings that nothing closes: timers, restarts, late rows, keys of any type, a state to begin with."""

from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.session import scratch_path
from millrace.streaming import run, stateful

SCHEMA = "who string, ts timestamp, id int, kind string"
START = datetime(2024, 1, 10, 23, tzinfo=UTC)


def at(minutes):
    return START + timedelta(minutes=minutes)


class Feed:
    def __init__(self, spark, key="who", known=None, **options):
        self.spark, self.key, self.known, self.options = spark, key, known, options
        self.landing, self.out, self.checkpoint = (scratch_path(spark, f"left-{k}") for k in "abc")
        self.sent = 0

    def run(self, *rows):
        rows = [(who, None if t is None else at(t), i, kind) for who, t, i, kind in rows]
        df = self.spark.createDataFrame(rows, SCHEMA).withColumn("day", F.to_date(F.lit("2024-01-01")) + F.ascii("who"))
        df.coalesce(1).write.mode("append").parquet(self.landing)
        stream = self.spark.readStream.schema(df.schema).parquet(self.landing)
        is_a = lambda kind: F.col("kind") == kind
        found = stateful.stream_left_open(
            stream, self.key, "ts", "id", is_a("open"), is_a("close"), 3600, self.known, **self.options
        )
        query = run.append_to(found, self.out, self.checkpoint)
        stored = self.spark.read.schema(found.schema).parquet(self.out).collect()
        assert all(r.left_at - r.opened_at == timedelta(hours=1) for r in stored)
        return sorted((r.id for r in stored), key=repr), query


def test_timers_over_restarts_and_rows_out_of_order(spark):
    feed = Feed(spark, stretch_seconds=3600)  # midnight lies between two stretches
    first = [
        ("a", 50, 1, "open"), ("a", 110, 2, "close"),  # closed exactly an hour later
        ("b", 50, 3, "open"), ("b", 111, 4, "close"),  # too late
        (None, 10, 5, "open"), (None, 10, 6, "close"), (None, 20, 7, "open"),
        ("c", 55, 8, "open"), ("c", None, 9, "close"), ("c", 60, 10, "other"), ("c", 56, None, "open"),
    ]
    assert feed.run(*first)[0] == []  # the watermark is at minute 51, none is due
    # A closing that comes before its opening is remembered; watermark 165 - 60.
    assert feed.run(("d", 130, 11, "close"), ("d", 165, 12, "open"))[0] == [7]
    assert feed.run(("d", 120, 13, "open"), ("c", 106, 14, "open"), ("a", 100, 15, "open"))[0] == [7]
    found, query = feed.run(("x", 400, 16, "other"), ("x", 400, 17, "close"))
    # 15 was as old as the watermark; the others are due, the state holds what may still come.
    assert found == sorted([3, 7, 8, 12, 14, None], key=repr)
    assert feed.run(("x", 600, 18, "close"))[0] == found
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 6


@pytest.mark.parametrize("key", ["who", "day"])
def test_openings_from_before_the_stream(spark, key):
    known = spark.createDataFrame(
        [("a", at(0), -1, ""), ("b", at(10), -2, ""), (None, at(10), -3, ""), ("a", None, -4, "")], SCHEMA
    ).withColumn("day", F.to_date(F.lit("2024-01-01")) + F.ascii("who"))
    feed = Feed(spark, key, known, stretch_seconds=7200)
    assert feed.run(("a", 40, 1, "close"), ("b", 80, 2, "open"))[0] == []
    assert feed.run(("b", 300, 3, "close"))[0] == [-2, -3, 2]
    # They count once, not at every start.
    assert feed.run(("b", 500, 4, "close"))[0] == [-2, -3, 2]


@pytest.mark.parametrize("key", ["ts2", "CAST(n AS decimal(9, 2))", "CAST(who AS binary)", "z"])
def test_keys_of_a_group_are_told_apart(spark, key):
    """Each key's openings are closed by its own closings, over two runs; no number and both zeros are one key each."""
    z = "CASE n WHEN 1 THEN CAST('NaN' AS double) WHEN 2 THEN %s0D END"

    def of(df, sign=""):
        df = df.withColumn("n", F.ascii("who") - 96).withColumn("ts2", F.timestamp_seconds(F.col("n") * 1000))
        return df.withColumn("z", F.expr(z % sign)).withColumn("k", F.expr(key))

    landing, out, checkpoint = (scratch_path(spark, f"told-{x}") for x in "abc")
    known = of(spark.createDataFrame([("a", at(0), -1, ""), ("b", at(5), -2, ""), (None, at(5), -3, "")], SCHEMA))
    for sign, rows in (
        ("", [("a", at(10), 1, "open"), ("b", at(11), 2, "open"), (None, at(12), 3, "open"), ("b", at(13), 4, "close")]),
        ("-", [("a", at(50), 5, "close"), ("b", at(50), 6, "open")]),
        ("-", [("b", at(400), 7, "close")]),
    ):
        of(spark.createDataFrame(rows, SCHEMA), sign).coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(known.schema).parquet(landing)
        found = stateful.stream_left_open(
            stream, "k", "ts", "id", F.col("kind") == "open", F.col("kind") == "close", 3600, known, buckets=1
        )
        run.append_to(found, out, checkpoint)
    rows = spark.read.schema(found.schema).parquet(out).collect()
    assert sorted(r.id for r in rows) == [-3, 3, 6]
    (expected,) = of(spark.createDataFrame([("b", None, 0, "")], SCHEMA)).select("k").first()
    assert {r.id: r.k for r in rows} == {-3: None, 3: None, 6: expected}


def test_a_group_has_one_timer_and_keys_share_groups(spark):
    """Neither the timers nor the groups grow with the keys and their openings."""
    feed = Feed(spark, known=None, stretch_seconds=7200, buckets=4)
    rows = [(f"k{k}", 10 + k % 20 + i, 100 * k + i, "open") for k in range(200) for i in range(5)]
    found, query = feed.run(*rows, ("x", 400, -1, "close"))
    assert found == sorted((r[2] for r in rows), key=repr)
    state = [p["stateOperators"][0]["customMetrics"] for p in query.recentProgress if p["stateOperators"]]
    assert 0 < sum(m["numRegisteredTimers"] for m in state) <= 2 * 4 * 3


def test_a_stretch_holds_a_gap(spark):
    with pytest.raises(ValueError, match="shorter"):
        Feed(spark, stretch_seconds=10).run(("a", 0, 1, "open"))
