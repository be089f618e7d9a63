"""Streams over several batches, with restarts, late rows, duplicates and gaps."""

import os
from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from millrace.plans import streams
from millrace.session import scratch_path
from millrace.sources import tables
from millrace.streaming import jobs, run
from oracle import mismatch

SCHEMA = "id bigint, ts timestamp_ntz, user bigint, value double, props string"
START = datetime(2024, 1, 1)


def at(minutes):
    return START + timedelta(minutes=minutes)


class Feed:
    """A folder that receives one delivery at a time; each run resumes the same query."""

    def __init__(self, spark):
        self.spark = spark
        self.landing = scratch_path(spark, "feed")
        self.out = scratch_path(spark, "feed-out")
        self.checkpoint = scratch_path(spark, "feed-checkpoint")

    def deliver(self, rows):
        full = [(i, t, user, 1.0, "") for i, t, user in rows]
        self.spark.createDataFrame(full, SCHEMA).coalesce(1).write.mode("append").parquet(
            self.landing
        )

    def stream(self):
        return jobs.event_time(self.spark.readStream.schema(SCHEMA).parquet(self.landing))

    def append(self, transform):
        result = transform(self.stream())
        run.append_to(result, self.out, self.checkpoint)
        return self.spark.read.schema(result.schema).parquet(self.out)


def test_decode_sends_broken_payloads_to_rejects(spark):
    landing = scratch_path(spark, "decode")
    payloads = ['{"k": 1}', '{"k": "one"}', '{"k"', None, '{"j": 2}']
    spark.createDataFrame(list(enumerate(payloads)), "id int, props string").write.parquet(landing)
    stream = spark.readStream.schema("id int, props string").parquet(landing)
    schema = StructType([StructField("k", IntegerType())])
    out = run.append_and_read(jobs.stream_decode(stream, "props", schema), "decoded").collect()
    assert sorted((r.id, r.k) for r in out if not r.rejected) == [(0, 1), (4, None)]
    assert sorted((r.id, r.k) for r in out if r.rejected) == [(1, None), (2, None), (3, None)]


def test_payloads_are_parsed_once(spark, capsys):
    rows = spark.createDataFrame([('{"k": 1}',), ("{",)], "props string")
    decoded = jobs.stream_decode(rows, "props", StructType([StructField("k", IntegerType())]))
    decoded.filter("not rejected").select("k").explain()
    assert capsys.readouterr().out.count("from_json") == 1


def test_dedupe_across_batches_and_restart(spark):
    feed = Feed(spark)
    first = [(i, at(i), 0) for i in range(20)]
    dedupe = lambda s: jobs.stream_dedupe(s, ["id"])
    feed.deliver(first + first[:5])
    assert feed.append(dedupe).count() == 20
    feed.deliver(first[15:] + [(99, at(25), 0)] * 50)
    out = feed.append(dedupe)
    assert sorted(r.id for r in out.collect()) == [*range(20), 99]
    assert feed.append(dedupe).count() == 21


def test_tumbling_keeps_open_windows_for_later(spark):
    feed = Feed(spark)
    tumbling = lambda s: jobs.stream_tumbling(s, "1 hour", delay="10 minutes")
    feed.deliver([(1, at(5), 0), (2, at(65), 0)])
    assert feed.append(tumbling).count() == 0
    feed.deliver([(3, at(50), 0), (4, at(70), 0)])
    rows = feed.append(tumbling).collect()
    assert [(r.window_start, r.n_rows, r.total) for r in rows] == [(at(0), 2, 2.0)]
    feed.deliver([(5, at(300), 0)])
    assert sorted(r.n_rows for r in feed.append(tumbling).collect()) == [2, 2]


def test_late_rows_are_counted_as_dropped(spark):
    feed = Feed(spark)
    tumbling = lambda s: jobs.stream_tumbling(s, "1 hour", delay="1 hour")
    feed.deliver([(1, at(10), 0), (2, at(250), 0)])
    feed.append(tumbling)
    # The watermark stands at minute 190: hours 0 to 2 are closed, hour 3 is open.
    # Minute 70 is the only row of its hour, which nobody has counted.
    feed.deliver([(3, at(20), 0), (4, at(30), 0), (7, at(70), 0), (5, at(185), 0), (6, at(400), 0)])
    counted = feed.append(tumbling)
    counted = counted.withColumns(
        {n: F.col(n).cast("timestamp_ntz") for n in ("window_start", "window_end")}
    )
    arrived = spark.read.schema(SCHEMA).parquet(feed.landing)
    out = jobs.with_dropped(counted, arrived, "1 hour").orderBy("window_start")
    assert [(r.window_start, r.n_counted, r.n_dropped) for r in out.collect()] == [
        (at(0), 1, 2), (at(60), 0, 1), (at(180), 1, 0), (at(240), 1, 0),
    ]


def test_session_keeps_a_gap_equal_to_the_limit(spark):
    feed = Feed(spark)
    sessions = lambda s: jobs.stream_session(s, "user", "30 minutes", delay="1 minute")
    feed.deliver([(1, at(0), 7), (2, at(30), 7), (3, at(10), 8)])
    feed.append(sessions)
    feed.deliver([(4, at(60), 7), (5, at(41), 8), (6, at(500), 9)])
    out = feed.append(sessions).select(
        "user", F.col("session_start").cast("timestamp_ntz").alias("s"),
        F.col("session_end").cast("timestamp_ntz").alias("e"), "n_rows",
    )
    assert sorted(map(tuple, out.collect())) == [
        (7, at(0), at(90), 3), (8, at(10), at(40), 1), (8, at(41), at(71), 1),
    ]


def test_enrich_keeps_unmatched_rows(spark):
    feed = Feed(spark)
    feed.deliver([(1, at(0), 7), (2, at(1), 8)])
    dim = spark.createDataFrame([(7, "seven")], "user_id bigint, name string")
    out = feed.append(lambda s: jobs.stream_enrich(s, dim, {"user": "user_id"}))
    assert sorted((r.user, r.name) for r in out.collect()) == [(7, "seven"), (8, None)]


def test_enrich_each_batch(spark):
    feed = Feed(spark)
    dim = spark.createDataFrame([(7, "seven"), (9, "nine")], "user_id bigint, name string")
    write = run.replace_batches(feed.out)
    enrich = jobs.enrich_each_batch(dim, {"user": "user_id"}, write)
    for rows in ([(i, at(i), 7) for i in range(5)] + [(8, at(8), 8)], [(9, at(9), 9)]):
        feed.deliver(rows)
        events = feed.stream().select("id", "user")
        run.each_batch(events, "append", enrich, feed.checkpoint)
    out = spark.read.parquet(f"{feed.out}/batch=*")
    assert sorted((r.id, r.name) for r in out.collect()) == [
        *[(i, "seven") for i in range(5)], (8, None), (9, "nine"),
    ]


def test_interval_join_across_batches(spark):
    feed = Feed(spark)

    def pairs(stream):
        left = stream.filter("id < 100").select(
            "user", F.col("id").alias("a"), F.col("ts").alias("a_ts")
        )
        right = stream.filter("id >= 100").select(
            "user", F.col("id").alias("b"), F.col("ts").alias("b_ts")
        )
        return jobs.stream_interval_join(left, right, "user", "a_ts", "b_ts", 3600)

    feed.deliver([(1, at(0), 7), (2, at(59), 7), (3, at(0), 8), (100, at(30), 7)])
    feed.append(pairs)
    feed.deliver([(101, at(60), 7), (102, at(61), 8), (103, at(119), 7), (104, at(0), 7)])
    out = feed.append(pairs)
    assert sorted((r.user, r.a, r.b) for r in out.collect()) == [
        (7, 1, 100), (7, 1, 101), (7, 1, 104), (7, 2, 101), (7, 2, 103),
    ]


def test_interval_join_drops_old_state(spark):
    feed = Feed(spark)

    def pairs(stream):
        left = stream.select("user", F.col("id").alias("a"), F.col("ts").alias("a_ts"))
        right = stream.select("user", F.col("id").alias("b"), F.col("ts").alias("b_ts"))
        return jobs.stream_interval_join(left, right, "user", "a_ts", "b_ts", 60, "1 minute")

    left_over = []
    for n in range(3):
        feed.deliver([(1000 * n + i, at(1000 * n + i), i) for i in range(50)])
        result = pairs(feed.stream())
        query = run.append_to(result, feed.out, feed.checkpoint)
        left_over.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert max(left_over) < 30


def test_keyed_state_survives_a_restart(spark):
    feed = Feed(spark)

    def update():
        stream = feed.stream().withColumn("name", F.concat(F.lit("u"), "user"))
        timed = stream.withColumn("ts", F.when(F.col("user") != 9, F.col("ts").cast("timestamp_ntz")))
        updates = jobs.stream_keyed_state(timed, "name")
        run.each_batch(updates, "update", run.replace_batches(feed.out), feed.checkpoint)
        stored = spark.read.schema(updates.schema).parquet(f"{feed.out}/batch=*")
        return sorted(map(tuple, jobs.latest_state(stored, "name").collect()), key=str)

    feed.deliver([(1, at(5), 7), (2, at(1), 7), (3, at(2), 8)])
    assert update() == [("u7", 2, at(5)), ("u8", 1, at(2))]
    feed.deliver([(4, at(3), 7), (5, at(9), 9)])
    assert update() == [("u7", 3, at(5)), ("u8", 1, at(2)), ("u9", 1, None)]
    assert update() == [("u7", 3, at(5)), ("u8", 1, at(2)), ("u9", 1, None)]


def test_a_backlog_is_worked_off_in_several_batches(spark):
    """One file per micro-batch, several in one run, and a restart between."""
    feed = Feed(spark)

    def run_all():
        source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(feed.landing)
        windows = jobs.stream_sliding(jobs.event_time(source), "2 hours", "1 hour", delay="1 hour")
        query = run.each_batch(windows, "update", run.replace_batches(feed.out), feed.checkpoint)
        stored = spark.read.schema(windows.schema).parquet(f"{feed.out}/batch=*")
        rows = jobs.newest_windows(stored).orderBy("window_start").collect()
        return query.lastProgress, [r.n_rows for r in rows]

    for hour in range(4):
        feed.deliver([(10 * hour + k, at(60 * hour + k), 0) for k in range(3)])
    progress, counts = run_all()
    assert progress["batchId"] >= 3 and counts == [3, 6, 6, 6, 3]
    for hour in range(4, 12):
        feed.deliver([(10 * hour, at(60 * hour), 0)])
    progress, counts = run_all()
    assert counts == [3, 6, 6, 6, 4, *[2] * 7, 1]
    # The watermark has emptied the state of closed windows.
    assert progress["stateOperators"][0]["numRowsTotal"] <= 4


def test_a_replayed_batch_replaces_itself(spark):
    root = scratch_path(spark, "replay")
    write = run.multi_sink({"all": lambda b: b, "even": lambda b: b.filter("id % 2 = 0")}, root)
    batch = spark.range(10)
    for _ in range(2):
        write(batch, 0)
    write(spark.range(10, 14), 1)
    counts = {n: spark.read.parquet(f"{root}/{n}/batch=*").count() for n in ("all", "even")}
    assert counts == {"all": 14, "even": 7}


@pytest.mark.parametrize("slide, expected", [("1 hour", [2, 1]), ("30 minutes", [1, 2, 2, 1])])
def test_sliding_in_update_mode(spark, slide, expected):
    feed = Feed(spark)
    for rows in ([(1, at(5), 0)], [(2, at(35), 0), (3, at(70), 0)]):
        feed.deliver(rows)
        windows = jobs.stream_sliding(feed.stream(), "1 hour", slide, scale=2)
        run.each_batch(windows, "update", run.replace_batches(feed.out), feed.checkpoint)
    stored = spark.read.schema(windows.schema).parquet(f"{feed.out}/batch=*")
    rows = jobs.newest_windows(stored).orderBy("window_start").collect()
    assert [r.n_rows for r in rows] == expected
    assert [r.total for r in rows] == [float(n) for n in expected]


WATERMARKED = ("stream_dedupe", "stream_interval_join", "stream_session", "stream_sliding", "stream_tumbling")


@pytest.mark.parametrize("name", WATERMARKED)
def test_files_out_of_time_order_lose_no_rows(spark, small, tmp_path, monkeypatch, name):
    """One file per micro-batch, the newest rows in the oldest file."""
    monkeypatch.setattr(tables, "MAX_FILES", 1, raising=False)
    monkeypatch.setattr(tables.table_stream, "__defaults__", (1,))
    folder = tmp_path / "events.parquet"
    folder.mkdir()
    events = pq.read_table(f"{small}/events.parquet").sort_by([("ts", "descending")])
    size = -(-len(events) // 4)
    for k in range(4):
        pq.write_table(events.slice(k * size, size), path := folder / f"{k}.parquet")
        os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))
    query = streams.QUERIES[name]
    assert mismatch(query.run(spark, str(tmp_path)), small, query.sql) is None
