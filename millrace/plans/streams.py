"""Registered stream queries: each runs over the whole input and reads its output back."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from millrace.plans.registry import Query
from millrace.session import scratch_path, stage
from millrace.sources import tables
from millrace.sources.tables import TABLES, table, table_stream
from millrace.streaming import jobs, run, stateful

PROPS = StructType([StructField("k", IntegerType())])
GAP_SECONDS = 3600
LATE_DAY = "2024-01-10"
STREAM_BEGIN = "2024-01-10 12:00:00"


Arriving = Callable[[], DataFrame]


def _deliveries(spark: SparkSession, root: str) -> Iterator[Arriving]:
    """Streams of the events that have arrived so far, by deliveries whose times ascend.

    A table that fits one micro-batch is one delivery. A larger one, whose files may be in any
    order of time, is cut into stretches of time of about as many rows; each is put into the
    landing folder once the one before is worked off. No row is then older than all
    rows of an earlier micro-batch, and so none comes too late.
    """
    events = table(spark, root, "events")
    number = ceil(len(events.inputFiles()) / tables.MAX_FILES)
    if number <= 1:
        yield lambda: jobs.event_time(table_stream(spark, root, "events"))
        return
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    shares = [k / number for k in range(1, number)]
    found = events.agg(F.percentile_approx(micros, shares, 100 * number)).first()[0]
    bounds = sorted(set(found or []))
    # A row's delivery is the number of bounds up to its time; rows without a time go first.
    passed = F.filter(F.array(*map(F.lit, bounds)).cast("array<bigint>"), lambda bound: bound <= micros)
    cut = events.withColumn("delivery", F.size(passed)).repartitionByRange("delivery", "ts", "event_id")
    parts = stage(cut, "by-time", ("delivery",))
    landing = scratch_path(spark, "deliveries")
    for delivery in range(len(bounds) + 1):
        part = parts.filter(F.col("delivery") == delivery).drop("delivery")
        part.write.mode("append").parquet(landing)
        yield lambda: jobs.event_time(spark.readStream.schema(TABLES["events"]).parquet(landing))


def _replayed(
    spark: SparkSession, root: str, job: Callable[[Arriving], DataFrame], label: str, mode: str = "append"
) -> DataFrame:
    """What a job with a watermark gives for all events, however many micro-batches they take."""
    out, checkpoint = scratch_path(spark, label), scratch_path(spark, f"{label}-checkpoint")
    for arriving in _deliveries(spark, root):
        result = job(arriving)
        if mode == "append":
            run.append_to(result, out, checkpoint)
        else:
            run.each_batch(result, mode, run.replace_batches(out), checkpoint)
    return spark.read.schema(result.schema).parquet(out if mode == "append" else f"{out}/batch=*")


def _plain(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


def _each_batch(stream: DataFrame, mode: str, label: str) -> DataFrame:
    """All micro-batches of a stream, read back."""
    spark = stream.sparkSession
    out = scratch_path(spark, label)
    run.each_batch(stream, mode, run.replace_batches(out), scratch_path(spark, f"{label}-checkpoint"))
    return spark.read.schema(stream.schema).parquet(f"{out}/batch=*")


def stream_decode(spark: SparkSession, root: str) -> DataFrame:
    """Payloads of error events are cut short first, so that there is something to reject."""
    cut = F.when(F.col("event_type") == "error", F.expr("left(props, 4)")).otherwise(F.col("props"))
    stream = table_stream(spark, root, "events").select("event_id", cut.alias("props"))
    decoded = jobs.stream_decode(stream, "props", PROPS)
    out = scratch_path(spark, "decoded")
    sinks = {
        "typed": lambda batch: batch.filter(~F.col("rejected")),
        "rejects": lambda batch: batch.filter("rejected"),
    }
    run.each_batch(
        decoded, "append", run.multi_sink(sinks, out), scratch_path(spark, "decoded-checkpoint")
    )
    typed, rejects = (
        spark.read.schema(decoded.schema).parquet(f"{out}/{name}/batch=*") for name in sinks
    )
    return typed.unionByName(rejects.withColumn("k", F.lit(-1)))


def stream_dedupe(spark: SparkSession, root: str) -> DataFrame:
    def job(arriving: Arriving) -> DataFrame:
        return jobs.stream_dedupe(arriving().unionByName(arriving()), ["event_id"])

    return _plain(_replayed(spark, root, job, "deduped"), "ts")


def stream_tumbling(spark: SparkSession, root: str) -> DataFrame:
    job = lambda arriving: jobs.stream_tumbling(arriving(), "1 day", scale=2)
    return _plain(_replayed(spark, root, job, "tumbling"), "window_start", "window_end")


def stream_sliding(spark: SparkSession, root: str) -> DataFrame:
    job = lambda arriving: jobs.stream_sliding(arriving(), "1 day", "12 hours", scale=2)
    newest = jobs.newest_windows(_replayed(spark, root, job, "sliding", "update"))
    return _plain(newest, "window_start", "window_end")


def stream_session(spark: SparkSession, root: str) -> DataFrame:
    job = lambda arriving: jobs.stream_session(arriving(), "user_id", "30 minutes")
    return _plain(_replayed(spark, root, job, "sessions"), "session_start", "session_end")


def stream_late_rows(spark: SparkSession, root: str) -> DataFrame:
    """Error events and one whole day are delivered after all others, so most come too late.

    The second delivery resumes from the checkpoint of the first.
    """
    landing, out = scratch_path(spark, "deliveries"), scratch_path(spark, "late")
    checkpoint = scratch_path(spark, "late-checkpoint")
    schema = TABLES["events"]
    day = F.lit(LATE_DAY).cast("date")
    late = (F.col("event_type") == "error") | (F.to_date("ts") == day)
    for delivery in (~late, late):
        table(spark, root, "events").filter(delivery).write.mode("append").parquet(landing)
        arriving = jobs.event_time(spark.readStream.schema(schema).parquet(landing))
        closed = jobs.stream_tumbling(arriving, "1 day")
        run.append_to(closed, out, checkpoint)
    counted = _plain(spark.read.schema(closed.schema).parquet(out), "window_start", "window_end")
    return jobs.with_dropped(counted, spark.read.schema(schema).parquet(landing), "1 day")


def _enrichment(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    events = table_stream(spark, root, "events").select("event_id", "user_id")
    return events, table(spark, root, "customer").select("c_custkey", "c_name", "c_mktsegment")


def stream_enrich(spark: SparkSession, root: str) -> DataFrame:
    enriched = jobs.stream_enrich(*_enrichment(spark, root), {"user_id": "c_custkey"})
    return run.append_and_read(enriched, "enriched")


def stream_enrich_each_batch(spark: SparkSession, root: str) -> DataFrame:
    events, dim = _enrichment(spark, root)
    out = scratch_path(spark, "enriched")
    enrich = jobs.enrich_each_batch(dim, {"user_id": "c_custkey"}, run.replace_batches(out))
    run.each_batch(events, "append", enrich, scratch_path(spark, "enriched-checkpoint"))
    schema = "event_id bigint, user_id bigint, c_name string, c_mktsegment string"
    return spark.read.schema(schema).parquet(f"{out}/batch=*")


def stream_interval_join(spark: SparkSession, root: str) -> DataFrame:
    def side(arriving: Arriving, kind: str, prefix: str) -> DataFrame:
        rows = arriving().filter(F.col("event_type") == kind)
        named: list[Column] = [F.col(c).alias(f"{prefix}_{c}") for c in ("event_id", "ts")]
        return rows.select("user_id", *named)

    def job(arriving: Arriving) -> DataFrame:
        return jobs.stream_interval_join(
            side(arriving, "click", "click"), side(arriving, "purchase", "purchase"), "user_id",
            "click_ts", "purchase_ts", GAP_SECONDS,
        )

    return _plain(_replayed(spark, root, job, "pairs"), "click_ts", "purchase_ts")


def stream_keyed_state(spark: SparkSession, root: str) -> DataFrame:
    updates = jobs.stream_keyed_state(table_stream(spark, root, "events"), "user_id")
    return jobs.latest_state(_each_batch(updates, "update", "state"), "user_id")


def stream_multi_sink(spark: SparkSession, root: str) -> DataFrame:
    events = table_stream(spark, root, "events")
    out = scratch_path(spark, "sinks")
    sinks = {
        "all": lambda batch: batch,
        "purchases": lambda batch: batch.filter(F.col("event_type") == "purchase"),
    }
    run.each_batch(
        events, "append", run.multi_sink(sinks, out), scratch_path(spark, "sinks-checkpoint")
    )
    stored = [
        spark.read.schema(TABLES["events"])
        .parquet(f"{out}/{name}/batch=*")
        .select(F.lit(name).alias("sink"), "event_id", "event_type", "value")
        for name in sinks
    ]
    return stored[0].unionByName(stored[1])


_ENRICHED_SQL = """
    SELECT event_id, user_id, c_name, c_mktsegment
    FROM events LEFT JOIN customer ON user_id = c_custkey"""
def stream_left_open(spark: SparkSession, root: str) -> DataFrame:
    """Clicks that no purchase of the user follows within an hour, from an hour before the stream begins.

    Those of that hour which are still open are the state to begin with.
    """
    is_click, is_purchase = (F.col("event_type") == kind for kind in ("click", "purchase"))
    begin, gap = F.lit(STREAM_BEGIN).cast("timestamp"), F.expr(f"interval {GAP_SECONDS} seconds")
    before = jobs.event_time(table(spark, root, "events"))
    before = before.filter((F.col("ts") >= begin - gap) & (F.col("ts") < begin))
    bought = before.filter(is_purchase).groupBy(F.col("user_id").alias("buyer"))
    bought = bought.agg(F.max("ts").alias("bought_at"))  # all of them are within the gap
    same = (F.col("user_id") == F.col("buyer")) & (F.col("ts") <= F.col("bought_at"))
    known = before.filter(is_click).join(bought, same, "left_anti")

    def job(arriving: Arriving) -> DataFrame:
        stream = arriving().filter(F.col("ts") >= begin)
        return stateful.stream_left_open(
            stream, "user_id", "ts", "event_id", is_click, is_purchase, GAP_SECONDS, known
        )

    return _plain(_replayed(spark, root, job, "left-open"), "opened_at", "left_at")


_CLOSED = "(SELECT max(ts) - INTERVAL 1 HOUR FROM events)"

QUERIES = {
    "stream_decode": Query(
        stream_decode,
        """
        SELECT event_id,
               CASE WHEN event_type = 'error' THEN left(props, 4) ELSE props END AS props,
               CASE WHEN event_type = 'error' THEN -1
                    ELSE CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k,
               event_type = 'error' AS rejected
        FROM events""",
    ),
    "stream_dedupe": Query(stream_dedupe, "SELECT * FROM events"),
    "stream_tumbling": Query(
        stream_tumbling,
        f"""
        SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start,
               CAST(date_trunc('day', ts) AS TIMESTAMP) + INTERVAL 1 DAY AS window_end,
               count(*) AS n_rows,
               CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
        FROM events GROUP BY 1, 2
        HAVING window_end <= {_CLOSED}""",
    ),
    "stream_sliding": Query(
        stream_sliding,
        """
        WITH half AS (
            SELECT value, time_bucket(INTERVAL 12 HOUR, ts, TIMESTAMP '2000-01-01') AS s
            FROM events),
        placed AS (SELECT value, s FROM half
                   UNION ALL SELECT value, s - INTERVAL 12 HOUR FROM half)
        SELECT s AS window_start, s + INTERVAL 1 DAY AS window_end, count(*) AS n_rows,
               CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
        FROM placed GROUP BY 1, 2""",
    ),
    "stream_session": Query(
        stream_session,
        f"""
        WITH l AS (SELECT user_id, ts, lag(ts) OVER w AS p FROM events
                   WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
        n AS (SELECT user_id, ts,
                     sum(CASE WHEN p IS NULL OR ts - p > INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
                         OVER (PARTITION BY user_id ORDER BY ts) AS s FROM l)
        SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end,
               count(*) AS n_rows
        FROM n GROUP BY user_id, s
        HAVING max(ts) + INTERVAL 30 MINUTE <= {_CLOSED}""",
    ),
    "stream_left_open": Query(
        stream_left_open,
        f"""
        WITH e AS (SELECT * FROM events WHERE event_type IN ('click', 'purchase')),
        w AS (SELECT epoch_ms(max(ts)) - 3600000 AS reached FROM e)
        SELECT user_id, event_id, ts AS opened_at, ts + INTERVAL 1 HOUR AS left_at FROM e AS c, w
        WHERE event_type = 'click' AND ts >= TIMESTAMP '{STREAM_BEGIN}' - INTERVAL 1 HOUR
              AND epoch_ms(ts + INTERVAL 1 HOUR) < reached - 1
              AND NOT EXISTS (SELECT 1 FROM e AS p WHERE p.event_type = 'purchase'
                              AND p.user_id = c.user_id AND p.ts BETWEEN c.ts AND c.ts + INTERVAL 1 HOUR)""",
    ),
    "stream_late_rows": Query(
        stream_late_rows,
        """
        WITH w1 AS (SELECT max(ts) - INTERVAL 1 HOUR AS t FROM events
                    WHERE event_type <> 'error' AND CAST(ts AS DATE) <> DATE '2024-01-10'),
        w2 AS (SELECT max(ts) - INTERVAL 1 HOUR AS t FROM events),
        d AS (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start,
                     CAST(date_trunc('day', ts) AS TIMESTAMP) + INTERVAL 1 DAY AS window_end,
                     event_type = 'error' OR CAST(ts AS DATE) = DATE '2024-01-10' AS late,
                     CAST(date_trunc('day', ts) AS TIMESTAMP) + INTERVAL 1 DAY <= w1.t AS shut
              FROM events, w1)
        SELECT window_start, window_end,
               count(*) FILTER (NOT (late AND shut)) AS n_counted,
               count(*) FILTER (late AND shut) AS n_dropped
        FROM d, w2 WHERE window_end <= w2.t GROUP BY 1, 2""",
    ),
    "stream_enrich": Query(stream_enrich, _ENRICHED_SQL),
    "stream_enrich_each_batch": Query(stream_enrich_each_batch, _ENRICHED_SQL),
    "stream_interval_join": Query(
        stream_interval_join,
        """
        SELECT c.user_id, c.event_id AS click_event_id, c.ts AS click_ts,
               p.event_id AS purchase_event_id, p.ts AS purchase_ts
        FROM events c JOIN events p ON c.user_id = p.user_id
             AND p.ts >= c.ts AND p.ts <= c.ts + INTERVAL 1 HOUR
        WHERE c.event_type = 'click' AND p.event_type = 'purchase'""",
    ),
    "stream_keyed_state": Query(
        stream_keyed_state,
        "SELECT user_id, count(*) AS n_rows, max(ts) AS last_ts FROM events GROUP BY 1",
    ),
    "stream_multi_sink": Query(
        stream_multi_sink,
        """
        SELECT 'all' AS sink, event_id, event_type, value FROM events
        UNION ALL
        SELECT 'purchases', event_id, event_type, value FROM events
        WHERE event_type = 'purchase'""",
    ),
}
