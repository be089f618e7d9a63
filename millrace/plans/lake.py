"""Registered queries on layered storage."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from millrace.plans.registry import Query
from millrace.session import scratch_path
from millrace.sources import clustered, fixed_width, gate, lake
from millrace.sources.tables import TABLES, table
from millrace.streaming import run

PROPS = StructType([StructField("k", IntegerType())])
DAY_TYPE = ["event_date", "event_type"]


def _landed(spark: SparkSession, root: str):
    """All events as JSON lines, plus a broken and a mistyped copy of each error event."""
    path = scratch_path(spark, "landing")
    events = table(spark, root, "events")
    lake.write_json_lines(events, path)
    errors = events.filter("event_type = 'error'")
    for bad in (
        F.concat(F.lit('{"event_id": '), F.col("event_id")),
        F.concat(F.lit('{"event_id": "no '), F.col("event_id"), F.lit('"}')),
    ):
        errors.select(bad.alias("value")).write.mode("append").text(path)
    return lake.land_raw(spark, path, "json", events.schema)


def land_raw_csv(spark: SparkSession, root: str) -> DataFrame:
    """All events as CSV lines, typed again; error events come once more with a broken time."""
    path = scratch_path(spark, "landing-csv")
    events = table(spark, root, "events")
    lake.write_csv_lines(events, path)
    errors = events.filter("event_type = 'error'")
    broken = F.concat_ws(",", "event_id", F.lit("no time"), "user_id", "event_type", "value")
    errors.select(broken.alias("value")).write.mode("append").text(path)
    split = lake.land_raw(spark, path, "csv", events.schema)
    good = split.valid.withColumn("line", F.lit(""))
    return good.unionByName(split.rejects, allowMissingColumns=True)


def land_raw(spark: SparkSession, root: str) -> DataFrame:
    return _landed(spark, root).valid


def land_raw_corrupt(spark: SparkSession, root: str) -> DataFrame:
    return _landed(spark, root).rejects


def parse_json_column(spark: SparkSession, root: str) -> DataFrame:
    events = table(spark, root, "events").select("event_id", "props")
    return lake.parse_json_column(events, "props", PROPS)


#: Bytes of the columns of a line of events.
EVENT_WIDTHS = (20, 26, 20, 16, 24, 64)


def _event_lines(spark: SparkSession, root: str) -> tuple[str, fixed_width.Layout]:
    path = scratch_path(spark, "event-lines")
    layout = fixed_width.Layout(StructType.fromDDL(TABLES["events"]), EVENT_WIDTHS)
    fixed_width.write(table(spark, root, "events"), path, layout)
    return path, layout


def fixed_width_read(spark: SparkSession, root: str) -> DataFrame:
    """Purchases and errors of users from number 5 on, from lines of fixed width."""
    path, layout = _event_lines(spark, root)
    columns = ["event_id", "ts", "user_id", "event_type", "value"]
    return fixed_width.read(spark, path, layout, columns).filter(
        F.col("event_type").isin("purchase", "error") & (F.col("user_id") >= 5)
    )


def fixed_width_stream(spark: SparkSession, root: str) -> DataFrame:
    """All events, from lines of fixed width by a stream."""
    path, layout = _event_lines(spark, root)
    out = scratch_path(spark, "event-lines-out")
    stream = fixed_width.read_stream(spark, path, layout)
    run.append_to(stream, out, scratch_path(spark, "event-lines-checkpoint"))
    return spark.read.schema(layout.columns).parquet(out)


def promote_layers(spark: SparkSession, root: str) -> DataFrame:
    """All events in three loads that share days.

    The first load has earlier versions of the error events, with another day and type, which
    the later loads correct.
    """
    events, layers = table(spark, root, "events"), scratch_path(spark, "layers")
    early = events.filter("event_type = 'error'").withColumns(
        {"ts": F.col("ts") - F.expr("interval 1 day"), "event_type": F.lit("draft")}
    )
    third = F.col("event_id") % 3
    for load in (events.filter(third == 0).unionByName(early), events.filter(third == 1), events.filter(third == 2)):
        _, mart = lake.promote_layers(load, layers)
    stored = spark.read.schema(lake.MART_SCHEMA).parquet(mart)
    return stored.select(
        F.col("event_date").cast("timestamp_ntz").alias("day"),
        "event_type",
        "n_events",
        "total_value",
    )


def _clean(spark: SparkSession, root: str) -> str:
    return lake.promote_clean(table(spark, root, "events"), scratch_path(spark, "layers"))


def read_pruned(spark: SparkSession, root: str) -> DataFrame:
    week = F.col("event_date").between(date(2024, 1, 8), date(2024, 1, 14))
    pruned = lake.read_pruned(spark, _clean(spark, root), lake.CLEAN_SCHEMA, week)
    return pruned.select("event_id", "ts", "user_id", "event_type", "value", "props")


def compact_files(spark: SparkSession, root: str) -> DataFrame:
    src, dst = scratch_path(spark, "small-files"), scratch_path(spark, "compacted")
    events = table(spark, root, "events")
    events.repartition(8).write.partitionBy("event_type").parquet(src)
    lake.compact_files(spark, src, dst, TABLES["events"], ["event_type"], 128 * 1024 * 1024)
    return spark.read.schema(TABLES["events"]).parquet(dst)


def lake_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Row counts per partition; file counts and sizes only as far as SQL can tell them."""
    stock = lake.lake_inventory(spark, _clean(spark, root), lake.CLEAN_SCHEMA, DAY_TYPE)
    return stock.select(
        F.col("event_date").cast("timestamp_ntz").alias("day"),
        "event_type",
        "n_rows",
        (F.col("n_files") > 0).alias("has_files"),
        (F.col("n_bytes") > F.col("n_rows")).alias("has_bytes"),
    )


def read_clustered(spark: SparkSession, root: str) -> DataFrame:
    """Events of some users in a range of values, from a table that is clustered by both."""
    path = scratch_path(spark, "clustered")
    clustered.write_clustered(table(spark, root, "events"), path, ["user_id", "value"], 500)
    ranges = {"user_id": (10, 30), "value": (5.0, 20.0)}
    return clustered.read_clustered(spark, path, TABLES["events"], ranges)


def _gated(spark: SparkSession, root: str) -> tuple[str, list[gate.GateReport]]:
    """Loads of events: a good one, one that lost the values of error events, twice, and an empty one."""
    events, path = table(spark, root, "events"), scratch_path(spark, "gated")
    lost = F.when(F.col("event_type") != "error", F.col("value"))
    rules = {"value is known": F.col("value") >= 0, "event has a time": F.col("ts").isNotNull()}
    good, bad = events.filter("event_type = 'error'"), events.withColumn("value", lost)
    return path, [
        gate.gated_write(good, path, rules),
        gate.gated_write(bad, path, rules),
        # Half of the rows may break a rule here, so this one passes.
        gate.gated_write(bad, f"{path}-tolerant", rules, {"value is known": 0.5}),
        gate.gated_write(events.filter("event_id < 0"), path, rules),
    ]


def gated_write(spark: SparkSession, root: str) -> DataFrame:
    """What readers see after one good load and two that were refused."""
    path, _ = _gated(spark, root)
    return gate.read_published(spark, path, TABLES["events"])


def gate_report(spark: SparkSession, root: str) -> DataFrame:
    """One row a load: rows, rows without a value, and whether it was published."""
    _, reports = _gated(spark, root)
    rows = [(k + 1, r.published, r.n_rows, r.broken["value is known"]) for k, r in enumerate(reports)]
    return spark.createDataFrame(rows, "load int, published boolean, n_rows bigint, n_broken bigint")


QUERIES = {
    "fixed_width_read": Query(
        fixed_width_read,
        """
        SELECT event_id, ts, user_id, event_type, value FROM events
        WHERE event_type IN ('purchase', 'error') AND user_id >= 5""",
    ),
    "fixed_width_stream": Query(fixed_width_stream, "SELECT * FROM events"),
    "land_raw": Query(land_raw, "SELECT * FROM events"),
    "land_raw_csv": Query(
        land_raw_csv,
        """
        SELECT *, '' AS line FROM events
        UNION ALL
        SELECT NULL, NULL, NULL, NULL, NULL, NULL,
               concat_ws(',', event_id, 'no time', user_id, event_type, value)
        FROM events WHERE event_type = 'error'""",
    ),
    "land_raw_corrupt": Query(
        land_raw_corrupt,
        """
        SELECT '{"event_id": ' || event_id AS line FROM events WHERE event_type = 'error'
        UNION ALL
        SELECT '{"event_id": "no ' || event_id || '"}' FROM events WHERE event_type = 'error'""",
    ),
    "parse_json_column": Query(
        parse_json_column,
        """
        SELECT event_id, props, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
        FROM events""",
    ),
    "promote_layers": Query(
        promote_layers,
        """
        SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, event_type,
               count(*) AS n_events,
               CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
        FROM events GROUP BY 1, 2""",
    ),
    "read_pruned": Query(
        read_pruned,
        """
        SELECT event_id, ts, user_id, event_type, value, props FROM events
        WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'""",
    ),
    "compact_files": Query(compact_files, "SELECT * FROM events"),
    "lake_inventory": Query(
        lake_inventory,
        """
        SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, event_type, count(*) AS n_rows,
               TRUE AS has_files, TRUE AS has_bytes
        FROM events GROUP BY 1, 2""",
    ),
    "read_clustered": Query(
        read_clustered,
        "SELECT * FROM events WHERE user_id BETWEEN 10 AND 30 AND value BETWEEN 5.0 AND 20.0",
    ),
    "gated_write": Query(gated_write, "SELECT * FROM events WHERE event_type = 'error'"),
    "gate_report": Query(
        gate_report,
        """
        WITH e AS (SELECT count(*) AS n, count(*) FILTER (event_type = 'error') AS errors FROM events)
        SELECT 1 AS load, TRUE AS published, errors AS n_rows, 0::BIGINT AS n_broken FROM e
        UNION ALL SELECT 2, FALSE, n, errors FROM e
        UNION ALL SELECT 3, TRUE, n, errors FROM e
        UNION ALL SELECT 4, FALSE, 0, 0""",
    ),
}
