"""Registered queries on a warehouse fed by several sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import multisource as ops
from millrace.plans.registry import Query
from millrace.session import scratch_path, stage
from millrace.sources import history
from millrace.sources.tables import table


def _parties(spark: SparkSession, root: str) -> DataFrame:
    customer = table(spark, root, "customer").select(
        F.col("c_custkey").alias("party_id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation_key"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    supplier = table(spark, root, "supplier").select(
        F.col("s_suppkey").alias("party_id"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation_key"),
        F.col("s_acctbal").alias("balance"),
    )
    return ops.union_sources({"customer": customer, "supplier": supplier})


def union_sources(spark: SparkSession, root: str) -> DataFrame:
    return _parties(spark, root)


def resolve_by_precedence(spark: SparkSession, root: str) -> DataFrame:
    return ops.resolve_by_precedence(
        _parties(spark, root), "party_id", {"supplier": 0, "customer": 1}, ["name"]
    )


def reconcile_sources(spark: SparkSession, root: str) -> DataFrame:
    per_order = (
        table(spark, root, "lineitem")
        .groupBy(F.col("l_orderkey").alias("order_key"))
        .agg(F.count(F.lit(1)).alias("n_lines"))
    )
    # The orders table states no line count, so an order is held to four lines.
    orders = table(spark, root, "orders").select(
        F.col("o_orderkey").alias("order_key"), F.lit(4).cast("bigint").alias("n_lines")
    )
    compared = ops.reconcile_sources(orders, per_order, ["order_key"], ["n_lines"])
    sides = ("left_n_lines", "right_n_lines")
    return compared.withColumns({c: F.coalesce(c, F.lit(0)) for c in sides})


def _history(spark: SparkSession, root: str) -> DataFrame:
    return ops.scd2_history(table(spark, root, "events"), "user_id", "ts", ["event_type"])


def scd2_history(spark: SparkSession, root: str) -> DataFrame:
    return _history(spark, root)


def point_in_time_join(spark: SparkSession, root: str) -> DataFrame:
    """The state of each user at each midnight from its first day to the day after its last."""
    days = (
        table(spark, root, "events")
        .groupBy("user_id")
        .agg(F.min(F.to_date("ts")).alias("_first"), F.max(F.to_date("ts")).alias("_last"))
        .select(
            "user_id",
            F.explode(F.sequence("_first", F.date_add("_last", F.lit(1)))).alias("_day"),
        )
        .select("user_id", F.col("_day").cast("timestamp_ntz").alias("snapshot_at"))
    )
    # A warehouse keeps its history as a table; the join reads it more than once.
    versions = stage(_history(spark, root), "history")
    joined = ops.point_in_time_join(days, versions, "user_id", "snapshot_at")
    return joined.select("user_id", "snapshot_at", "event_type", "valid_from")


def merge_history(spark: SparkSession, root: str) -> DataFrame:
    """The history of ``scd2_history`` from three loads; each has changes older than those before."""
    events = table(spark, root, "events").select("user_id", "ts", "event_type")
    home, place = scratch_path(spark, "history"), F.pmod(F.xxhash64("ts"), F.lit(3))
    for load in (2, 0, 1):
        history.merge_history(events.filter(place == load), home, "user_id", "ts", ["event_type"])
    columns = "user_id bigint, ts timestamp_ntz, event_type string"
    return history.read_history(spark, home, "user_id", "ts", columns)


_PARTIES_SQL = """
    SELECT c_custkey AS party_id, c_name AS name, c_nationkey AS nation_key,
           c_acctbal AS balance, c_mktsegment AS segment, 'customer' AS source FROM customer
    UNION ALL
    SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL, 'supplier' FROM supplier"""

_HISTORY_SQL = """
    WITH l AS (
        SELECT user_id, ts, event_type,
               lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events),
    c AS (SELECT * FROM l WHERE p IS NULL OR p <> event_type)
    SELECT user_id, event_type, ts AS valid_from,
           lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to FROM c"""

QUERIES = {
    "union_sources": Query(union_sources, _PARTIES_SQL),
    "resolve_by_precedence": Query(
        resolve_by_precedence,
        """
        SELECT coalesce(s_suppkey, c_custkey) AS party_id, coalesce(s_name, c_name) AS name,
               coalesce(s_nationkey, c_nationkey) AS nation_key,
               coalesce(s_acctbal, c_acctbal) AS balance, c_mktsegment AS segment
        FROM supplier FULL JOIN customer ON s_suppkey = c_custkey""",
    ),
    "reconcile_sources": Query(
        reconcile_sources,
        """
        WITH o AS (SELECT o_orderkey AS k, CAST(4 AS BIGINT) AS n FROM orders),
        l AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1)
        SELECT coalesce(o.k, l.k) AS order_key,
               CASE WHEN l.k IS NULL THEN 'left_only' WHEN o.k IS NULL THEN 'right_only'
                    WHEN o.n IS NOT DISTINCT FROM l.n THEN 'matched' ELSE 'differs' END AS status,
               coalesce(o.n, 0) AS left_n_lines, coalesce(l.n, 0) AS right_n_lines
        FROM o FULL JOIN l ON o.k = l.k""",
    ),
    "scd2_history": Query(
        scd2_history, f"SELECT *, valid_to IS NULL AS is_current FROM ({_HISTORY_SQL})"
    ),
    "merge_history": Query(
        merge_history, f"SELECT *, valid_to IS NULL AS is_current FROM ({_HISTORY_SQL})"
    ),
    "point_in_time_join": Query(
        point_in_time_join,
        f"""
        WITH h AS ({_HISTORY_SQL}),
        r AS (SELECT user_id, date_trunc('day', min(ts)) AS d0, date_trunc('day', max(ts)) AS d1
              FROM events GROUP BY 1),
        f AS (SELECT user_id,
                     unnest(generate_series(CAST(d0 AS TIMESTAMP),
                                            CAST(d1 AS TIMESTAMP) + INTERVAL 1 DAY,
                                            INTERVAL 1 DAY)) AS snapshot_at FROM r)
        SELECT f.user_id, f.snapshot_at, h.event_type, h.valid_from
        FROM f LEFT JOIN h ON h.user_id = f.user_id AND h.valid_from <= f.snapshot_at
             AND (f.snapshot_at < h.valid_to OR h.valid_to IS NULL)""",
    ),
}
