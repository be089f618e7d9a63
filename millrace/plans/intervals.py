"""Registered queries on intervals and on rows in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import intervals, patterns
from millrace.plans.registry import Query
from millrace.sources.tables import table


def overlap_join(spark: SparkSession, root: str) -> DataFrame:
    """Purchases and errors, of any users, that were going on at the same time.

    An event goes on for ten seconds per unit of its value.
    """
    events = table(spark, root, "events")
    begin = F.unix_micros(F.col("ts").cast("timestamp"))
    length = F.round(F.col("value") * 10_000_000).cast("bigint")

    def going_on(kind: str, name: str) -> DataFrame:
        return events.filter(F.col("event_type") == kind).select(
            F.col("event_id").alias(f"{name}_id"),
            begin.alias(f"{name}_begin"),
            (begin + length).alias(f"{name}_end"),
        )

    return intervals.overlap_join(
        going_on("purchase", "purchase"),
        going_on("error", "error"),
        ("purchase_begin", "purchase_end"),
        ("error_begin", "error_end"),
    )


def match_rows(spark: SparkSession, root: str) -> DataFrame:
    """A view, then one or more clicks, then a purchase, with no error between; signups are passed over."""
    events = table(spark, root, "events")
    steps = [patterns.one("view"), patterns.some("click"), patterns.one("purchase")]
    symbol = F.when(F.col("event_type") != "signup", F.col("event_type"))
    return patterns.match_rows(
        events, ["user_id"], ["ts", "event_id"], "event_id", symbol, patterns.Pattern(steps)
    )


QUERIES = {
    "overlap_join": Query(
        overlap_join,
        """
        WITH e AS (SELECT event_id, event_type, epoch_us(ts) AS b,
                          epoch_us(ts) + CAST(round(value * 10000000) AS BIGINT) AS e FROM events)
        SELECT p.event_id AS purchase_id, p.b AS purchase_begin, p.e AS purchase_end,
               x.event_id AS error_id, x.b AS error_begin, x.e AS error_end
        FROM e p JOIN e x ON p.b <= x.e AND x.b <= p.e
        WHERE p.event_type = 'purchase' AND x.event_type = 'error'""",
    ),
    "match_rows": Query(
        match_rows,
        """
        WITH n AS (SELECT user_id, event_id, event_type,
                          row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k
                   FROM events WHERE event_type <> 'signup'),
        m AS (SELECT *, max(CASE WHEN event_type <> 'click' THEN k END) OVER (
                     PARTITION BY user_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b
              FROM n)
        SELECT m.user_id, v.event_id AS first, m.event_id AS last, m.k - m.b + 1 AS n_rows
        FROM m JOIN n v ON v.user_id = m.user_id AND v.k = m.b
        WHERE m.event_type = 'purchase' AND v.event_type = 'view' AND m.k - m.b >= 2""",
    ),
}
