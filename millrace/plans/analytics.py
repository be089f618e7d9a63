"""Registered analytical queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.money import total
from millrace.operators import analytics as ops
from millrace.operators import sketches
from millrace.operators.etl import incremental_slice
from millrace.plans.registry import Query
from millrace.session import stage
from millrace.sources.tables import table

FUNNEL_STEPS = ["view", "click", "purchase"]
MOVING_WIDTH = 3
RETURN_FLAGS = {"A": "qty_a", "N": "qty_n", "R": "qty_r"}


def star_revenue(spark: SparkSession, root: str) -> DataFrame:
    names = ("lineitem", "orders", "customer", "nation", "region")
    return ops.star_revenue(*[table(spark, root, n) for n in names])


def _totals(mode: str, sets: list[list[str]] | None = None):
    levels = ["o_orderstatus", "o_orderpriority"]

    def run(spark: SparkSession, root: str) -> DataFrame:
        orders = table(spark, root, "orders")
        return ops.multi_level_totals(orders, levels, "o_totalprice", mode, sets, scale=2)

    return run


def _totals_sql(grouping: str) -> str:
    return f"""
        SELECT o_orderstatus, o_orderpriority,
               CAST(grouping(o_orderstatus, o_orderpriority) AS BIGINT) AS level_id,
               count(*) AS n_rows,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
        FROM orders GROUP BY {grouping}"""


def top_n_per_group(spark: SparkSession, root: str) -> DataFrame:
    orders = table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    place = table(spark, root, "customer").join(
        table(spark, root, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    placed = orders.join(place, F.col("o_custkey") == F.col("c_custkey")).select(
        "n_name", "o_orderkey", "o_totalprice"
    )
    order = [F.col("o_totalprice").desc(), F.col("o_orderkey")]
    return ops.top_n_per_group(placed, ["n_name"], order, 3)


def running_and_moving(spark: SparkSession, root: str) -> DataFrame:
    orders = table(spark, root, "orders").select(
        "o_custkey", "o_orderdate", "o_orderkey", "o_totalprice"
    )
    return ops.running_and_moving(
        orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_totalprice", MOVING_WIDTH, scale=2
    )


def period_over_period(spark: SparkSession, root: str) -> DataFrame:
    orders = table(spark, root, "orders")
    return ops.period_over_period(orders, "o_orderdate", "o_totalprice", scale=2)


def pivot_measures(spark: SparkSession, root: str) -> DataFrame:
    lines = table(spark, root, "lineitem").select(
        F.year("l_shipdate").alias("ship_year"), "l_returnflag", "l_quantity"
    )
    quantity = total("l_quantity").cast("double")
    return ops.pivot_measures(lines, ["ship_year"], "l_returnflag", RETURN_FLAGS, quantity)


def unpivot_measures(spark: SparkSession, root: str) -> DataFrame:
    wide = pivot_measures(spark, root)
    return ops.unpivot_measures(wide, ["ship_year"], list(RETURN_FLAGS.values()), "measure", "qty")


def with_and_without(spark: SparkSession, root: str) -> DataFrame:
    return ops.with_and_without(
        table(spark, root, "orders"), table(spark, root, "lineitem"), {"o_orderkey": "l_orderkey"}
    )


def compare_sets(spark: SparkSession, root: str) -> DataFrame:
    orders = table(spark, root, "orders")

    def buyers(year: int) -> DataFrame:
        bounds = datetime(year, 1, 1), datetime(year + 1, 1, 1)
        return incremental_slice(orders, "o_orderdate", *bounds).select("o_custkey")

    return ops.compare_sets(buyers(1995), buyers(1996))


def funnel_conversion(spark: SparkSession, root: str) -> DataFrame:
    return ops.funnel_conversion(
        table(spark, root, "events"), "user_id", "ts", "event_type", FUNNEL_STEPS
    )


def cohort_retention(spark: SparkSession, root: str) -> DataFrame:
    return ops.cohort_retention(table(spark, root, "orders"), "o_custkey", "o_orderdate")


def distribution_stats(spark: SparkSession, root: str) -> DataFrame:
    stats = ops.distribution_stats(table(spark, root, "orders"), "o_orderpriority", "o_totalprice")
    return stats.select(
        "o_orderpriority",
        "n",
        *[F.round(c, 2).alias(c) for c in ("min", "max", "mean", "stddev", "q1", "median", "q3")],
    )


def approx_distinct(spark: SparkSession, root: str) -> DataFrame:
    """The sketch beside the exact count: whether it is within three standard deviations."""
    orders = table(spark, root, "orders")
    year = F.year("o_orderdate").alias("order_year")
    sketch = ops.approx_distinct(orders, [year], "o_custkey", 0.02)
    exact = orders.groupBy(year).agg(F.count_distinct("o_custkey").alias("n"))
    within = F.abs(F.col("n_distinct") - F.col("n")) <= 3 * 0.02 * F.col("n")
    return sketch.join(exact, "order_year").select("order_year", within.alias("within_bound"))


def _sketches(events: DataFrame) -> DataFrame:
    groups = {"day": F.date_trunc("day", "ts"), "event_type": F.col("event_type")}
    return stage(sketches.sketch_mart(events, groups, "user_id", "value"), "sketch-mart")


def sketch_spans(spark: SparkSession, root: str) -> DataFrame:
    """Weeks answered from a stored mart of days, beside exact figures: whether each is within its bound.

    Users are allowed four standard errors, the quartiles twice the error of a rank.
    """
    events = table(spark, root, "events").select("ts", "event_type", "user_id", "value")
    shares = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    week = {"week": F.date_trunc("week", "day").cast("timestamp_ntz"), "event_type": F.col("event_type")}
    found = sketches.span_figures(_sketches(events), week, shares)
    exact_of = F.col("exact_week").eqNullSafe(F.col("week")) & F.col("exact_type").eqNullSafe(F.col("event_type"))
    rows = events.select(
        F.date_trunc("week", "ts").cast("timestamp_ntz").alias("exact_week"),
        F.col("event_type").alias("exact_type"), "user_id", "value",
    )
    users = rows.groupBy("exact_week", "exact_type").agg(F.count_distinct("user_id").alias("n_exact"))
    # The sketches' answers have a row per week and type: the join adds them to the rows.
    placed = rows.drop("user_id").join(found.select("week", "event_type", *shares), exact_of)
    ranks = placed.groupBy("exact_week", "exact_type").agg(
        *[F.avg((F.col("value") <= F.col(n)).cast("int")).alias(f"_le_{n}") for n in shares],
        *[F.avg((F.col("value") < F.col(n)).cast("int")).alias(f"_lt_{n}") for n in shares],
    )
    allowed, rank = 4 * sketches.COUNT_ERROR, 2 * sketches.RANK_ERROR
    return (
        found.join(users, exact_of)
        .drop("exact_week", "exact_type")
        .join(ranks, exact_of)
        .select(
            "week",
            "event_type",
            "n_rows",
            (F.abs(F.col("n_keys") - F.col("n_exact")) <= allowed * F.col("n_exact")).alias("n_keys_within"),
            *[
                ((F.col(f"_le_{n}") >= s - rank) & (F.col(f"_lt_{n}") <= s + rank)).alias(f"{n}_within")
                for n, s in shares.items()
            ],
        )
    )


def sketch_retention(spark: SparkSession, root: str) -> DataFrame:
    """Users of each kind of event in the first ten days of 2024 and in the next, and in both, from the mart."""
    events = table(spark, root, "events").select("ts", "event_type", "user_id", "value")
    spans = [F.col("day").between(datetime(2024, 1, a), datetime(2024, 1, b)) for a, b in ((1, 10), (11, 20))]
    found = sketches.span_overlap(_sketches(events), ["event_type"], *spans)
    seen = [F.max(s.cast("int")).alias(n) for s, n in zip(spans, ("_a", "_b"))]
    exact = (
        events.withColumn("day", F.date_trunc("day", "ts"))
        .filter(F.col("user_id").isNotNull() & (spans[0] | spans[1]))
        .groupBy(F.col("event_type").alias("exact_type"), "user_id")
        .agg(*seen)
        .groupBy("exact_type")
        .agg(F.sum("_a").alias("a"), F.sum("_b").alias("b"), F.sum(F.col("_a") * F.col("_b")).alias("both"),
             F.count(F.lit(1)).alias("either"))
    )
    allowed = 4 * sketches.COUNT_ERROR
    return found.join(exact, F.col("event_type").eqNullSafe(F.col("exact_type"))).select(
        "event_type",
        (F.abs(F.col("n_first") - F.col("a")) <= allowed * F.col("a")).alias("n_first_within"),
        (F.abs(F.col("n_second") - F.col("b")) <= allowed * F.col("b")).alias("n_second_within"),
        (F.abs(F.col("n_both") - F.col("both")) <= allowed * F.col("either")).alias("n_both_within"),
    )


def approx_quantiles(spark: SparkSession, root: str) -> DataFrame:
    """Sketch quantiles beside exact ranks: whether each is off by at most two rows in a thousand."""
    orders = table(spark, root, "orders").select("o_orderpriority", "o_totalprice")
    shares = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    group = F.col("o_orderpriority")
    sketch = ops.approx_quantiles(orders, [group], "o_totalprice", shares, 1000)
    sketch = sketch.withColumnRenamed("o_orderpriority", "of")
    placed = orders.join(sketch, orders["o_orderpriority"] == sketch["of"])
    at_most = [F.avg((F.col("o_totalprice") <= F.col(n)).cast("int")).alias(f"_le_{n}") for n in shares]
    below = [F.avg((F.col("o_totalprice") < F.col(n)).cast("int")).alias(f"_lt_{n}") for n in shares]
    ranks = placed.groupBy(group).agg(*at_most, *below)
    within = [
        ((F.col(f"_le_{n}") >= s - 0.002) & (F.col(f"_lt_{n}") <= s + 0.002)).alias(f"{n}_within")
        for n, s in shares.items()
    ]
    return ranks.select("o_orderpriority", *within)


def ranked(spark: SparkSession, root: str) -> DataFrame:
    """Order priorities repeat, so ranks have ties."""
    orders = table(spark, root, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    return ops.ranked(orders, ["o_custkey"], ["o_orderpriority"])


def trailing_range(spark: SparkSession, root: str) -> DataFrame:
    orders = table(spark, root, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return ops.trailing_range(orders, ["o_custkey"], "o_orderdate", "o_totalprice", 90, scale=2)


def totals_of_plain_values(spark: SparkSession, root: str) -> DataFrame:
    """Totals of values with more than two places, which are no money."""
    orders = table(spark, root, "orders").withColumn("share", F.col("o_totalprice") / 7)
    totals = ops.multi_level_totals(orders, ["o_orderstatus"], "share")
    return totals.withColumn("total", F.round("total", 3))


def _flag_sql(flag: str, name: str) -> str:
    quantity = f"CASE WHEN l_returnflag = '{flag}' THEN CAST(l_quantity AS DECIMAL(18,2)) END"
    return f"CAST(sum({quantity}) AS DOUBLE) AS {name}"


_PIVOT_SQL = f"""
    SELECT CAST(year(l_shipdate) AS INTEGER) AS ship_year,
           {", ".join(_flag_sql(f, n) for f, n in RETURN_FLAGS.items())}
    FROM lineitem GROUP BY 1"""

def rolling_distinct(spark: SparkSession, root: str) -> DataFrame:
    """Users of each type of event within the last seven days, day by day."""
    users = ops.rolling_distinct(table(spark, root, "events"), "user_id", "ts", 7, ("event_type",))
    return users.select("event_type", F.col("day").cast("timestamp_ntz").alias("day"), "n_keys")


QUERIES = {
    "star_revenue": Query(
        star_revenue,
        """
        SELECT r_name, n_name, CAST(year(o_orderdate) AS INTEGER) AS order_year,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))
                        * (1 - CAST(l_discount AS DECIMAL(18,2)))) AS DOUBLE) AS revenue,
               count(*) AS n_lines
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
             JOIN customer ON o_custkey = c_custkey
             JOIN nation ON c_nationkey = n_nationkey
             JOIN region ON n_regionkey = r_regionkey
        GROUP BY 1, 2, 3""",
    ),
    "multi_level_totals": Query(
        _totals("cube"), _totals_sql("CUBE (o_orderstatus, o_orderpriority)")
    ),
    "multi_level_totals_rollup": Query(
        _totals("rollup"), _totals_sql("ROLLUP (o_orderstatus, o_orderpriority)")
    ),
    "multi_level_totals_sets": Query(
        _totals("sets", [["o_orderstatus"], ["o_orderpriority"], []]),
        _totals_sql("GROUPING SETS ((o_orderstatus), (o_orderpriority), ())"),
    ),
    "top_n_per_group": Query(
        top_n_per_group,
        """
        SELECT n_name, o_orderkey, o_totalprice,
               CAST(row_number() OVER w AS INTEGER) AS place
        FROM orders JOIN customer ON o_custkey = c_custkey
             JOIN nation ON c_nationkey = n_nationkey
        WINDOW w AS (PARTITION BY n_name ORDER BY o_totalprice DESC, o_orderkey)
        QUALIFY row_number() OVER w <= 3""",
    ),
    "running_and_moving": Query(
        running_and_moving,
        """
        SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2)))
                    OVER (w ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_total,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2)))
                    OVER (w ROWS 2 PRECEDING) AS DOUBLE)
               / count(*) OVER (w ROWS 2 PRECEDING) AS moving_avg
        FROM orders
        WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
    ),
    "period_over_period": Query(
        period_over_period,
        """
        WITH m AS (
            SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS period,
                   CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
            FROM orders GROUP BY 1),
        p AS (SELECT period, total, lag(total) OVER (ORDER BY period) AS previous_total FROM m)
        SELECT period, total, previous_total,
               (total - previous_total) / nullif(previous_total, 0) AS change_ratio
        FROM p""",
    ),
    "pivot_measures": Query(pivot_measures, _PIVOT_SQL),
    "unpivot_measures": Query(
        unpivot_measures,
        f"""
        WITH wide AS ({_PIVOT_SQL})
        SELECT ship_year, 'qty_a' AS measure, qty_a AS qty FROM wide
        UNION ALL SELECT ship_year, 'qty_n', qty_n FROM wide
        UNION ALL SELECT ship_year, 'qty_r', qty_r FROM wide""",
    ),
    "with_and_without": Query(
        with_and_without,
        """
        SELECT o.*, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) AS has_partner
        FROM orders o""",
    ),
    "compare_sets": Query(
        compare_sets,
        """
        WITH a AS (SELECT DISTINCT o_custkey FROM orders WHERE year(o_orderdate) = 1995),
        b AS (SELECT DISTINCT o_custkey FROM orders WHERE year(o_orderdate) = 1996)
        SELECT 'union' AS relation, o_custkey FROM (FROM a UNION FROM b)
        UNION ALL SELECT 'intersection', o_custkey FROM (FROM a INTERSECT FROM b)
        UNION ALL SELECT 'a_only', o_custkey FROM (FROM a EXCEPT FROM b)
        UNION ALL SELECT 'b_only', o_custkey FROM (FROM b EXCEPT FROM a)""",
    ),
    "funnel_conversion": Query(
        funnel_conversion,
        """
        WITH s1 AS (SELECT user_id, min(ts) AS t FROM events WHERE event_type = 'view' GROUP BY 1),
        s2 AS (SELECT e.user_id, min(e.ts) AS t FROM events e JOIN s1 USING (user_id)
               WHERE e.event_type = 'click' AND e.ts > s1.t GROUP BY 1),
        s3 AS (SELECT e.user_id, min(e.ts) AS t FROM events e JOIN s2 USING (user_id)
               WHERE e.event_type = 'purchase' AND e.ts > s2.t GROUP BY 1),
        c AS (SELECT 1 AS step, 'view' AS step_name, count(*) AS n_keys FROM s1
              UNION ALL SELECT 2, 'click', count(*) FROM s2
              UNION ALL SELECT 3, 'purchase', count(*) FROM s3)
        SELECT step, step_name, n_keys,
               CAST(n_keys AS DOUBLE) / nullif(lag(n_keys) OVER (ORDER BY step), 0) AS conversion
        FROM c""",
    ),
    "cohort_retention": Query(
        cohort_retention,
        """
        WITH active AS (
            SELECT DISTINCT o_custkey, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS m
            FROM orders),
        c AS (SELECT o_custkey, m, min(m) OVER (PARTITION BY o_custkey) AS cohort FROM active)
        SELECT cohort, CAST(datediff('month', cohort, m) AS INTEGER) AS month_offset,
               count(DISTINCT o_custkey) AS n_keys
        FROM c GROUP BY 1, 2""",
    ),
    "distribution_stats": Query(
        distribution_stats,
        """
        SELECT o_orderpriority, count(*) AS n,
               round(min(o_totalprice), 2) AS min, round(max(o_totalprice), 2) AS max,
               round(avg(o_totalprice), 2) AS mean,
               round(stddev_samp(o_totalprice), 2) AS stddev,
               round(quantile_cont(o_totalprice, 0.25), 2) AS q1,
               round(quantile_cont(o_totalprice, 0.5), 2) AS median,
               round(quantile_cont(o_totalprice, 0.75), 2) AS q3
        FROM orders GROUP BY 1""",
    ),
    "approx_distinct": Query(
        approx_distinct,
        "SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS order_year, TRUE AS within_bound FROM orders",
    ),
    "sketch_spans": Query(
        sketch_spans,
        """
        SELECT CAST(date_trunc('week', ts) AS TIMESTAMP) AS week, event_type, count(*) AS n_rows,
               TRUE AS n_keys_within, TRUE AS q1_within, TRUE AS median_within, TRUE AS q3_within
        FROM events GROUP BY 1, 2""",
    ),
    "sketch_retention": Query(
        sketch_retention,
        """
        SELECT DISTINCT event_type, TRUE AS n_first_within, TRUE AS n_second_within, TRUE AS n_both_within
        FROM events WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-21'""",
    ),
    "approx_quantiles": Query(
        approx_quantiles,
        """
        SELECT DISTINCT o_orderpriority, TRUE AS q1_within, TRUE AS median_within,
               TRUE AS q3_within
        FROM orders""",
    ),
    "ranked": Query(
        ranked,
        """
        SELECT o_custkey, o_orderkey, o_orderpriority, CAST(rank() OVER w AS INTEGER) AS rank,
               CAST(dense_rank() OVER w AS INTEGER) AS dense_rank
        FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderpriority)""",
    ),
    "trailing_range": Query(
        trailing_range,
        """
        SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, count(*) OVER w AS n_recent,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS DOUBLE) AS recent_total
        FROM orders
        WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate
                     RANGE BETWEEN INTERVAL 7775999 SECOND PRECEDING AND CURRENT ROW)""",
    ),
    "totals_of_plain_values": Query(
        totals_of_plain_values,
        """
        SELECT o_orderstatus, CAST(grouping(o_orderstatus) AS BIGINT) AS level_id,
               count(*) AS n_rows, round(sum(o_totalprice / 7), 3) AS total
        FROM orders GROUP BY ROLLUP (o_orderstatus)""",
    ),
    "rolling_distinct": Query(
        rolling_distinct,
        """
        WITH d AS (SELECT event_type, unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)),
                                             INTERVAL 1 DAY)) AS day
                   FROM events GROUP BY 1)
        SELECT d.event_type, CAST(d.day AS TIMESTAMP) AS day, count(DISTINCT e.user_id) AS n_keys
        FROM d LEFT JOIN events e ON e.event_type = d.event_type
          AND e.ts >= d.day - INTERVAL 6 DAY AND e.ts < d.day + INTERVAL 1 DAY
        GROUP BY 1, 2""",
    ),
}
