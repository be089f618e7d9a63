"""Registered queries on automating data preparation."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.money import total
from millrace.operators import etl as ops
from millrace.plans.registry import Query
from millrace.session import scratch_path
from millrace.sources.tables import TABLES, table

LINE_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def dedupe_latest(spark: SparkSession, root: str) -> DataFrame:
    return ops.dedupe_latest(table(spark, root, "events"), ["user_id"], ["ts", "event_id"])


def incremental_slice(spark: SparkSession, root: str) -> DataFrame:
    return ops.incremental_slice(
        table(spark, root, "orders"), "o_orderdate", datetime(1997, 1, 1), datetime(1998, 1, 1)
    )


def upsert_by_key(spark: SparkSession, root: str) -> DataFrame:
    orders = table(spark, root, "orders")
    target = orders.filter(F.col("o_orderdate") < F.lit("2001-01-01").cast("timestamp_ntz"))
    increment = orders.filter(
        F.col("o_orderdate") >= F.lit("2000-07-01").cast("timestamp_ntz")
    ).withColumn("o_orderstatus", F.lit("X"))
    return ops.upsert_by_key(target, increment, ["o_orderkey"])


def overwrite_partitions(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_path(spark, "orders-by-year")
    orders = table(spark, root, "orders").withColumn("o_year", F.year("o_orderdate"))
    ops.overwrite_partitions(orders, path, ["o_year"])
    corrected = orders.filter("o_year = 1996").withColumn("o_orderstatus", F.lit("X"))
    for _ in range(2):
        ops.overwrite_partitions(corrected, path, ["o_year"])
    stored = spark.read.schema(f"{TABLES['orders']}, o_year int").parquet(path)
    return stored.groupBy("o_year").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.count_if(F.col("o_orderstatus") == "X").alias("n_corrected"),
        total("o_totalprice").cast("double").alias("total"),
    )


def split_rejects(spark: SparkSession, root: str) -> DataFrame:
    lines = table(spark, root, "lineitem").select(*LINE_KEY, "l_quantity", "l_shipdate")
    orders = table(spark, root, "orders").select("o_orderkey", "o_orderdate")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    rules = {
        "ships before order": F.col("l_shipdate") < F.col("o_orderdate"),
        "quantity over 45": F.col("l_quantity") > 45,
    }
    split = ops.split_rejects(joined, rules)
    valid = split.valid.select(*LINE_KEY, F.lit("valid").alias("reason"))
    return valid.unionByName(
        split.rejects.select(*LINE_KEY, F.explode("reasons").alias("reason"))
    )


def new_vs_returning(spark: SparkSession, root: str) -> DataFrame:
    orders = table(spark, root, "orders")
    return ops.new_vs_returning(orders, "o_custkey", "o_orderdate", "o_totalprice", scale=2)


QUERIES = {
    "dedupe_latest": Query(
        dedupe_latest,
        """
        SELECT * FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    ),
    "incremental_slice": Query(
        incremental_slice,
        """
        SELECT * FROM orders
        WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'""",
    ),
    "upsert_by_key": Query(
        upsert_by_key,
        """
        SELECT o_orderkey, o_custkey,
               CASE WHEN o_orderdate >= TIMESTAMP '2000-07-01' THEN 'X' ELSE o_orderstatus END
                   AS o_orderstatus,
               o_totalprice, o_orderdate, o_orderpriority
        FROM orders""",
    ),
    "overwrite_partitions": Query(
        overwrite_partitions,
        """
        SELECT CAST(year(o_orderdate) AS INTEGER) AS o_year, count(*) AS n_orders,
               count(*) FILTER (year(o_orderdate) = 1996) AS n_corrected,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
        FROM orders GROUP BY 1""",
    ),
    "split_rejects": Query(
        split_rejects,
        """
        WITH j AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, 'ships before order' AS reason
        FROM j WHERE l_shipdate < o_orderdate
        UNION ALL
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, 'quantity over 45'
        FROM j WHERE l_quantity > 45
        UNION ALL
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, 'valid'
        FROM j WHERE NOT (l_shipdate < o_orderdate) AND NOT (l_quantity > 45)""",
    ),
    "new_vs_returning": Query(
        new_vs_returning,
        """
        WITH m AS (
            SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS period,
                   sum(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue
            FROM orders GROUP BY 1, 2),
        f AS (SELECT *, min(period) OVER (PARTITION BY o_custkey) AS first_period FROM m)
        SELECT period, count(*) FILTER (period = first_period) AS new_customers,
               count(*) FILTER (period > first_period) AS returning_customers,
               CAST(sum(revenue) AS DOUBLE) AS revenue
        FROM f GROUP BY 1""",
    ),
}
