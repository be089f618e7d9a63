"""Registered queries on revising a warehouse model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import remodel as ops
from millrace.operators.model import compat_view
from millrace.plans.registry import Query
from millrace.sources.tables import table

PRIORITY = ["o_orderpriority"]


def _priorities(orders: DataFrame) -> DataFrame:
    return ops.extract_lookup(orders, PRIORITY, "priority_key")


def extract_lookup(spark: SparkSession, root: str) -> DataFrame:
    return _priorities(table(spark, root, "orders"))


def hash_key(spark: SparkSession, root: str) -> DataFrame:
    return ops.hash_key(table(spark, root, "customer"), ["c_name", "c_nationkey"], "customer_key")


def replace_with_keys(spark: SparkSession, root: str) -> DataFrame:
    orders = table(spark, root, "orders")
    return ops.replace_with_keys(orders, _priorities(orders), PRIORITY, "priority_key")


def split_delimited(spark: SparkSession, root: str) -> DataFrame:
    orders = table(spark, root, "orders").select("o_orderkey", "o_orderpriority")
    return ops.split_delimited(orders, "o_orderpriority", "-", ("priority_code", "priority_name"))


def star_mart(spark: SparkSession, root: str) -> DataFrame:
    # The small dimensions go onto the customer first, so that orders are joined once.
    places = ops.star_mart(
        table(spark, root, "customer"),
        [
            (table(spark, root, "nation"), {"c_nationkey": "n_nationkey"}),
            (table(spark, root, "region"), {"n_regionkey": "r_regionkey"}),
        ],
    )
    return ops.star_mart(table(spark, root, "orders"), [(places, {"o_custkey": "c_custkey"})])


def reconcile_models(spark: SparkSession, root: str) -> DataFrame:
    orders = table(spark, root, "orders")
    lookup = _priorities(orders)
    core = ops.replace_with_keys(orders, lookup, PRIORITY, "priority_key")
    rebuilt = compat_view(core, {"priority_key": lookup}, orders.columns)
    status = F.when(F.col("o_orderstatus") == "P", "X").otherwise(F.col("o_orderstatus"))
    altered = orders.withColumn("o_orderstatus", status)
    named = {"rebuilt": rebuilt, "altered": altered}
    reports = [
        ops.reconcile_models(orders, df).select(F.lit(name).alias("compared"), "side", "n_rows")
        for name, df in named.items()
    ]
    return reports[0].unionByName(reports[1])


QUERIES = {
    "extract_lookup": Query(
        extract_lookup,
        """
        SELECT o_orderpriority, row_number() OVER (ORDER BY o_orderpriority) AS priority_key
        FROM (SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority IS NOT NULL)""",
    ),
    "hash_key": Query(
        hash_key,
        """
        SELECT *, md5(concat_ws('|',
                   coalesce(length(c_name) || ':' || c_name, '-'),
                   coalesce(length(CAST(c_nationkey AS VARCHAR)) || ':' || c_nationkey, '-')))
                   AS customer_key
        FROM customer""",
    ),
    "replace_with_keys": Query(
        replace_with_keys,
        """
        WITH lookup AS (
            SELECT o_orderpriority, row_number() OVER (ORDER BY o_orderpriority) AS priority_key
            FROM (SELECT DISTINCT o_orderpriority FROM orders))
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
               coalesce(priority_key, -1) AS priority_key
        FROM orders LEFT JOIN lookup USING (o_orderpriority)""",
    ),
    "split_delimited": Query(
        split_delimited,
        """
        SELECT o_orderkey, o_orderpriority,
               split_part(o_orderpriority, '-', 1) AS priority_code,
               CASE WHEN strpos(o_orderpriority, '-') > 0
                    THEN substr(o_orderpriority, strpos(o_orderpriority, '-') + 1) END
                   AS priority_name
        FROM orders""",
    ),
    "star_mart": Query(
        star_mart,
        """
        SELECT o.*, c_name, c_nationkey, c_acctbal, c_mktsegment, n_name, n_regionkey, r_name
        FROM orders o LEFT JOIN customer ON o_custkey = c_custkey
             LEFT JOIN nation ON c_nationkey = n_nationkey
             LEFT JOIN region ON n_regionkey = r_regionkey""",
    ),
    "reconcile_models": Query(
        reconcile_models,
        """
        WITH altered AS (
            SELECT * REPLACE (CASE WHEN o_orderstatus = 'P' THEN 'X' ELSE o_orderstatus END
                              AS o_orderstatus) FROM orders)
        SELECT 'rebuilt' AS compared, 'old_only' AS side, CAST(0 AS BIGINT) AS n_rows
        UNION ALL SELECT 'rebuilt', 'new_only', 0
        UNION ALL SELECT 'altered', 'old_only',
                         (SELECT count(*) FROM (FROM orders EXCEPT ALL FROM altered))
        UNION ALL SELECT 'altered', 'new_only',
                         (SELECT count(*) FROM (FROM altered EXCEPT ALL FROM orders))""",
    ),
}
