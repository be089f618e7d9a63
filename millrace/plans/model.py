"""Registered queries on bringing a data model up to date."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from millrace.operators import discovery
from millrace.operators import model as ops
from millrace.operators.remodel import extract_lookup, replace_with_keys
from millrace.plans.registry import Query
from millrace.sources.tables import TABLES, table

ORDER_MODEL = StructType(
    [
        StructField("order_id", LongType(), nullable=False),
        StructField("customer_id", LongType(), nullable=False),
        StructField("status", StringType()),
        StructField("total", DoubleType()),
        StructField("order_date", StringType()),
        StructField("priority", IntegerType()),
    ]
)


def _rules() -> list[ops.Rule]:
    return [
        ops.UniqueKey("line key is unique", "lineitem", ("l_orderkey", "l_linenumber")),
        ops.UniqueKey("order key is unique", "orders", ("o_orderkey",)),
        ops.ForeignKey("line has an order", "lineitem", ("l_orderkey",), "orders", ("o_orderkey",)),
        ops.ForeignKey("line has a part", "lineitem", ("l_partkey",), "part", ("p_partkey",)),
        ops.ForeignKey("order has lines", "orders", ("o_orderkey",), "lineitem", ("l_orderkey",)),
        ops.Domain("quantity is 1 to 50", "lineitem", F.col("l_quantity").between(1, 50)),
        ops.Domain("discount below 5 percent", "lineitem", F.col("l_discount") < 0.05),
        ops.Domain("status is known", "orders", F.col("o_orderstatus").isin("F", "O", "P")),
        ops.CrossTable(
            "shipped after ordered",
            "lineitem",
            ("l_orderkey",),
            "orders",
            ("o_orderkey",),
            F.col("l_shipdate") >= F.col("o_orderdate"),
        ),
    ]


def conform_schema(spark: SparkSession, root: str) -> DataFrame:
    mapping = {
        "order_id": F.col("o_orderkey"),
        "customer_id": F.col("o_custkey"),
        "status": F.col("o_orderstatus"),
        "total": F.col("o_totalprice"),
        "order_date": F.col("o_orderdate").cast("date"),
        "priority": F.substring("o_orderpriority", 1, 1),
    }
    return ops.conform_schema(table(spark, root, "orders"), ORDER_MODEL, mapping)


def compat_view(spark: SparkSession, root: str) -> DataFrame:
    customer = table(spark, root, "customer")
    segments = extract_lookup(customer, ["c_mktsegment"], "segment_key")
    core = replace_with_keys(customer, segments, ["c_mktsegment"], "segment_key")
    return ops.compat_view(core, {"segment_key": segments}, customer.columns)


def profile_columns(spark: SparkSession, root: str) -> DataFrame:
    return ops.profile_columns(table(spark, root, "orders"))


def check_constraints(spark: SparkSession, root: str) -> DataFrame:
    names = ("lineitem", "orders", "part")
    return ops.check_constraints({n: table(spark, root, n) for n in names}, _rules())


#: Columns that find_references compares, and the size of the sets of find_dependencies.
REFERENCE_COLUMNS = [
    ("region", "r_regionkey"), ("nation", "n_nationkey"), ("nation", "n_regionkey"), ("nation", "n_name"),
    ("customer", "c_custkey"), ("customer", "c_nationkey"), ("customer", "c_mktsegment"),
    ("supplier", "s_suppkey"), ("supplier", "s_nationkey"), ("part", "p_partkey"), ("part", "p_size"),
    ("orders", "o_orderkey"), ("orders", "o_custkey"), ("orders", "o_orderstatus"),
    ("lineitem", "l_orderkey"), ("lineitem", "l_partkey"), ("lineitem", "l_suppkey"),
    ("lineitem", "l_linenumber"), ("lineitem", "l_linestatus"), ("events", "event_id"), ("events", "user_id"),
]
SET_COLUMNS = 3


def find_references(spark: SparkSession, root: str) -> DataFrame:
    names = {name for name, _ in REFERENCE_COLUMNS}
    return discovery.inclusions({n: table(spark, root, n) for n in names}, REFERENCE_COLUMNS)


def find_dependencies(spark: SparkSession, root: str) -> DataFrame:
    def of(name: str) -> DataFrame:
        found = discovery.dependencies(table(spark, root, name), SET_COLUMNS)
        return found.select(F.lit(name).alias("table_name"), "*")

    return of("orders").unionByName(of("lineitem"))


def _references_sql() -> str:
    values = "\nUNION ALL\n".join(
        f"SELECT DISTINCT '{t}.{c}' AS c, typeof({c}) = 'VARCHAR' AS is_text, CAST({c} AS VARCHAR) AS v FROM {t}"
        for t, c in REFERENCE_COLUMNS
    )
    return f"""
        WITH v AS ({values}), n AS (SELECT c, count(*) AS n FROM v GROUP BY c)
        SELECT a.c AS child, b.c AS parent, any_value(n.n) AS child_values, count(*) AS shared_values
        FROM v a JOIN v b ON a.v = b.v AND a.is_text = b.is_text AND a.c <> b.c JOIN n ON n.c = a.c
        GROUP BY 1, 2 HAVING count(*) = any_value(n.n)"""


def _dependencies_sql(name: str) -> str:
    """Every set of columns counted, as a bit mask; then what is minimal among them."""
    columns = [part.split()[0] for part in TABLES[name].split(", ")]
    sets = [s for k in range(1, SET_COLUMNS + 1) for s in combinations(range(len(columns)), k)]
    masks = ", ".join(str(sum(1 << i for i in s)) for s in sets)
    counts = ", ".join(f"count(DISTINCT row({', '.join(columns[i] for i in s)}))" for s in sets)

    def text(mask: str) -> str:
        return f"concat_ws(',', {', '.join(f"CASE WHEN {mask} & {1 << i} > 0 THEN '{c}' END" for i, c in enumerate(columns))})"

    bits = ", ".join(f"({1 << i}, '{c}')" for i, c in enumerate(columns))
    return f"""
        WITH s AS MATERIALIZED (SELECT unnest([0, {masks}]) AS m, unnest([1, {counts}]) AS n FROM {name}),
        k AS (SELECT m FROM s WHERE n = (SELECT count(*) FROM {name})),
        d AS (SELECT x.m, b.bit, b.name FROM s x, (VALUES {bits}) b(bit, name), s z
              WHERE x.m & b.bit = 0 AND z.m = x.m | b.bit AND z.n = x.n)
        SELECT '{name}' AS table_name, 'key' AS kind, {text('k.m')} AS determinant, NULL::VARCHAR AS dependent
        FROM k WHERE NOT EXISTS (FROM k o WHERE o.m <> k.m AND o.m & k.m = o.m)
        UNION ALL
        SELECT '{name}', 'dependency', {text('d.m')}, d.name
        FROM d WHERE NOT EXISTS (FROM k WHERE k.m & d.m = k.m)
          AND NOT EXISTS (FROM d o WHERE o.bit = d.bit AND o.m <> d.m AND o.m & d.m = o.m)"""


def _profile_sql() -> str:
    columns = [part.split()[0] for part in TABLES["orders"].split(", ")]
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, "
        f"count(*) - count({c}) AS null_count, count(DISTINCT {c}) AS distinct_count FROM orders"
        for c in columns
    )


QUERIES = {
    "conform_schema": Query(
        conform_schema,
        """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
               o_totalprice AS total, strftime(o_orderdate, '%Y-%m-%d') AS order_date,
               CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority
        FROM orders""",
    ),
    "compat_view": Query(compat_view, "SELECT * FROM customer"),
    "profile_columns": Query(profile_columns, _profile_sql()),
    "find_references": Query(find_references, _references_sql()),
    "find_dependencies": Query(
        find_dependencies, f"({_dependencies_sql('orders')}) UNION ALL ({_dependencies_sql('lineitem')})"
    ),
    "check_constraints": Query(
        check_constraints,
        """
        SELECT 'line key is unique' AS rule, count(*) AS checked,
               count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS violations FROM lineitem
        UNION ALL SELECT 'order key is unique', count(*), count(*) - count(DISTINCT o_orderkey)
        FROM orders
        UNION ALL SELECT 'line has an order', count(*),
               count(*) FILTER (l_orderkey NOT IN (SELECT o_orderkey FROM orders)) FROM lineitem
        UNION ALL SELECT 'line has a part', count(*),
               count(*) FILTER (l_partkey NOT IN (SELECT p_partkey FROM part)) FROM lineitem
        UNION ALL SELECT 'order has lines', count(*),
               count(*) FILTER (o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) FROM orders
        UNION ALL SELECT 'quantity is 1 to 50', count(*),
               count(*) FILTER (NOT (l_quantity BETWEEN 1 AND 50)) FROM lineitem
        UNION ALL SELECT 'discount below 5 percent', count(*),
               count(*) FILTER (NOT (l_discount < CAST(0.05 AS DOUBLE))) FROM lineitem
        UNION ALL SELECT 'status is known', count(*),
               count(*) FILTER (o_orderstatus NOT IN ('F', 'O', 'P')) FROM orders
        UNION ALL SELECT 'shipped after ordered', count(*),
               count(*) FILTER (l_shipdate < o_orderdate)
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    ),
}
