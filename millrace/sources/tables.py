"""The input tables and their declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}


def table_path(root: str, name: str) -> str:
    return f"{str(root).rstrip('/')}/{name}.parquet"


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Batch read of one table; nothing is inferred."""
    return spark.read.schema(TABLES[name]).parquet(table_path(root, name))


#: Files that a micro-batch takes.
MAX_FILES = 1000


def table_stream(
    spark: SparkSession, root: str, name: str, max_files_per_trigger: int = MAX_FILES
) -> DataFrame:
    """The same table as a file stream.

    A micro-batch takes at most ``max_files_per_trigger`` files, so that a backlog is worked
    off in several, in the order of the files' age. The path is written as a pattern because a file stream takes a
    single file only through one; it matches a folder of files just as well.
    """
    pattern = table_path(root, f"{{{name}}}")
    reader = spark.readStream.schema(TABLES[name])
    return reader.option("maxFilesPerTrigger", max_files_per_trigger).parquet(pattern)
