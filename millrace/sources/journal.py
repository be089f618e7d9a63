"""Rewriting partitions of a table so that a run that is cut off can be finished.

An overwrite of several partitions is not one step: a job that is lost on the way leaves some
of them new, some old and one perhaps missing. So the new rows, and the partitions that they
replace, are first written to an entry of a journal beside the table. A mark makes the entry
count; from then on the rewrite can be repeated until it is done, by whoever comes next.
Entries without a mark have changed nothing and are removed. A table has one writer at a time.
"""

from __future__ import annotations

import time
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.etl import overwrite_partitions
from millrace.session import path_exists, remove_path

READY, APPLIED = "READY", "APPLIED"


def in_partitions(df: DataFrame, chosen: DataFrame, parts: list[str], how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` whose ``parts`` are among those of ``chosen``; null is a value."""
    names = chosen.select(*[F.col(c).alias(f"_in_{c}") for c in parts]).distinct()
    same: Column = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_in_{c}")) for c in parts])
    return df.join(names, same, how)


def log(journal: str, rows: DataFrame, touched: DataFrame) -> str:
    """Write down that ``rows`` shall be all there is in the ``touched`` partitions; returns the entry."""
    entry = f"{journal}/{time.time_ns():020d}-{uuid.uuid4().hex}"
    rows.write.parquet(f"{entry}/rows")
    touched.distinct().write.parquet(f"{entry}/touched")
    mark(rows.sparkSession, entry, READY)
    return entry


def entries(spark: SparkSession, journal: str) -> list[str]:
    """Entries that count, oldest first."""
    if not path_exists(spark, journal):
        return []
    folder = spark._jvm.org.apache.hadoop.fs.Path(journal)
    listed = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    found = sorted(f"{journal}/{status.getPath().getName()}" for status in listed)
    for entry in found:
        if not path_exists(spark, f"{entry}/{READY}"):
            remove_path(spark, entry)
    return [entry for entry in found if path_exists(spark, entry)]


def finish(spark: SparkSession, journal: str, path: str, schema: str, parts: list[str]) -> None:
    """Carry out the entries that are not, oldest first."""
    for entry in entries(spark, journal):
        if path_exists(spark, f"{entry}/{APPLIED}"):
            continue
        rows = spark.read.schema(schema).parquet(f"{entry}/rows")
        overwrite_partitions(rows, path, parts)
        _drop_emptied(spark, path, schema, touched(spark, [entry], schema, parts), rows, parts)
        mark(spark, entry, APPLIED)


def touched(spark: SparkSession, found: list[str], schema: str, parts: list[str]) -> DataFrame:
    """The partitions that entries touch."""
    kinds = spark.createDataFrame([], schema).select(*parts).schema
    return spark.read.schema(kinds).parquet(*[f"{entry}/touched" for entry in found])


def forget(spark: SparkSession, entry: str) -> None:
    """Remove an entry; without its mark it no longer counts, however much of it is left."""
    remove_path(spark, f"{entry}/{READY}")
    remove_path(spark, entry)


def mark(spark: SparkSession, entry: str, name: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{entry}/{name}")
    where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where).close()


def _drop_emptied(
    spark: SparkSession, path: str, schema: str, chosen: DataFrame, written: DataFrame, parts: list[str]
) -> None:
    """Remove chosen partitions that got no row; an overwrite by partition leaves them standing."""
    emptied = in_partitions(chosen, written.select(*parts), parts, "left_anti")
    if not path_exists(spark, path) or emptied.isEmpty():
        return
    stored = spark.read.schema(schema).parquet(path).withColumn("_file", F.col("_metadata.file_path"))
    folder = F.regexp_extract("_file", "^(.*)/[^/]*$", 1)
    gone = in_partitions(stored, emptied, parts).select(folder.alias("folder")).distinct()
    for row in gone.toLocalIterator():  # one per emptied partition
        remove_path(spark, row["folder"])
