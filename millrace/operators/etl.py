"""Rerun-safe data preparation."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.money import total
from millrace.functions.text import truncate_to
from millrace.session import stage


def dedupe_latest(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """One row per key: the greatest order tuple, which the caller makes a full tie-break.

    The filter on the row number reaches below the shuffle, so a task passes on
    at most one row per key.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order_cols])
    return df.withColumn("_nth", F.row_number().over(newest)).filter("_nth = 1").drop("_nth")


def incremental_slice(df: DataFrame, col: str, lo: object, hi: object) -> DataFrame:
    """Rows of the half-open range ``[lo, hi)``.

    The bounds take the column's type, so that the scan can use them.
    """
    kind = df.schema[col].dataType
    return df.filter(
        (F.col(col) >= F.lit(lo).cast(kind)) & (F.col(col) < F.lit(hi).cast(kind))
    )


def upsert_by_key(target: DataFrame, increment: DataFrame, keys: list[str]) -> DataFrame:
    """``increment`` replaces ``target`` on a key match and is added otherwise.

    A null in a key matches a null, so a rerun changes nothing. The increment is stored first and
    computed once.
    """
    increment = stage(increment.select(*target.columns), "increment")
    repeated = increment.groupBy(*keys).count().filter(F.col("count") > 1)
    if not repeated.isEmpty():
        raise ValueError(f"the increment repeats a key: {keys}")
    renamed = {k: f"_new_{k}" for k in keys}
    new = increment.select(*[F.col(k).alias(r) for k, r in renamed.items()])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(r)) for k, r in renamed.items()])
    return target.join(new, same, "left_anti").unionByName(increment)


def overwrite_partitions(df: DataFrame, path: str, partition_cols: list[str]) -> None:
    """Rewrite only the partitions present in ``df``; a second run changes nothing.

    The rebalance puts each partition into few files and still splits a large
    one over several tasks.
    """
    (
        df.hint("rebalance", *partition_cols)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols)
        .parquet(path)
    )


class Split(NamedTuple):
    valid: DataFrame
    rejects: DataFrame


def tag_rejects(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Add ``reasons``: names of the rules whose reject condition holds, in rule order."""
    hits = F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()])
    return df.withColumn("reasons", F.filter(hits, lambda r: r.isNotNull()))


def split_rejects(df: DataFrame, rules: dict[str, Column]) -> Split:
    """Rows that break no rule, and rows that break some, with all their reasons.

    ``df`` is computed once and stored in two parts, so that using both results
    does not repeat the work behind it.
    """
    flag = "_is_valid"
    tagged = tag_rejects(df, rules).withColumn(flag, F.size("reasons") == 0)
    stored = stage(tagged, "split", (flag,))
    return Split(
        stored.filter(F.col(flag)).drop("reasons", flag), stored.filter(~F.col(flag)).drop(flag)
    )


def new_vs_returning(
    orders: DataFrame,
    customer: str,
    date: str,
    value: str,
    unit: str = "month",
    scale: int | None = None,
) -> DataFrame:
    """(period, new_customers, returning_customers, revenue).

    ``scale`` is 2 for money and else None. Orders shrink to one row per customer and period before any window runs.
    """
    per_period = orders.groupBy(
        F.col(customer), truncate_to(unit, date).alias("period")
    ).agg(total(value, scale=scale).alias("revenue"))
    first = F.min("period").over(Window.partitionBy(customer))
    is_new = F.col("period") == F.col("first_period")
    return (
        per_period.withColumn("first_period", first)
        .groupBy("period")
        .agg(
            F.count_if(is_new).alias("new_customers"),
            F.count_if(~is_new).alias("returning_customers"),
            F.sum("revenue").cast("double").alias("revenue"),
        )
    )
