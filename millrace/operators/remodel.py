"""Revising a warehouse model: lookups, keys, marts and proof that nothing was lost."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import key_text, quote_pattern
from millrace.operators.ordered import MAX_GROUP_ROWS, running_totals
from millrace.session import broadcast_if_small, stage


def extract_lookup(
    df: DataFrame,
    cols: list[str],
    key_name: str,
    max_group_rows: int = MAX_GROUP_ROWS,
    slices: int | None = None,
) -> DataFrame:
    """Distinct tuples without nulls, numbered from 1 in natural order.

    Only the distinct tuples are numbered, in one task while they are few and in
    ranges beyond that.
    """
    values = stage(df.select(*cols).dropna().distinct(), "lookup")
    one = F.lit(1).cast("bigint")
    return running_totals(values, [], cols, {key_name: one}, max_group_rows, slices)


def hash_key(df: DataFrame, cols: list[str], key_name: str) -> DataFrame:
    """Key for large domains: a digest of the tuple, needing no order and no shuffle."""
    return df.withColumn(key_name, F.md5(key_text(cols)))


def replace_with_keys(
    fact: DataFrame, lookup: DataFrame, cols: list[str], key_name: str
) -> DataFrame:
    """``cols`` swapped for the key of ``lookup``, which is unique on them; no match gives -1."""
    joined = fact.join(broadcast_if_small(lookup.select(*cols, key_name)), cols, "left")
    kept = [c for c in fact.columns if c not in cols]
    key = F.coalesce(F.col(key_name), F.lit(-1)).cast("bigint").alias(key_name)
    return joined.select(*kept, key)


def split_delimited(df: DataFrame, col: str, delimiter: str, names: tuple[str, str]) -> DataFrame:
    """Split at the first delimiter only; a missing second part is null."""
    parts = F.split(F.col(col), quote_pattern(delimiter), 2)
    return df.withColumns({name: F.get(parts, F.lit(i)) for i, name in enumerate(names)})


def star_mart(fact: DataFrame, dims: list[tuple[DataFrame, dict[str, str]]]) -> DataFrame:
    """One row per fact row with the attributes of each dimension joined on.

    Each entry is (dimension unique on its key, {fact column: dimension key}).
    Which dimension is broadcast is left to Spark, which compares its size with
    ``spark.sql.autoBroadcastJoinThreshold``.
    """
    mart = fact
    for dim, on in dims:
        same = reduce(lambda a, b: a & b, [F.col(f) == F.col(d) for f, d in on.items()])
        mart = mart.join(dim, same, "left").drop(*[d for d in on.values()])
    return mart


def reconcile_models(old: DataFrame, new: DataFrame) -> DataFrame:
    """(side, n_rows): rows only in ``old`` and only in ``new``, copies counted.

    Both tables go through one aggregation, so equal rows meet before the shuffle.
    """
    sign = "_sign"
    both = old.withColumn(sign, F.lit(1)).unionByName(new.withColumn(sign, F.lit(-1)))
    surplus = both.groupBy(*old.columns).agg(F.sum(sign).alias(sign))
    counts = surplus.agg(
        _positive_sum(F.col(sign)).alias("old_only"),
        _positive_sum(-F.col(sign)).alias("new_only"),
    )
    return counts.unpivot([], ["old_only", "new_only"], "side", "n_rows")


def _positive_sum(col: Column) -> Column:
    return F.coalesce(F.sum(F.greatest(col, F.lit(0))), F.lit(0)).cast("bigint")
