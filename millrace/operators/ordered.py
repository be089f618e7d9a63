"""Ordered work inside groups, for groups of any size.

A window sends each group to one task. That is right for ordinary groups and
wrong for a group holding a large part of the table. The functions here count
the groups first: ordinary ones take the plain window, larger ones are cut into
ranges of their order, solved range by range, and joined up by a small table
that has one row per range.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import stage

MAX_GROUP_ROWS = 2_000_000
SLICE = "_slice"
IS_LARGE = "_is_large"


def by_group_size(
    df: DataFrame,
    keys: list[str],
    whole: Callable[[DataFrame], DataFrame],
    sliced: Callable[[DataFrame], DataFrame],
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Run ``whole`` on groups of up to ``max_group_rows`` rows, ``sliced`` on the others.

    Both must return the same columns. The list of large groups has at most
    ``rows / max_group_rows`` entries, so it is safe to broadcast. ``df`` is computed twice, to
    count and to work: if there are large groups, both kinds are stored apart in one pass.
    """
    if not keys:
        return whole(df) if df.count() <= max_group_rows else sliced(df)
    large = df.groupBy(*keys).count().filter(F.col("count") > max_group_rows)
    renamed = {name: f"_large_{i}" for i, name in enumerate(keys)}
    large = stage(large.select(*[F.col(k).alias(r) for k, r in renamed.items()]), "large-groups")
    if large.isEmpty():
        return whole(df)
    marked = F.broadcast(large.withColumn(IS_LARGE, F.lit(True)))
    told = df.join(marked, _all_equal(renamed), "left").withColumn(IS_LARGE, F.coalesce(IS_LARGE, F.lit(False)))
    kinds = stage(told.select(*df.columns, IS_LARGE), "by-group-size", (IS_LARGE,))
    usual, split = (kinds.filter(F.col(IS_LARGE) == kind).select(*df.columns) for kind in (False, True))
    return whole(usual).unionByName(sliced(split))


def slice_groups(
    df: DataFrame, keys: list[str], order: list[str], slices: int | None = None
) -> DataFrame:
    """Add ``_slice``: contiguous ranges of (keys, order), numbered in order.

    Rows equal in all of these are told apart by the task that read them, so
    that many equal rows still spread over several slices. The result is stored,
    because range bounds come from a sample and must not differ between the two
    passes that use them.
    """
    bounds = [F.col(c) for c in [*keys, *order, "_reader"]]
    read = df.withColumn("_reader", F.spark_partition_id())
    ranged = (
        read.repartitionByRange(slices, *bounds) if slices else read.repartitionByRange(*bounds)
    )
    return stage(ranged.drop("_reader").withColumn(SLICE, F.spark_partition_id()), "slices")


def attach(cut: DataFrame, keys: list[str], per_slice: DataFrame, names: list[str]) -> DataFrame:
    """Left join columns of a per-(keys, slice) table onto the rows of ``cut``.

    ``per_slice`` must hold only groups that cross a slice boundary, or groups
    too large for one task. Slices are contiguous, so both kinds have few rows
    per slice and the broadcast is bounded by the number of slices.
    """
    renamed = {name: f"_at_{i}" for i, name in enumerate([*keys, SLICE])}
    small = per_slice.select(*[F.col(k).alias(r) for k, r in renamed.items()], *names)
    return cut.join(F.broadcast(small), _all_equal(renamed), "left").drop(*renamed.values())


def running_totals(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    totals: dict[str, Column],
    max_group_rows: int = MAX_GROUP_ROWS,
    slices: int | None = None,
) -> DataFrame:
    """Add one running sum per entry of ``totals``, within ``keys`` along ``order``.

    ``order`` must be a full tie-break within a group.
    """
    to_here = (Window.unboundedPreceding, Window.currentRow)

    def whole(part: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*to_here)
        return part.select("*", *[F.sum(v).over(w).alias(n) for n, v in totals.items()])

    types = {f.name: f.dataType for f in whole(df).schema if f.name in totals}

    def sliced(part: DataFrame) -> DataFrame:
        cut = slice_groups(part, keys, order, slices)
        before = {n: f"_before_{n}" for n in totals}
        per_slice = sums_before_slice(cut, keys, {before[n]: v for n, v in totals.items()})
        w = Window.partitionBy(*keys, SLICE).orderBy(*order).rowsBetween(*to_here)
        local = cut.select("*", *[F.sum(v).over(w).alias(n) for n, v in totals.items()])
        joined = attach(local, keys, per_slice, list(before.values()))
        return joined.select(
            *part.columns,
            *[
                F.when(F.col(b).isNull(), F.col(n))
                .when(F.col(n).isNull(), F.col(b))
                .otherwise(F.col(n) + F.col(b))
                .cast(types[n])
                .alias(n)
                for n, b in before.items()
            ],
        )

    return by_group_size(df, keys, whole, sliced, max_group_rows)


def sums_before_slice(
    cut: DataFrame, keys: list[str], totals: dict[str, Column]
) -> DataFrame:
    """Per (keys, slice) but the first of each group: the sums over all earlier slices."""
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    position = Window.partitionBy(*keys).orderBy(SLICE)
    return (
        cut.groupBy(*keys, SLICE)
        .agg(*[F.sum(v).alias(n) for n, v in totals.items()])
        .select(
            *keys,
            SLICE,
            F.row_number().over(position).alias("_nth"),
            *[F.sum(n).over(earlier).alias(n) for n in totals],
        )
        .filter(F.col("_nth") > 1)
    )


def last_before_slice(
    cut: DataFrame, keys: list[str], value: Column, rank: Column, name: str
) -> DataFrame:
    """Per (keys, slice): the ``value`` of greatest non-null ``rank`` in all earlier slices."""
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    return (
        cut.groupBy(*keys, SLICE)
        .agg(F.max_by(value, rank).alias("_last"))
        .select(*keys, SLICE, F.last("_last", ignorenulls=True).over(earlier).alias(name))
        .filter(F.col(name).isNotNull())
    )


def _all_equal(pairs: dict[str, str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in pairs.items()])
