"""Joins of intervals that share no key.

Two intervals overlap where the later start lies within the other interval. So the join is two
joins of points (the starts of one side) with intervals (of the other), which have no pair in
common. The line is cut into slices of about as many points; a point belongs to one slice, an
interval goes to all that it crosses, and a slice reports the pairs of its points. Within
a slice the points are sorted and each interval takes a run of them, so work follows the
number of pairs found. Slices with many points at one place, or many long intervals, are cut into
blocks, and every block of points meets every block of intervals.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from millrace.session import stage

#: Points, and intervals, that a task holds at once.
BLOCK_ROWS = 2048


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Pairs of rows whose spans share a point, ends included: columns of both sides.

    A span names two bigint columns, begin and end (times as microseconds, say). The sides have no
    column name in common. A row with a null in its span, or whose end comes before its begin, meets
    none. Repeated rows pair as often as they stand there.
    """
    shared = {c.lower() for c in left.columns} & {c.lower() for c in right.columns}
    if shared:
        raise ValueError(f"both sides have {sorted(shared)}")
    left, right = (_numbered(df, *span) for df, span in ((left, left_span), (right, right_span)))
    later_left = points_in_intervals(left, left_span[0], right, right_span, True, block_rows)
    later_right = points_in_intervals(right, right_span[0], left, left_span, False, block_rows)
    columns = [c for c in (*left.columns, *right.columns) if c != "_row"]
    return later_left.select(columns).unionByName(later_right.select(columns))


def points_in_intervals(
    points: DataFrame, at: str, intervals: DataFrame, span: tuple[str, str], from_begin: bool, block_rows: int
) -> DataFrame:
    """Pairs of a point and an interval that it lies in; at its begin too if ``from_begin``.

    Both are stored tables with a column ``_row`` that numbers their rows.
    """
    bounds = _bounds(points, at, block_rows)
    slice_of = _slice_of(bounds)
    begin, end = span
    placed = points.withColumn("_slice", slice_of(F.col(at)))
    crossing = intervals.withColumn(
        "_slice", F.explode(F.sequence(slice_of(F.col(begin)), slice_of(F.col(end))))
    )
    # How many blocks of each kind a slice has: one row a slice.
    sizes = (
        placed.select("_slice", F.lit(1).alias("p"), F.lit(0).alias("i"))
        .unionByName(crossing.select("_slice", F.lit(0).alias("p"), F.lit(1).alias("i")))
        .groupBy("_slice")
        .agg(*[F.ceil(F.sum(c) / block_rows).cast("int").alias(f"_{c}_blocks") for c in ("p", "i")])
        .filter("_p_blocks > 0 and _i_blocks > 0")
    )
    sizes = F.broadcast(stage(sizes, "slice-sizes"))  # bounded by the number of slices

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        """A row goes to one block of its kind and meets all blocks of the other."""
        return (
            df.join(sizes, "_slice")
            .withColumn(own, F.pmod("_row", F.col(f"{own}_blocks")).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)))
            .drop("_p_blocks", "_i_blocks", "_row")
        )

    keys = ["_slice", "_p", "_i"]
    group = dealt(placed, "_p", "_i").groupBy(*keys), dealt(crossing, "_i", "_p").groupBy(*keys)
    names = [c for df in (points, intervals) for c in df.columns if c != "_row"]
    kinds = {f.name: f for df in (points, intervals) for f in df.schema}
    schema = StructType([StructField(n, kinds[n].dataType) for n in names])
    return group[0].cogroup(group[1]).applyInArrow(_matched(at, begin, end, from_begin, names), schema)


def _numbered(df: DataFrame, begin: str, end: str) -> DataFrame:
    usable = df.filter(F.col(begin) <= F.col(end))  # and none is null
    return stage(usable.withColumn("_row", F.monotonically_increasing_id()), "intervals")


def _bounds(points: DataFrame, at: str, block_rows: int) -> np.ndarray:
    """Places that cut the points into slices of about half a block; one number per slice."""
    slices = -(-2 * points.count() // block_rows)
    if slices <= 1:
        return np.empty(0, np.int64)
    shares = [k / slices for k in range(1, slices)]
    found = points.agg(F.percentile_approx(at, shares, 10 * slices)).first()[0]
    return np.unique(np.array(found, np.int64))


def _slice_of(bounds: np.ndarray) -> Callable:
    @F.pandas_udf("int")
    def slice_of(place: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, place.to_numpy(np.int64), "right").astype(np.int32))

    return slice_of


def _matched(at: str, begin: str, end: str, from_begin: bool, names: list[str]) -> Callable:
    def run(points: pa.Table, intervals: pa.Table) -> pa.Table:
        points = points.take(pc.sort_indices(points, [(at, "ascending")]))
        places = points.column(at).to_numpy()
        first = np.searchsorted(places, intervals.column(begin).to_numpy(), "left" if from_begin else "right")
        stop = np.searchsorted(places, intervals.column(end).to_numpy(), "right")
        runs = np.maximum(stop - first, 0)
        # Of the k-th interval the points first[k] to stop[k].
        which = np.repeat(np.arange(len(runs)), runs)
        point = np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs) + np.repeat(first, runs)
        taken = {n: points.column(n).take(pa.array(point)) for n in points.column_names if n in names}
        taken |= {n: intervals.column(n).take(pa.array(which)) for n in intervals.column_names if n in names}
        return pa.table({n: taken[n] for n in names})

    return run
