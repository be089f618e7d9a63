"""A warehouse fed by several sources: union, precedence, reconciliation, history."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.ordered import (
    MAX_GROUP_ROWS,
    SLICE,
    attach,
    by_group_size,
    last_before_slice,
    slice_groups,
)


def union_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """All rows of all sources, columns matched by name, tagged with ``source``."""
    tagged = [df.withColumn("source", F.lit(name)) for name, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def resolve_by_precedence(
    df: DataFrame, key: str, source_rank: dict[str, int], tie_break: list[str]
) -> DataFrame:
    """One row per key; each attribute is its first non-null value in source order.

    ``tie_break`` orders rows of the same source. Sources that ``source_rank``
    does not name come last.
    """
    rank = F.lit(len(source_rank))
    for source, place in source_rank.items():
        rank = F.when(F.col("source") == source, F.lit(place)).otherwise(rank)
    place = F.struct(rank.alias("rank"), *[F.col(c) for c in tie_break])
    attributes = [c for c in df.columns if c not in (key, "source")]
    return df.groupBy(key).agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), place)).alias(c) for c in attributes]
    )


def reconcile_sources(
    left: DataFrame, right: DataFrame, keys: list[str], measures: list[str]
) -> DataFrame:
    """Keys of either side with ``status``: matched, left_only, right_only or differs.

    Measures are compared null-safe and come back as ``left_*`` and ``right_*``.
    A key repeated within one side fails the job. Both sides go through a single
    aggregation, so repeated keys meet before the shuffle.
    """
    side = "_side"
    both = (
        left.select(*keys, *measures)
        .withColumn(side, F.lit("left"))
        .unionByName(right.select(*keys, *measures).withColumn(side, F.lit("right")))
    )
    row = F.struct(*measures)
    grouped = both.groupBy(*keys).agg(
        *[F.count_if(F.col(side) == s).alias(f"_n_{s}") for s in ("left", "right")],
        *[F.max(F.when(F.col(side) == s, row)).alias(f"_{s}") for s in ("left", "right")],
    )
    repeated = (F.col("_n_left") > 1) | (F.col("_n_right") > 1)
    # In a filter, so that no choice of columns can leave the check out.
    failure = F.raise_error(F.lit(f"a side repeats a key: {keys}")).cast("boolean")
    grouped = grouped.filter(F.when(repeated, failure).otherwise(True))
    status = (
        F.when(F.col("_n_right") == 0, "left_only")
        .when(F.col("_n_left") == 0, "right_only")
        .when(F.col("_left").eqNullSafe(F.col("_right")), "matched")
        .otherwise("differs")
    )
    return grouped.select(
        *keys,
        status.alias("status"),
        *[F.col(f"_{s}.{m}").alias(f"{s}_{m}") for s in ("left", "right") for m in measures],
    )


def scd2_history(
    changes: DataFrame,
    key: str,
    order_col: str,
    tracked: list[str],
    max_group_rows: int = MAX_GROUP_ROWS,
    slices: int | None = None,
) -> DataFrame:
    """(key, tracked, valid_from, valid_to, is_current).

    Runs of equal values are one version. ``valid_to`` is the next ``valid_from``,
    exclusive, and null on the current version. ``order_col`` is unique per key.
    """
    rows = changes.select(key, order_col, *tracked)
    state = F.struct(*tracked)

    def versions(changed: DataFrame, valid_to: Column) -> DataFrame:
        return changed.select(
            key,
            *tracked,
            F.col(order_col).alias("valid_from"),
            valid_to.alias("valid_to"),
            valid_to.isNull().alias("is_current"),
        )

    def is_change(previous: str) -> Column:
        return F.col(previous).isNull() | ~F.col(previous).eqNullSafe(state)

    def whole(part: DataFrame) -> DataFrame:
        w = Window.partitionBy(key).orderBy(order_col)
        changed = part.withColumn("_previous", F.lag(state).over(w)).filter(
            is_change("_previous")
        )
        return versions(changed, F.lead(order_col).over(w))

    def sliced(part: DataFrame) -> DataFrame:
        cut = slice_groups(part, [key], [order_col], slices)
        w = Window.partitionBy(key, SLICE).orderBy(order_col)
        carried = last_before_slice(cut, [key], state, F.col(order_col), "_carried")
        changed = (
            attach(cut.withColumn("_previous", F.lag(state).over(w)), [key], carried, ["_carried"])
            .withColumn("_previous", F.coalesce("_previous", "_carried"))
            .filter(is_change("_previous"))
        )
        later = Window.partitionBy(key).orderBy(SLICE).rowsBetween(1, Window.unboundedFollowing)
        following = (
            changed.groupBy(key, SLICE)
            .agg(F.min(order_col).alias("_first"))
            .select(key, SLICE, F.min("_first").over(later).alias("_following"))
            .filter(F.col("_following").isNotNull())
        )
        ends = attach(
            changed.withColumn("_next", F.lead(order_col).over(w)), [key], following, ["_following"]
        )
        return versions(ends, F.coalesce("_next", "_following"))

    return by_group_size(rows, [key], whole, sliced, max_group_rows)


def point_in_time_join(
    facts: DataFrame,
    history: DataFrame,
    key: str,
    at: str,
    max_group_rows: int = MAX_GROUP_ROWS,
    slices: int | None = None,
) -> DataFrame:
    """Left join each fact to the version with ``valid_from <= at < valid_to``.

    A fact with a null key matches nothing. ``history`` has no overlapping versions per key. Facts and versions are
    merged by time and the latest version is carried forward, which is linear
    per key where a join on the key alone would pair every fact with every version.
    """
    attributes = [c for c in history.columns if c not in (key, "valid_from", "valid_to", "is_current")]
    fact_cols = [c for c in facts.columns if c != key]
    version = F.struct("valid_from", "valid_to", *attributes)
    merged = (
        facts.select(
            key,
            F.col(at).alias("_at"),
            F.lit(1).alias("_kind"),
            F.struct(*fact_cols).alias("_fact"),
        )
        .unionByName(
            history.select(
                key,
                F.col("valid_from").alias("_at"),
                F.lit(0).alias("_kind"),
                version.alias("_version"),
            ),
            allowMissingColumns=True,
        )
    )
    order = ["_at", "_kind"]
    to_here = (Window.unboundedPreceding, Window.currentRow)

    def matched(rows: DataFrame, found: Column) -> DataFrame:
        at_facts = rows.withColumn("_found", found).filter(F.col("_kind") == 1)
        open_now = F.col(key).isNotNull() & (
            F.col("_found.valid_to").isNull() | (F.col("_at") < F.col("_found.valid_to"))
        )
        return at_facts.select(
            key,
            *[F.col(f"_fact.{c}").alias(c) for c in fact_cols],
            *[
                F.when(open_now, F.col(f"_found.{c}")).alias(c)
                for c in ["valid_from", "valid_to", *attributes]
            ],
        )

    def whole(part: DataFrame) -> DataFrame:
        w = Window.partitionBy(key).orderBy(*order).rowsBetween(*to_here)
        return matched(part, F.last("_version", ignorenulls=True).over(w))

    def sliced(part: DataFrame) -> DataFrame:
        cut = slice_groups(part, [key], order, slices)
        w = Window.partitionBy(key, SLICE).orderBy(*order).rowsBetween(*to_here)
        newest = F.when(F.col("_kind") == 0, F.struct(*order))
        carried = last_before_slice(cut, [key], F.col("_version"), newest, "_carried")
        local = cut.withColumn("_local", F.last("_version", ignorenulls=True).over(w))
        joined = attach(local, [key], carried, ["_carried"])
        return matched(joined, F.coalesce("_local", "_carried"))

    return by_group_size(merged, [key], whole, sliced, max_group_rows)
