"""Analytical queries over facts and dimensions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from millrace.functions.money import CENT, from_halves, from_sums, halves, net_units, summands, total
from millrace.functions.text import truncate_to
from millrace.operators.ordered import (
    MAX_GROUP_ROWS,
    SLICE,
    attach,
    by_group_size,
    running_totals,
    slice_groups,
    sums_before_slice,
)
from millrace.session import stage


def star_revenue(
    lineitem: DataFrame,
    orders: DataFrame,
    customer: DataFrame,
    nation: DataFrame,
    region: DataFrame,
) -> DataFrame:
    """Net revenue and line count per region, nation and order year.

    Each fact shrinks before it is shuffled for the next join: lines to one row
    per order, orders to one row per customer and year. No join then sees a
    repeated key on its large side.
    """
    high, low = halves(net_units("l_extendedprice", "l_discount"))
    parts = ["high", "low", "n_lines"]
    added = [F.sum(p).alias(p) for p in parts]
    per_order = lineitem.groupBy("l_orderkey").agg(
        F.sum(high).alias("high"), F.sum(low).alias("low"), F.count(F.lit(1)).alias("n_lines")
    )
    per_customer = (
        orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("order_year"))
        .join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("o_custkey", "order_year")
        .agg(*added)
    )
    place = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    ).select("c_custkey", "n_name", "r_name")
    revenue = from_halves(F.col("high"), F.col("low")) * F.lit(CENT * CENT)
    return (
        per_customer.join(place, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("r_name", "n_name", "order_year")
        .agg(*added)
        .select(
            "r_name", "n_name", "order_year", revenue.cast("double").alias("revenue"), "n_lines"
        )
    )


def multi_level_totals(
    df: DataFrame,
    levels: list[str],
    value: str,
    mode: str = "rollup",
    sets: list[list[str]] | None = None,
    scale: int | None = None,
) -> DataFrame:
    """Count and total per level combination; ``level_id`` tells a total from a real null.

    ``mode`` is rollup, cube or sets; ``scale`` is 2 for money and else None. Rows are added up at the finest level
    first, so only that small result is multiplied by the number of levels.
    """
    finest = df.groupBy(*levels).agg(
        F.count(F.lit(1)).alias("n_rows"), total(value, scale=scale).alias("total")
    )
    if mode == "rollup":
        grouped = finest.rollup(*levels)
    elif mode == "cube":
        grouped = finest.cube(*levels)
    elif mode == "sets":
        grouped = finest.groupingSets(
            [[F.col(c) for c in chosen] for chosen in sets or []], *[F.col(c) for c in levels]
        )
    else:
        raise ValueError(f"unknown mode: {mode}")
    return grouped.agg(
        F.grouping_id().alias("level_id"),
        F.sum("n_rows").alias("n_rows"),
        F.sum("total").cast("double").alias("total"),
    )


def top_n_per_group(
    df: DataFrame, group: list[str], order: list[Column], n: int, rank_name: str = "place"
) -> DataFrame:
    """First ``n`` rows per group; ``order`` needs a unique tie-break.

    The limit reaches below the shuffle: a task passes on at most ``n`` rows per
    group. Spark does so up to ``spark.sql.optimizer.windowGroupLimitThreshold``;
    above that, each group is first cut down in parts that share out its rows.
    """

    def first(rows: DataFrame, parts: list[str]) -> DataFrame:
        w = Window.partitionBy(*parts).orderBy(*order)
        return rows.withColumn(rank_name, F.row_number().over(w)).filter(F.col(rank_name) <= n)

    spark = df.sparkSession
    if n > int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        slot = "_slot"
        parts = max(2, spark.sparkContext.defaultParallelism)
        spread = df.withColumn(slot, F.spark_partition_id() % parts)
        df = first(spread, [*group, slot]).drop(slot, rank_name)
    return first(df, group)


def running_and_moving(
    df: DataFrame,
    part: list[str],
    order: list[str],
    value: str,
    width: int,
    max_group_rows: int = MAX_GROUP_ROWS,
    slices: int | None = None,
    scale: int | None = None,
) -> DataFrame:
    """Add ``running_total`` and ``moving_avg``, the mean of the last ``width`` rows.

    ``scale`` is 2 for money, which is added up exactly, and else None.
    """

    def moving(w: WindowSpec) -> Column:
        frame = w.rowsBetween(-(width - 1), Window.currentRow)
        amount = total(value, frame, scale).cast("double")
        return (amount / F.count(F.col(value)).over(frame)).alias("moving_avg")

    def whole(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy(*part).orderBy(*order)
        running = total(value, w.rowsBetween(Window.unboundedPreceding, Window.currentRow), scale)
        return rows.select("*", running.cast("double").alias("running_total"), moving(w))

    def sliced(rows: DataFrame) -> DataFrame:
        cut = slice_groups(rows, part, order, slices).withColumn("_home", F.lit(True))
        if width > 1:
            led = cut.unionByName(
                lead_in_rows(cut, part, order, value, width - 1), allowMissingColumns=True
            )
        else:
            led = cut
        w = Window.partitionBy(*part, SLICE).orderBy(*order)
        to_here = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        own = [F.when(F.col("_home"), part) for part in summands(value, scale)]
        names = ["_high", "_low"]
        local = led.select(
            "*", moving(w), *[F.sum(h).over(to_here).alias(n) for h, n in zip(own, names)]
        ).filter("_home")
        before = sums_before_slice(cut, part, dict(zip(["_high_0", "_low_0"], summands(value, scale))))
        joined = attach(local, part, before, ["_high_0", "_low_0"])
        high, low = [
            F.when(F.col(n).isNull(), F.col(f"{n}_0")).otherwise(
                F.col(n) + F.coalesce(f"{n}_0", F.lit(0))
            )
            for n in names
        ]
        running = from_sums(high, low, scale)
        return joined.select(
            *rows.columns, running.cast("double").alias("running_total"), "moving_avg"
        )

    return by_group_size(df, part, whole, sliced, max_group_rows)


def lead_in_rows(
    cut: DataFrame, keys: list[str], order: list[str], value: str, n: int
) -> DataFrame:
    """The ``n`` rows of a group that come before each of its slices, marked as not at home.

    They are among the last ``n`` rows of the slices, numbered through the group.
    """
    carried = list(dict.fromkeys([*keys, *order, value]))
    tail = Window.partitionBy(*keys, SLICE).orderBy(*[F.col(c).desc() for c in order])
    in_group = Window.partitionBy(*keys)
    tails = (
        cut.select(*carried, SLICE)
        .withColumn("_back", F.row_number().over(tail))
        .filter(F.col("_back") <= n)
        .withColumn("_nth", F.row_number().over(in_group.orderBy(SLICE, *order)))
        .drop("_back")
    )
    earlier = in_group.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    last_nth = F.sum("_tails").over(earlier)
    wanted = (
        tails.groupBy(*keys, SLICE)
        .agg(F.count(F.lit(1)).alias("_tails"))
        .withColumn("_last", last_nth)
        .filter(F.col("_last").isNotNull())
        .select(
            *[F.col(k).alias(f"_for_{k}") for k in keys],
            F.col(SLICE).alias("_target"),
            F.explode(F.sequence(F.greatest(F.col("_last") - (n - 1), F.lit(1)), "_last")).alias(
                "_wanted"
            ),
        )
    )
    same = F.col("_nth") == F.col("_wanted")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_for_{k}"))
    return tails.join(wanted, same).select(
        *carried, F.col("_target").alias(SLICE), F.lit(False).alias("_home")
    )


def period_over_period(
    df: DataFrame, date: str, value: str, unit: str = "month", scale: int | None = None
) -> DataFrame:
    """Total per period, the previous period present, and the change as a ratio.

    The ratio is null after a total of 0. ``scale`` is 2 for money and else None. The window has no partition; it runs on one row per calendar period.
    """
    w = Window.orderBy("period")
    change = F.try_divide(F.col("total") - F.col("previous_total"), F.col("previous_total"))
    return (
        df.groupBy(truncate_to(unit, date).alias("period"))
        .agg(total(value, scale=scale).cast("double").alias("total"))
        .withColumn("previous_total", F.lag("total").over(w))
        .withColumn("change_ratio", change)
    )


def pivot_measures(
    df: DataFrame, index: list[str], col: str, values: dict[object, str], agg: Column
) -> DataFrame:
    """One column per listed value, named by ``values``; no job is run to find them."""
    wide = df.groupBy(*index).pivot(col, list(values)).agg(agg)
    return wide.select(*index, *[F.col(f"`{v}`").alias(name) for v, name in values.items()])


def unpivot_measures(
    df: DataFrame, ids: list[str], cols: list[str], name: str, value: str
) -> DataFrame:
    """One row per id and column; the inverse of ``pivot_measures``."""
    return df.unpivot(ids, cols, name, value)


def with_and_without(
    left: DataFrame,
    right: DataFrame,
    on: dict[str, str],
    flag: str = "has_partner",
) -> DataFrame:
    """Every left row once, flagged by whether ``right`` has a partner for it.

    ``right`` is reduced to its distinct keys and stored first: a key repeated there
    cannot multiply rows, and with a stored side adaptive execution splits a key that ``left``
    repeats often.
    """
    renamed = {lk: f"_partner_{rk}" for lk, rk in on.items()}
    partners = right.select(*[F.col(rk).alias(renamed[lk]) for lk, rk in on.items()]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(x) == F.col(y) for x, y in renamed.items()])
    marked = left.join(stage(partners, "partners"), same, "left")
    found = F.col(next(iter(renamed.values()))).isNotNull()
    return marked.select(*left.columns, found.alias(flag))


def compare_sets(a: DataFrame, b: DataFrame) -> DataFrame:
    """(relation, key columns) for union, intersection, a_only and b_only of distinct rows.

    One aggregation of both sides answers all four.
    """
    both = a.withColumn("_in_a", F.lit(True)).unionByName(
        b.withColumn("_in_a", F.lit(False))
    )
    member = both.groupBy(*a.columns).agg(
        F.bool_or(F.col("_in_a")).alias("_a"), F.bool_or(~F.col("_in_a")).alias("_b")
    )
    relations = F.array(
        F.lit("union"),
        F.when(F.col("_a") & F.col("_b"), "intersection")
        .when(F.col("_a"), "a_only")
        .otherwise("b_only"),
    )
    return member.select(F.explode(relations).alias("relation"), *a.columns)


def funnel_conversion(
    events: DataFrame,
    key: str,
    ts: str,
    kind: str,
    steps: list[str],
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """(step, step_name, n_keys, conversion from the step before).

    Step k takes a key's earliest step-k event strictly after the event taken
    for step k-1.
    """
    hits = events.filter(F.col(kind).isin(steps) & F.col(key).isNotNull()).select(key, ts, kind)
    taken = [f"_taken_{i}" for i in range(len(steps))]

    def qualifies(i: int) -> Column:
        is_step = F.col(kind) == steps[i]
        return is_step & (F.col(ts) > F.col(taken[i - 1])) if i else is_step

    def whole(part: DataFrame) -> DataFrame:
        # All steps use one partitioning of the events.
        everything = Window.partitionBy(key)
        for i, name in enumerate(taken):
            part = part.withColumn(name, F.min(F.when(qualifies(i), F.col(ts))).over(everything))
        return part.groupBy(key).agg(*[F.max(c).alias(c) for c in taken])

    def sliced(part: DataFrame) -> DataFrame:
        # One row per large group, so what has been taken so far can be broadcast.
        state = None
        for i, name in enumerate(taken):
            rows = part if state is None else part.join(F.broadcast(state), key)
            earliest = F.min(F.when(qualifies(i), F.col(ts))).alias(name)
            state = rows.groupBy(key, *taken[:i]).agg(earliest)
        return state

    reached = by_group_size(hits, [key], whole, sliced, max_group_rows)
    counts = reached.agg(*[F.count(c).alias(c) for c in taken])
    rows = [
        F.struct(
            F.lit(i + 1).alias("step"),
            F.lit(steps[i]).alias("step_name"),
            F.col(c).alias("n_keys"),
            (F.try_divide(F.col(c), F.col(taken[i - 1])) if i else F.lit(None).cast("double"))
            .alias("conversion"),
        )
        for i, c in enumerate(taken)
    ]
    return counts.select(F.inline(F.array(*rows)))


def cohort_retention(df: DataFrame, key: str, date: str) -> DataFrame:
    """(cohort, month_offset, n_keys): distinct keys active per month after their first.

    Rows without a key belong to nobody and are left out. Rows shrink to one per key and month before the window.
    """
    month = truncate_to("month", date)
    active = df.filter(F.col(key).isNotNull()).select(key, month.alias("month")).distinct()
    cohort = F.min("month").over(Window.partitionBy(key))
    months = lambda c: F.year(c) * 12 + F.month(c)
    return (
        active.withColumn("cohort", cohort)
        .groupBy("cohort", (months("month") - months("cohort")).alias("month_offset"))
        .agg(F.count(F.lit(1)).alias("n_keys"))
    )


def rolling_distinct(df: DataFrame, key: str, date: str, days: int, by: tuple[str, ...] = ()) -> DataFrame:
    """(``by``, day, n_keys): distinct keys of the last ``days`` days, for each day from a group's first to its last.

    A key enters the count on a day on which it was not in it and leaves it ``days`` days after its last
    row, so work does not grow with ``days``. Rows without a key make their day known but
    are no key; rows without a date are left out; a null in ``by`` is a group. Days between without any row are
    reported too. After the first step a key has one row per group and day, and what is added up one row per day.
    """
    if days < 1:
        raise ValueError("at least one day")
    active = df.select(*by, F.col(key).alias("_key"), F.to_date(date).alias("day")).filter("day is not null").distinct()
    of_key = Window.partitionBy(*by, "_key").orderBy("day")
    until = F.date_add("day", days)
    ends = active.withColumns({
        "_enters": F.col("_key").isNotNull() & F.coalesce(F.date_add(F.lag("day").over(of_key), days) < F.col("day"), F.lit(True)),
        "_leaves": F.col("_key").isNotNull() & F.coalesce(F.lead("day").over(of_key) > until, F.lit(True)),
    })

    def change(day: Column, by_how_much: Column, known: bool) -> Column:
        return F.struct(day.alias("day"), by_how_much.alias("change"), F.lit(known).alias("known"))

    moves = F.array(
        change(F.col("day"), F.col("_enters").cast("bigint"), True),
        change(until, -F.col("_leaves").cast("bigint"), False),
    )
    per_day = (
        ends.select(*by, F.inline(moves))
        .groupBy(*by, "day")
        .agg(F.sum("change").alias("change"), F.max("known").alias("known"))
    )
    over_days = Window.partitionBy(*by).orderBy("day")
    last = F.max(F.when(F.col("known"), F.col("day"))).over(Window.partitionBy(*by))
    counted = per_day.select(
        *by, "day", F.sum("change").over(over_days).alias("n_keys"), F.lead("day").over(over_days).alias("_next"), last.alias("_last")
    ).filter("day <= _last")
    through = F.least(F.col("_last"), F.coalesce(F.date_sub("_next", 1), F.col("_last")))
    return counted.select(*by, F.explode(F.sequence("day", through)).alias("day"), "n_keys")


QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def distribution_stats(
    df: DataFrame,
    group: str,
    col: str,
    max_group_rows: int = MAX_GROUP_ROWS,
    slices: int | None = None,
) -> DataFrame:
    """min, max, mean, sample stddev and exact interpolated quartiles per group.

    A group of ordinary size is sorted in one task. A larger one is cut into
    ranges of values, and only the ranges that hold a wanted rank are looked into.
    """
    values = df.select(group, col)
    basics = values.groupBy(group).agg(
        F.count(col).alias("n"),
        F.min(col).alias("min"),
        F.max(col).alias("max"),
        F.avg(col).alias("mean"),
        F.stddev(col).alias("stddev"),
    )

    def whole(part: DataFrame) -> DataFrame:
        in_group = Window.partitionBy(group)
        placed = part.filter(F.col(col).isNotNull()).withColumns(
            {
                "_start": F.row_number().over(in_group.orderBy(col)) - 1,
                "_n": F.lit(1),
                "_size": F.count(col).over(in_group),
            }
        )
        return _quartiles(placed, group, col)

    def sliced(part: DataFrame) -> DataFrame:
        return _quartiles_by_range(part, group, col, slices)

    quartiles = by_group_size(values, [group], whole, sliced, max_group_rows)
    quartiles = quartiles.withColumnRenamed(group, "_group")
    return basics.join(quartiles, F.col(group).eqNullSafe(F.col("_group")), "left").drop("_group")


def _quartiles_by_range(df: DataFrame, group: str, col: str, slices: int | None) -> DataFrame:
    # Equal values become one row with a count, so a frequent value is no burden.
    counted = (
        df.filter(F.col(col).isNotNull()).groupBy(group, col).agg(F.count(F.lit(1)).alias("_n"))
    )
    cut = slice_groups(counted, [group], [col], slices)
    in_group = Window.partitionBy(group)
    earlier = in_group.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    per_slice = (
        cut.groupBy(group, SLICE)
        .agg(F.sum("_n").alias("_rows"))
        .withColumns(
            {
                "_before": F.coalesce(F.sum("_rows").over(earlier), F.lit(0)),
                "_size": F.sum("_rows").over(in_group),
            }
        )
    )

    wanted = F.array_contains(
        F.array(*[_holds(r, F.col("_before"), F.col("_rows")) for r in _ranks().values()]), True
    )
    inside = attach(cut, [group], per_slice.filter(wanted), ["_before", "_size"]).filter(
        F.col("_size").isNotNull()
    )
    w = Window.partitionBy(group, SLICE).orderBy(col)
    up_to = F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = inside.withColumn("_start", F.col("_before") + up_to - F.col("_n"))
    return _quartiles(placed, group, col)


def _spot(share: float) -> Column:
    return (F.col("_size") - 1) * F.lit(share)


def _ranks() -> dict[str, Column]:
    """The ranks, from 0, whose values the quartiles lie between."""
    return {
        f"{name}_{end}": at(_spot(share)).cast("bigint")
        for name, share in QUARTILES.items()
        for end, at in (("lo", F.floor), ("hi", F.ceil))
    }


def _holds(rank: Column, start: Column, rows: Column) -> Column:
    return (start <= rank) & (rank < start + rows)


def _quartiles(placed: DataFrame, group: str, col: str) -> DataFrame:
    """From rows that stand for ``_n`` ranks from ``_start`` in a group of ``_size``."""
    here = {name: _holds(r, F.col("_start"), F.col("_n")) for name, r in _ranks().items()}
    found = (
        placed.filter(reduce(lambda a, b: a | b, here.values()))
        .groupBy(group)
        .agg(
            F.max("_size").alias("_size"),
            *[F.max(F.when(hit, F.col(col))).alias(name) for name, hit in here.items()],
        )
    )

    def between(name: str, share: float) -> Column:
        lo, hi = F.col(f"{name}_lo"), F.col(f"{name}_hi")
        return (lo + (hi - lo) * (_spot(share) - F.floor(_spot(share)))).alias(name)

    return found.select(group, *[between(name, share) for name, share in QUARTILES.items()])


def ranked(
    df: DataFrame,
    group: list[str],
    order: list[str],
    descending: bool = False,
    max_group_rows: int = MAX_GROUP_ROWS,
    slices: int | None = None,
) -> DataFrame:
    """Add ``rank`` and ``dense_rank`` per group; rows equal in ``order`` share them.

    Nulls come first, or last if ``descending``. In a large group the different values are ranked, by
    running counts over slices of them, and the rows look theirs up; a frequent value is one row there.
    """

    def whole(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy(*group).orderBy(*[F.col(c).desc() if descending else F.col(c) for c in order])
        return rows.withColumns({"rank": F.rank().over(w), "dense_rank": F.dense_rank().over(w)})

    def sliced(rows: DataFrame) -> DataFrame:
        values = stage(rows.groupBy(*group, *order).agg(F.count(F.lit(1)).alias("_n")), "ranked-values")
        counts = {"_rows": F.col("_n"), "_values": F.lit(1).cast("bigint")}
        placed = running_totals(values, group, order, counts, max_group_rows, slices)
        rank, dense = F.col("_rows") - F.col("_n") + 1, F.col("_values")
        if descending:  # counted from the other end
            ends = values.groupBy(*group).agg(F.sum("_n").alias("_all_rows"), F.count(F.lit(1)).alias("_all_values"))
            placed = _looked_up(placed, F.broadcast(ends), group)  # a row per large group
            rank, dense = F.col("_all_rows") - F.col("_rows") + 1, F.col("_all_values") - F.col("_values") + 1
        found = placed.select(*group, *order, rank.cast("int").alias("rank"), dense.cast("int").alias("dense_rank"))
        return _looked_up(rows, found, [*group, *order])

    return by_group_size(df, group, whole, sliced, max_group_rows)


def trailing_range(
    df: DataFrame,
    part: list[str],
    at: str,
    value: str,
    days: int,
    scale: int | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add ``n_recent`` and ``recent_total``: over the rows of the last ``days`` days, this one's included.

    The frame is a range of time, so rows at the same time see the same frame; rows without a time see each
    other. A large group becomes one row per second, cut into stretches of ``days`` days: a frame
    ends in one stretch and begins there or in the one before, whose rows are led in.
    """
    span = days * 86_400
    seconds = F.unix_seconds(F.col(at).cast("timestamp"))

    def whole(rows: DataFrame) -> DataFrame:
        frame = Window.partitionBy(*part).orderBy(seconds).rangeBetween(-span + 1, Window.currentRow)
        recent = total(value, frame, scale).cast("double")
        return rows.select("*", F.count(F.lit(1)).over(frame).alias("n_recent"), recent.alias("recent_total"))

    def sliced(rows: DataFrame) -> DataFrame:
        timed = rows.withColumn("_second", seconds)
        sums = [F.sum(half).alias(n) for half, n in zip(summands(value, scale), ("_high", "_low"))]
        per_second = timed.groupBy(*part, "_second").agg(F.count(F.lit(1)).alias("_n"), *sums)
        own = F.floor(F.col("_second") / span)
        stretches = F.array(
            F.struct(own.alias("_stretch"), F.lit(True).alias("_home")),
            F.struct((own + 1).alias("_stretch"), F.lit(False).alias("_home")),
        )
        led = per_second.select("*", F.inline(stretches)).filter("_home or _second is not null")
        frame = Window.partitionBy(*part, "_stretch").orderBy("_second").rangeBetween(-span + 1, Window.currentRow)
        recent = from_sums(F.sum("_high").over(frame), F.sum("_low").over(frame), scale).cast("double")
        found = (
            led.select(*part, "_second", "_home", F.sum("_n").over(frame).alias("n_recent"), recent.alias("recent_total"))
            .filter("_home")
            .drop("_home")
        )
        return _looked_up(timed, found, [*part, "_second"]).drop("_second")

    return by_group_size(df, part, whole, sliced, max_group_rows)


def _looked_up(rows: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """The rows with the other columns of ``found``, which has one row for each of their keys, null ones included."""
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_of_{i}")) for i, k in enumerate(keys)], F.lit(True))
    added = [c for c in found.columns if c not in keys]
    renamed = found.select(*[F.col(k).alias(f"_of_{i}") for i, k in enumerate(keys)], *added)
    return rows.join(renamed, same).select(*rows.columns, *added)


def approx_quantiles(
    df: DataFrame, group: list[Column], col: str, shares: dict[str, float], accuracy: int
) -> DataFrame:
    """Sketch quantiles, each a value whose rank is off by at most n / ``accuracy``."""
    return df.groupBy(*group).agg(
        *[F.percentile_approx(col, share, accuracy).alias(name) for name, share in shares.items()]
    )


def approx_distinct(df: DataFrame, group: list[Column], col: str, rsd: float) -> DataFrame:
    """Sketch count of distinct values with relative standard deviation ``rsd``."""
    return df.groupBy(*group).agg(F.approx_count_distinct(col, rsd).alias("n_distinct"))
