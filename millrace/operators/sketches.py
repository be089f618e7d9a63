"""Sketches kept in a mart, so that any span is answered without the rows.

A mart has one row per day and group with the number of rows, a theta sketch of the keys and a
KLL sketch of the values. Sketches of days unite into the sketch of a span; two spans meet in
an intersection. The rows are read once, when the mart is made; a day is added or replaced
without touching the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Entries of a theta sketch (a power of two) and size of a KLL sketch.
LOG_ENTRIES, KLL_SIZE = 12, 200
#: Standard error of a count, relative to the sketch's own set, and the error of a rank that
#: a KLL sketch of that size keeps with a probability of 0.99.
COUNT_ERROR, RANK_ERROR = 2.0 ** (-LOG_ENTRIES / 2), 0.0165


def sketch_mart(df: DataFrame, group: dict[str, Column], key: str, value: str) -> DataFrame:
    """(group, n_rows, keys, values), one row per group; the group holds the day.

    Null keys and null or NaN values count as rows only. A group that is null is a group. Without
    rows there is no row. Up to 4,096 different keys a sketch is exact.
    """
    number = F.col(value).cast("double")
    return df.groupBy(*[c.alias(n) for n, c in group.items()]).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.theta_sketch_agg(F.col(key), LOG_ENTRIES).alias("keys"),
        F.kll_sketch_agg_double(F.when(~F.isnan(number), number), F.lit(KLL_SIZE)).alias("values"),
    )


def span_figures(mart: DataFrame, group: dict[str, Column], shares: dict[str, float]) -> DataFrame:
    """(group, n_rows, n_keys, one column per share) of the days that a coarser group joins.

    ``n_rows`` is exact, ``n_keys`` has a standard error of ``COUNT_ERROR``, and a quantile is a value
    whose rank is off by ``RANK_ERROR`` at most, as a rule; null where there is no value. A KLL sketch
    leaves values out by chance, so a question asked again may be answered by another value within the bound.
    """
    united = mart.groupBy(*[c.alias(n) for n, c in group.items()]).agg(
        F.sum("n_rows").alias("n_rows"),
        F.theta_union_agg("keys", LOG_ENTRIES).alias("_keys"),
        F.kll_merge_agg_double("values", F.lit(KLL_SIZE)).alias("_values"),
    )
    filled = F.kll_sketch_get_n_double("_values") > 0
    return united.select(
        *group,
        "n_rows",
        F.theta_sketch_estimate("_keys").alias("n_keys"),
        *[
            F.when(filled, F.kll_sketch_get_quantile_double("_values", F.lit(share))).alias(name)
            for name, share in shares.items()
        ],
    )


def span_overlap(mart: DataFrame, group: list[str], first: Column, second: Column) -> DataFrame:
    """(group, n_first, n_second, n_both): keys seen in either span of days, and in both.

    The spans are conditions on the columns of the mart and may overlap. ``n_both`` has a standard error of
    ``COUNT_ERROR`` of the keys in either span, so a small overlap of large spans is rough.
    A group without rows in a span has 0 there.
    """
    spans = {"_first": first, "_second": second}
    united = (
        mart.filter(first | second)
        .groupBy(*group)
        .agg(*[F.theta_union_agg(F.when(c, F.col("keys")), LOG_ENTRIES).alias(n) for n, c in spans.items()])
    )
    return united.select(
        *group,
        F.theta_sketch_estimate("_first").alias("n_first"),
        F.theta_sketch_estimate("_second").alias("n_second"),
        F.theta_sketch_estimate(F.theta_intersection("_first", "_second")).alias("n_both"),
    )
