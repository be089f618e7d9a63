from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.functions.money import cents, total
from millrace.operators import analytics as ops


def test_cents_round_half_away_from_zero(spark):
    values = [1.25, 0.125, -0.125, 0.1 + 0.2, -7.0, 123456789.99, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(cents("v")).collect()] == [
        125, 13, -13, 30, -700, 12345678999, None,
    ]


def test_total_does_not_depend_on_order(spark):
    df = spark.range(10_000).select((F.col("id") % 1000 / 100).alias("v"))
    sums = {df.orderBy(F.rand(s)).agg(total("v").cast("double")).first()[0] for s in range(3)}
    assert sums == {49950.0}


def test_levels_tell_totals_from_nulls(spark):
    df = spark.createDataFrame(
        [("a", None, 1.0), ("a", "x", 2.0), (None, "x", 4.0)], "p string, q string, v double"
    )
    cube = ops.multi_level_totals(df, ["p", "q"], "v", "cube")
    rows = {(r.p, r.q, r.level_id): (r.n_rows, r.total) for r in cube.collect()}
    assert rows[(None, None, 3)] == (3, 7.0)
    assert rows[(None, None, 1)] == (1, 4.0)
    assert rows[("a", None, 1)] == (2, 3.0)
    assert rows[("a", None, 0)] == (1, 1.0)
    sets = ops.multi_level_totals(df, ["p", "q"], "v", "sets", [["q"]])
    assert {(r.q, r.total) for r in sets.collect()} == {(None, 1.0), ("x", 6.0)}
    with pytest.raises(ValueError):
        ops.multi_level_totals(df, ["p"], "v", "pyramid")


def test_top_n_passes_on_few_rows(spark, capsys):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    top = ops.top_n_per_group(df, ["g"], [F.col("id").desc()], 2)
    assert sorted(map(tuple, top.collect())) == [
        (0, 96, 2), (0, 99, 1), (1, 94, 2), (1, 97, 1), (2, 95, 2), (2, 98, 1),
    ]
    top.explain()
    assert "WindowGroupLimit" in capsys.readouterr().out


def test_top_n_above_the_pushed_limit(spark):
    df = spark.range(5000).repartition(7).select((F.col("id") % 2).alias("g"), "id")
    top = ops.top_n_per_group(df, ["g"], [F.col("id").desc()], 1200)
    found = {(r.g, r.id, r.place) for r in top.collect()}
    assert found == {(i % 2, i, (4999 - i) // 2 + 1) for i in range(2600, 5000)}


def test_period_skips_missing_months(spark):
    data = [(datetime(2024, 1, 5), 10.0), (datetime(2024, 4, 5), 15.0)]
    df = spark.createDataFrame(data, "at timestamp_ntz, v double")
    rows = ops.period_over_period(df, "at", "v").orderBy("period").collect()
    assert [tuple(r)[1:] for r in rows] == [(10.0, None, None), (15.0, 10.0, 0.5)]


def test_pivot_and_back(spark):
    df = spark.createDataFrame([(1, "a", 2), (1, "b", 3), (2, "a", 4), (2, "c", 9)],
                               "id int, k string, v int")
    wide = ops.pivot_measures(df, ["id"], "k", {"a": "v_a", "b": "v_b"}, F.sum("v"))
    assert sorted(map(tuple, wide.collect())) == [(1, 2, 3), (2, 4, None)]
    long = ops.unpivot_measures(wide, ["id"], ["v_a", "v_b"], "k", "v")
    assert sorted(map(tuple, long.collect()), key=repr) == [
        (1, "v_a", 2), (1, "v_b", 3), (2, "v_a", 4), (2, "v_b", None),
    ]


def test_partners_do_not_multiply_rows(spark):
    left = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id int")
    right = spark.createDataFrame([(2,), (2,), (2,), (None,)], "ref int")
    out = ops.with_and_without(left, right, {"id": "ref"})
    assert sorted(map(tuple, out.collect()), key=repr) == [
        (1, False), (2, True), (2, True), (None, False),
    ]


def test_sets(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "id int")
    b = spark.createDataFrame([(2,), (3,), (None,)], "id int")
    found = sorted(map(tuple, ops.compare_sets(a, b).collect()), key=repr)
    assert found == sorted(
        [("union", 1), ("union", 2), ("union", 3), ("union", None), ("a_only", 1),
         ("b_only", 3), ("intersection", 2), ("intersection", None)], key=repr,
    )


def test_funnel_needs_strictly_later_events(spark):
    t = [datetime(2024, 1, d) for d in range(1, 6)]
    data = [("in order", t[0], "view"), ("in order", t[1], "click"), ("in order", t[2], "buy"),
            ("same time", t[0], "view"), ("same time", t[0], "click"),
            ("backwards", t[0], "buy"), ("backwards", t[1], "click"), ("backwards", t[2], "view"),
            ("again", t[0], "click"), ("again", t[1], "view"), ("again", t[2], "click"),
            (None, t[0], "view")]
    df = spark.createDataFrame(data, "k string, at timestamp_ntz, what string")
    out = ops.funnel_conversion(df, "k", "at", "what", ["view", "click", "buy"])
    assert [tuple(r) for r in out.orderBy("step").collect()] == [
        (1, "view", 4, None), (2, "click", 2, 0.5), (3, "buy", 1, 0.5),
    ]


def test_quartiles_of_tiny_groups(spark):
    data = [("one", 5.0), ("two", 1.0), ("two", 2.0), ("none", None)]
    df = spark.createDataFrame(data, "g string, v double")
    rows = {r.g: r for r in ops.distribution_stats(df, "g", "v").collect()}
    assert (rows["one"].q1, rows["one"].median, rows["one"].q3) == (5.0, 5.0, 5.0)
    assert (rows["two"].q1, rows["two"].median, rows["two"].q3) == (1.25, 1.5, 1.75)
    assert (rows["none"].n, rows["none"].median) == (0, None)


def test_total_has_room_and_sign(spark):
    big = spark.range(1000).select(F.lit(9_000_000_000_000.01).alias("v"))
    assert str(big.agg(total("v")).first()[0]) == "9000000000000010.00"
    mixed = spark.createDataFrame([(-0.01,), (-20_000.5,), (3.25,), (None,)], "v double")
    assert str(mixed.agg(total("v")).first()[0]) == "-19997.26"
    assert mixed.filter("v is null").agg(total("v")).first()[0] is None


def test_cents_are_those_of_the_cast(spark):
    rows = [(v,) for v in (0.285, 1.005, -0.285, 2.675, 1e13 + 0.015, 0.125, 123456.785, 1e15, None)]
    df = spark.createDataFrame(rows, "v double")
    assert df.filter(~cents("v").eqNullSafe((F.col("v").cast("decimal(18,2)") * 100).cast("bigint"))).isEmpty()
    assert df.select(cents("v")).first()[0] == 29


@pytest.mark.parametrize("value", [1e17, float("inf"), float("-inf"), float("nan")])
def test_amounts_out_of_range_fail(spark, value):
    with pytest.raises(Exception, match="(?i)overflow|out of range|cannot be"):
        spark.createDataFrame([(value,)], "v double").agg(total("v")).collect()


def test_plain_values_are_not_cut(spark):
    df = spark.createDataFrame([("g", v) for v in (0.001, 0.002, 0.004, 0.125)], "g string, v double")
    assert ops.distribution_stats(df, "g", "v").first().mean == pytest.approx(0.033)
    assert ops.multi_level_totals(df, ["g"], "v").first().total == pytest.approx(0.132)
    for limit in (0, 100):
        rows = ops.running_and_moving(df, ["g"], ["v"], "v", 2, limit, 2).orderBy("v").collect()
        assert [r.running_total for r in rows] == pytest.approx([0.001, 0.003, 0.007, 0.132])
    with pytest.raises(ValueError):
        total("v", scale=3)


def test_a_period_after_nothing_has_no_ratio(spark):
    rows = [(datetime(2024, 1, 5), 0.0), (datetime(2024, 2, 5), 3.0)]
    df = spark.createDataFrame(rows, "d timestamp_ntz, v double")
    out = ops.period_over_period(df, "d", "v", scale=2).orderBy("period").collect()
    assert [r.change_ratio for r in out] == [None, None]


def test_cohorts_leave_out_rows_without_a_key(spark):
    rows = [(1, datetime(2024, 1, 5)), (None, datetime(2024, 1, 6))]
    df = spark.createDataFrame(rows, "k bigint, d timestamp_ntz")
    assert [r.n_keys for r in ops.cohort_retention(df, "k", "d").collect()] == [1]


def test_ranks_and_trailing_range(spark):
    rows = [("a", datetime(2024, 1, d), float(d)) for d in (1, 1, 3, 9)]
    df = spark.createDataFrame(rows, "g string, t timestamp_ntz, v double")
    ranks = ops.ranked(df, ["g"], ["t"]).orderBy("t").collect()
    assert [(r["rank"], r.dense_rank) for r in ranks] == [(1, 1), (1, 1), (3, 2), (4, 3)]
    recent = ops.trailing_range(df, ["g"], "t", "v", 3).orderBy("t").collect()
    assert [(r.n_recent, r.recent_total) for r in recent] == [(2, 2.0), (2, 2.0), (3, 5.0), (1, 9.0)]
