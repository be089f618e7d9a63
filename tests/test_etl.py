from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.operators import etl as ops
from millrace.session import scratch_path
from millrace.sources.tables import table


def test_dedupe_breaks_ties_by_the_next_column(spark):
    data = [("a", 1, 1), ("a", 2, 1), ("a", 2, 3), ("a", 2, 2), ("b", None, 1), (None, 1, 1)]
    df = spark.createDataFrame(data, "k string, v int, id int")
    out = ops.dedupe_latest(df, ["k"], ["v", "id"])
    assert sorted(map(tuple, out.collect()), key=repr) == [("a", 2, 3), ("b", None, 1), (None, 1, 1)]


def test_adjacent_slices_add_up(spark, medium):
    orders = table(spark, medium, "orders")
    first = orders.agg(F.min("o_orderdate")).first()[0]
    cuts = [first + timedelta(days=d) for d in (0, 100, 101, 4000)]
    counts = [
        ops.incremental_slice(orders, "o_orderdate", lo, hi).count()
        for lo, hi in zip(cuts, cuts[1:])
    ]
    assert sum(counts) == orders.count()
    assert all(counts)


def test_slice_reaches_the_scan(spark, small, capsys):
    orders = table(spark, small, "orders")
    ops.incremental_slice(
        orders, "o_orderdate", datetime(1997, 1, 1), datetime(1998, 1, 1)
    ).explain()
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "id int, v string")
    more = spark.createDataFrame([("B", 2), ("C", 3)], "v string, id int")
    out = ops.upsert_by_key(target, more, ["id"])
    assert sorted(map(tuple, out.collect()), key=repr) == [(1, "a"), (2, "B"), (3, "C"), (None, "n")]


def test_upsert_refuses_a_repeated_key(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "id int, v string")
    with pytest.raises(ValueError, match="repeats"):
        ops.upsert_by_key(df, df, ["id"])


def test_overwrite_touches_only_its_partitions(spark):
    path = scratch_path(spark, "test-overwrite")
    schema = "v string, day int"
    write = lambda rows: ops.overwrite_partitions(
        spark.createDataFrame(rows, schema), path, ["day"]
    )
    read = lambda: sorted(map(tuple, spark.read.schema(schema).parquet(path).collect()))
    write([("a", 1), ("b", 1), ("c", 2)])
    for _ in range(2):
        write([("B", 1), ("d", 3)])
        assert read() == [("B", 1), ("c", 2), ("d", 3)]


def test_rejects_carry_all_reasons_in_rule_order(spark):
    df = spark.createDataFrame([(1, 9), (60, 9), (60, None), (None, 1)], "a int, b int")
    rules = {"big a": F.col("a") > 50, "big b": F.col("b") > 5, "bigger a": F.col("a") > 55}
    valid, rejects = ops.split_rejects(df, rules)
    assert [tuple(r) for r in valid.collect()] == [(None, 1)]
    assert sorted(r.reasons for r in rejects.collect()) == [
        ["big a", "big b", "bigger a"], ["big a", "bigger a"], ["big b"],
    ]
    assert valid.count() + rejects.count() == df.count()
    assert [len(d.collect()) for d in ops.split_rejects(df.limit(0), rules)] == [0, 0]
    assert ops.split_rejects(df.limit(1), rules).rejects.columns == ["a", "b", "reasons"]


def test_new_vs_returning(spark):
    day = lambda m, d: datetime(2024, m, d)
    data = [("x", day(1, 1), 1.10), ("x", day(1, 9), 2.20), ("x", day(3, 1), 3.0),
            ("y", day(3, 2), 4.0)]
    df = spark.createDataFrame(data, "c string, at timestamp_ntz, v double")
    out = ops.new_vs_returning(df, "c", "at", "v", scale=2).orderBy("period")
    assert [tuple(r)[1:] for r in out.collect()] == [(1, 0, 3.3), (1, 1, 7.0)]


def test_upsert_with_null_keys_can_be_rerun(spark):
    target = spark.createDataFrame([(1, "a"), (None, "b")], "k bigint, v string")
    new = spark.createDataFrame([(None, "c"), (2, "d")], "k bigint, v string")
    once = ops.upsert_by_key(target, new, ["k"])
    twice = ops.upsert_by_key(once, new, ["k"])
    for out in (once, twice):
        assert sorted(map(tuple, out.collect()), key=str) == [(1, "a"), (2, "d"), (None, "c")]
