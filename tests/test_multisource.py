from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException

from millrace.operators import multisource as ops

START = datetime(2024, 1, 1)


def test_union_fills_and_tags(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "id int, name string")
    b = spark.createDataFrame([(9.5, 2)], "rate double, id int")
    out = ops.union_sources({"a": a, "b": b})
    assert sorted(map(tuple, out.select("id", "name", "rate", "source").collect())) == [
        (1, "x", None, "a"), (1, "x", None, "a"), (2, None, 9.5, "b"),
    ]


def test_precedence_takes_the_first_filled_value(spark):
    data = [
        (1, "low", None, 1, "crm"), (1, "high", None, 2, "erp"), (1, None, "v", 1, "erp"),
        (2, "only", None, 1, "other"), (2, "b", None, 2, "crm"), (2, "a", None, 1, "crm"),
        (None, "n", None, 1, "crm"),
    ]
    df = spark.createDataFrame(data, "id int, name string, extra string, seq int, source string")
    out = ops.resolve_by_precedence(df, "id", {"erp": 0, "crm": 1}, ["seq"])
    assert {r.id: (r.name, r.extra) for r in out.collect()} == {
        1: ("high", "v"), 2: ("a", None), None: ("n", None),
    }


def test_reconcile_is_null_safe(spark):
    schema = "id int, v int, w int"
    left = spark.createDataFrame([(1, 1, None), (2, 1, 1), (3, None, None), (None, 7, 7)], schema)
    right = spark.createDataFrame([(1, 1, None), (2, 1, 2), (4, 0, 0), (None, 7, 7)], schema)
    out = ops.reconcile_sources(left, right, ["id"], ["v", "w"])
    assert {r.id: r.status for r in out.collect()} == {
        1: "matched", 2: "differs", 3: "left_only", 4: "right_only", None: "matched",
    }
    row = out.filter("id = 2").first()
    assert (row.left_v, row.right_v, row.left_w, row.right_w) == (1, 1, 1, 2)


def test_reconcile_refuses_a_repeated_key(spark):
    df = spark.createDataFrame([(1, 1), (1, 2)], "id int, v int")
    with pytest.raises(PySparkException, match="repeats a key"):
        ops.reconcile_sources(df, df.limit(0), ["id"], ["v"]).collect()


def test_history_treats_null_as_a_value(spark):
    at = [START + timedelta(days=i) for i in range(6)]
    states = [None, None, "a", "a", None, "a"]
    df = spark.createDataFrame(
        [("k", t, s) for t, s in zip(at, states)], "k string, at timestamp_ntz, s string"
    )
    out = ops.scd2_history(df, "k", "at", ["s"]).orderBy("valid_from")
    assert [(r.s, r.valid_from, r.valid_to, r.is_current) for r in out.collect()] == [
        (None, at[0], at[2], False), ("a", at[2], at[4], False),
        (None, at[4], at[5], False), ("a", at[5], None, True),
    ]


def test_point_in_time_bounds(spark):
    t = [START + timedelta(days=i) for i in range(4)]
    history = spark.createDataFrame(
        [("k", t[1], t[2], "a"), ("k", t[2], t[3], "b")],
        "k string, valid_from timestamp_ntz, valid_to timestamp_ntz, s string",
    )
    facts = spark.createDataFrame(
        [("k", t[0]), ("k", t[1]), ("k", t[2]), ("k", t[3]), ("k", t[2]), ("other", t[1]),
         (None, t[1])],
        "k string, at timestamp_ntz",
    )
    out = ops.point_in_time_join(facts, history, "k", "at")
    found = sorted(((r.k, r["at"], r.s) for r in out.collect()), key=repr)
    assert found == sorted(
        [("k", t[0], None), ("k", t[1], "a"), ("k", t[2], "b"), ("k", t[2], "b"),
         ("k", t[3], None), ("other", t[1], None), (None, t[1], None)], key=repr,
    )


def test_reconcile_refuses_a_repeated_key_whatever_is_asked(spark):
    left = spark.createDataFrame([(1, 1), (1, 2)], "k int, m int")
    right = spark.createDataFrame([(1, 1)], "k int, m int")
    out = ops.reconcile_sources(left, right, ["k"], ["m"])
    for use in (out.count, out.select("k").collect):
        with pytest.raises(Exception, match="repeats a key"):
            use()


def test_a_fact_without_key_matches_no_version(spark):
    facts = spark.createDataFrame([(None, 5), (1, 5)], "k int, at int")
    history = spark.createDataFrame([(None, 0, None, "x"), (1, 0, None, "y")], "k int, valid_from int, valid_to int, v string")
    out = ops.point_in_time_join(facts, history, "k", "at")
    assert sorted((r.k is None, r.v) for r in out.collect()) == [(False, "y"), (True, None)]
