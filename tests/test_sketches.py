"""Figures of spans united from sketches of days, beside exact ones."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.operators import sketches as ops

START = date(2024, 1, 1)
SCHEMA = "day date, kind string, user bigint, value double"


def made(df):
    return ops.sketch_mart(df, {n: F.col(n) for n in ("day", "kind")}, "user", "value")


@pytest.fixture(scope="module")
def rows():
    pick = random.Random(1)
    out = []
    for i in range(40_000):  # day 3 holds a third of all rows
        day = START + timedelta(days=3 if i % 3 == 0 else pick.randrange(10))
        out.append((day, pick.choice(["a", "b", None]), pick.randrange(30_000), pick.gauss(0, 1)))
    out += [(START, "a", None, None), (START, "a", 1, float("nan")), (START, "none", None, None)]
    return out


@pytest.fixture(scope="module")
def mart(spark, rows):
    return made(spark.createDataFrame(rows, SCHEMA).repartition(6)).cache()


def test_days_unite_into_spans(mart, rows):
    found = ops.span_figures(mart, {"kind": F.col("kind")}, {"q1": 0.25, "median": 0.5}).collect()
    assert {r.kind for r in found} == {"a", "b", None, "none"}
    for r in found:
        own = [x for x in rows if x[1] == r.kind]
        users = len({x[2] for x in own} - {None})
        values = sorted(x[3] for x in own if x[3] is not None and x[3] == x[3])
        assert r.n_rows == len(own)
        assert abs(r.n_keys - users) <= 4 * ops.COUNT_ERROR * users
        if not values:
            assert (r.q1, r.median) == (None, None)
            continue
        for value, share in ((r.q1, 0.25), (r.median, 0.5)):
            rank = sum(v <= value for v in values) / len(values)
            assert abs(rank - share) <= 2 * ops.RANK_ERROR


def test_counts_of_few_keys_are_exact(spark, rows):
    few = [(d, k, u % 900 if u is not None else None, v) for d, k, u, v in rows]
    mart = made(spark.createDataFrame(few, SCHEMA))
    day = {"day": F.col("day")}
    for r in ops.span_figures(mart, day, {}).collect():
        assert r.n_keys == len({x[2] for x in few if x[0] == r.day} - {None})
    a, b = START + timedelta(days=4), START + timedelta(days=5)
    both = ops.span_overlap(mart, [], F.col("day") <= a, F.col("day") >= b).first()
    first = {x[2] for x in few if x[0] <= a} - {None}
    second = {x[2] for x in few if x[0] >= b} - {None}
    assert tuple(both) == (len(first), len(second), len(first & second))


def test_overlap_is_within_its_bound(mart, rows):
    a, b = START + timedelta(days=2), START + timedelta(days=3)
    found = ops.span_overlap(mart, ["kind"], F.col("day") <= a, F.col("day") >= b).collect()
    for r in found:
        first = {x[2] for x in rows if x[1] == r.kind and x[0] <= a} - {None}
        second = {x[2] for x in rows if x[1] == r.kind and x[0] >= b} - {None}
        bound = 4 * ops.COUNT_ERROR * len(first | second)
        for got, exact in ((r.n_first, first), (r.n_second, second), (r.n_both, first & second)):
            assert abs(got - len(exact)) <= bound
    assert [r.n_both for r in found if r.kind == "none"] == [0]


def test_a_day_replaced_changes_only_its_spans(spark, mart, rows):
    day = START + timedelta(days=3)
    fresh = made(spark.createDataFrame([(day, "a", 5, 1.5)], SCHEMA))
    changed = mart.filter(F.col("day") != day).unionByName(fresh)
    # Quantiles are left out: they may come out differently, within their bound, at each question.
    figures = [ops.span_figures(m, {"day": F.col("day")}, {}) for m in (mart, changed)]
    before, after = ({tuple(r) for r in f.collect()} for f in figures)
    assert {r for r in after if r[0] == day} == {(day, 1, 1)}
    assert {r for r in before if r[0] != day} == {r for r in after if r[0] != day}


def test_an_empty_table(spark):
    mart = made(spark.createDataFrame([], SCHEMA))
    assert ops.span_figures(mart, {"kind": F.col("kind")}, {"m": 0.5}).collect() == []
    assert ops.span_overlap(mart, ["kind"], F.lit(True), F.lit(False)).collect() == []
