"""Clustered files, gated loads, rolling distinct counts."""

from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.operators.analytics import rolling_distinct
from millrace.session import scratch_path
from millrace.sources import clustered, gate

ROWS = "a bigint, b string, t timestamp_ntz, d date, x double"


@pytest.fixture(scope="module")
def rows(spark):
    """A third of all rows on one value of a, the null one on another third; copies of whole rows."""
    numbers = spark.range(6000)
    h = F.pmod(F.xxhash64("id"), F.lit(1000))
    a = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, h)
    return numbers.select(
        a.cast("bigint").alias("a"),
        F.concat(F.lit("k"), F.lpad((h * 7 % 1000).cast("string"), 4, "0")).alias("b"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), h)).alias("t"),
        F.date_add(F.lit("2024-01-01").cast("date"), (h * 3 % 100).cast("int")).alias("d"),
        F.when(h < 5, F.lit(float("nan"))).otherwise(h / 10).alias("x"),
    ).transform(lambda df: df.unionByName(df.limit(50)))


def bag(df):
    return Counter(tuple(str(v) for v in r) for r in df.collect())


@pytest.mark.parametrize("ranges", [
    {"a": (100, 300), "b": ("k0200", "k0400")},
    {"a": (7, 7)},
    {"b": (None, "k0100")},
    {"a": (5000, None)},
])
def test_clustered_rows_are_those_of_a_filter(spark, rows, ranges):
    path = scratch_path(spark, "clustered")
    clustered.write_clustered(rows, path, ["a", "b"], 100)
    assert bag(spark.read.schema(ROWS).parquet(f"{path}/data")) == bag(rows)
    found = clustered.read_clustered(spark, path, ROWS, ranges)
    assert bag(found) == bag(rows.filter(clustered._within(ranges)))


def test_two_columns_skip_three_quarters_of_the_files(spark, rows):
    path = scratch_path(spark, "clustered")
    even = rows.filter("a <> 7")
    clustered.write_clustered(even, path, ["a", "b"], 20)
    files = spark.read.parquet(f"{path}/index").count()
    assert files > 80
    for ranges in ({"a": (100, 300), "b": ("k0200", "k0400")}, {"a": (500, 600)}, {"b": ("k0500", "k0600")}):
        assert 0 < 4 * len(clustered.pick_files(spark, path, ranges)) <= files


def test_a_hot_value_is_spread_over_files(spark, rows):
    path = scratch_path(spark, "clustered")
    clustered.write_clustered(rows, path, ["a"], 200)
    sizes = [r["n_rows"] for r in spark.read.parquet(f"{path}/index").collect()]
    assert sum(sizes) == rows.count() and max(sizes) < 3 * 200


@pytest.mark.parametrize("columns", [["t"], ["d", "x"], ["x"], ["t", "d", "x", "a", "b"]])
def test_columns_of_any_kind(spark, rows, columns):
    path = scratch_path(spark, "clustered")
    clustered.write_clustered(rows, path, columns, 500)
    found = clustered.read_clustered(spark, path, ROWS, {columns[0]: (None, None)})
    assert bag(found) == bag(rows)


def test_clustering_edges(spark):
    empty, path = spark.createDataFrame([], ROWS), scratch_path(spark, "clustered")
    clustered.write_clustered(empty, path, ["a"])
    assert clustered.read_clustered(spark, path, ROWS, {"a": (0, 9)}).count() == 0
    nulls = spark.createDataFrame([(None, None, None, None, None)] * 3, ROWS)
    path = scratch_path(spark, "clustered")
    clustered.write_clustered(nulls, path, ["a", "b"], 1)
    assert clustered.read_clustered(spark, path, ROWS, {}).count() == 3
    assert clustered.read_clustered(spark, path, ROWS, {"a": (None, 5)}).count() == 0
    with pytest.raises(ValueError, match="not clustered"):
        clustered.pick_files(spark, path, {"x": (0, 1)})
    with pytest.raises(ValueError, match="one to seven"):
        clustered.write_clustered(nulls, scratch_path(spark, "clustered"), [])
    with pytest.raises(TypeError, match="cannot cluster"):
        clustered.write_clustered(nulls.select(F.array("a").alias("l")), scratch_path(spark, "clustered"), ["l"])


@pytest.fixture
def rules(spark):
    return {"positive": F.col("v") > 0}


def test_a_refused_load_leaves_the_table(spark, rules):
    path = scratch_path(spark, "gated")
    frame = lambda *v: spark.createDataFrame([(x,) for x in v], "v int")
    read = lambda: sorted(r[0] for r in gate.read_published(spark, path, "v int").collect())
    assert read() == []
    assert gate.gated_write(frame(1, 2), path, rules) == gate.GateReport(True, 2, {"positive": 0}, [])
    assert gate.gated_write(frame(5, None, -1), path, rules) == gate.GateReport(False, 3, {"positive": 2}, ["positive"])
    assert gate.gated_write(frame(), path, rules).refused == ["least_rows"]
    assert read() == [1, 2]
    assert gate.gated_write(frame(5, 6, 7, None), path, rules, {"positive": 0.25}).published
    assert gate.gated_write(frame(), f"{path}-2", rules, least_rows=0).published
    assert len(gate.versions(spark, path)) == 2
    gate.drop_versions(spark, path, 0)
    assert len(gate.versions(spark, path)) == 1
    with pytest.raises(ValueError, match="without a rule"):
        gate.gated_write(frame(1), path, rules, {"other": 1.0})


def test_a_load_that_is_lost_on_the_way_is_not_read(spark, monkeypatch, rules):
    path = scratch_path(spark, "gated")
    frame = spark.createDataFrame([(1,)], "v int")
    gate.gated_write(frame, path, rules)

    def lost(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(gate, "mark", lost)
    with pytest.raises(RuntimeError):
        gate.gated_write(frame.select(F.lit(9).alias("v")), path, rules)
    assert [r[0] for r in gate.read_published(spark, path, "v int").collect()] == [1]
    failing = frame.select(F.raise_error(F.lit("broken")).cast("int").alias("v"))
    with pytest.raises(Exception, match="broken"):
        gate.gated_write(failing, path, rules)
    assert gate.read_published(spark, path, "v int").count() == 1


@pytest.mark.parametrize("days", [1, 3, 7])
def test_rolling_distinct_is_brute_force(spark, days):
    """The hot user and the null user have a third of the rows each; a group has a gap of weeks."""
    start, data = date(2024, 1, 1), []
    for k in range(900):
        user = 1 if k % 3 == 0 else None if k % 3 == 1 else k * 31 % 17
        day = start + timedelta(days=(k * 37 % 20) + (40 if k % 11 == 0 else 0))
        data.append((("x", "y", None)[k % 7 % 3], user, day if k % 50 else None))
    df = spark.createDataFrame(data, "g string, u int, day date").repartition(5)
    found = {(r["g"], r["day"]): r["n_keys"] for r in rolling_distinct(df, "u", "day", days, ("g",)).collect()}
    expected = {}
    for g in ("x", "y", None):
        own = [(u, d) for h, u, d in data if h == g and d]
        day, last = min(d for _, d in own), max(d for _, d in own)
        while day <= last:
            reach = {u for u, d in own if u is not None and day - timedelta(days=days) < d <= day}
            expected[g, day] = len(reach)
            day += timedelta(days=1)
    assert found == expected


def test_rolling_distinct_edges(spark):
    empty = spark.createDataFrame([], "u int, day date")
    assert rolling_distinct(empty, "u", "day", 7).collect() == []
    nobody = spark.createDataFrame([(None, date(2024, 1, 1)), (3, None)], "u int, day date")
    assert [tuple(r) for r in rolling_distinct(nobody, "u", "day", 7).collect()] == [(date(2024, 1, 1), 0)]
    with pytest.raises(ValueError):
        rolling_distinct(empty, "u", "day", 0)
