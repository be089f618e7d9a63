"""Large groups cut into ranges must give what one window over the group gives."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.operators.analytics import (
    distribution_stats,
    funnel_conversion,
    ranked,
    running_and_moving,
    trailing_range,
)
from millrace.operators.multisource import point_in_time_join, scd2_history
from millrace.operators.ordered import running_totals, slice_groups
from millrace.operators.remodel import extract_lookup

START = datetime(2024, 1, 1)
ALL_WHOLE = {"max_group_rows": 10**9}
CUTS = [{"max_group_rows": 0, "slices": 3}, {"max_group_rows": 100, "slices": 40}]


@pytest.fixture(scope="module")
def rows(spark):
    """Key 'hot' and the null key hold about a third of the rows each."""
    pick = random.Random(7)
    data = []
    for i in range(600):
        key = pick.choice(["hot", "hot", None, None, f"k{i % 40}"])
        at = START + timedelta(seconds=i * 60)
        data.append((key, at, i, pick.choice(["a", "a", "b", None]), pick.randint(1, 400) / 4))
    pick.shuffle(data)
    schema = "key string, at timestamp_ntz, id bigint, state string, value double"
    return spark.createDataFrame(data, schema).repartition(5).cache()


def bag(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("cut", CUTS)
def test_running_totals(rows, cut):
    totals = {
        "n": F.lit(1).cast("bigint"),
        "sum": F.col("value").cast("decimal(18,2)"),
        "ids": F.col("id"),
    }
    run = lambda **kw: running_totals(rows, ["key"], ["at", "id"], totals, **kw)
    whole, sliced = run(**ALL_WHOLE), run(**cut)
    assert whole.schema == sliced.schema
    assert bag(whole) == bag(sliced)


def test_running_totals_of_nulls(rows):
    some = F.when(F.col("state").isNotNull(), F.col("id"))
    run = lambda **kw: running_totals(rows, ["key"], ["at"], {"s": some}, **kw)
    assert bag(run(**ALL_WHOLE)) == bag(run(max_group_rows=20, slices=7))


@pytest.mark.parametrize("cut", CUTS)
@pytest.mark.parametrize("width", [1, 3, 40])
def test_running_and_moving(rows, cut, width):
    """The widest frame reaches over several of the smaller slices."""
    holes = rows.withColumn("value", F.when(F.col("id") % 5 > 0, F.col("value")))
    run = lambda **kw: running_and_moving(
        holes, ["key"], ["at", "id"], "value", width, **kw
    )
    whole, sliced = run(**ALL_WHOLE), run(**cut)
    assert whole.schema == sliced.schema
    assert bag(whole) == bag(sliced)


@pytest.mark.parametrize("cut", CUTS)
@pytest.mark.parametrize("order", [["state", "value"], ["state"], ["id"]])
@pytest.mark.parametrize("descending", [False, True])
def test_ranked(rows, cut, order, descending):
    """Few different values, nulls among them, and as many as rows."""
    run = lambda **kw: ranked(rows, ["key"], order, descending, **kw)
    whole, sliced = run(**ALL_WHOLE), run(**cut)
    assert whole.dtypes == sliced.dtypes
    assert bag(whole) == bag(sliced)
    assert bag(ranked(rows, [], order, descending, **ALL_WHOLE)) == bag(ranked(rows, [], order, descending, **cut))


@pytest.mark.parametrize("least", [0, 100])
@pytest.mark.parametrize("days, step", [(1, 4000), (3, 86_400), (40, 86_399)])
@pytest.mark.parametrize("scale", [2, None])
def test_trailing_range(rows, least, days, step, scale):
    """Times far apart and close together, before 1970 too, with repeats and nulls."""
    second = F.when(F.col("id") % 11 > 0, F.floor(F.col("id") / 2) * step - 3_000_000)
    spread = rows.withColumn("at", F.timestamp_seconds(second).cast("timestamp_ntz")).withColumn(
        "value", F.when(F.col("id") % 5 > 0, F.col("value"))
    )
    run = lambda n: trailing_range(spread, ["key"], "at", "value", days, scale, n)
    whole, sliced = run(10**9), run(least)
    assert whole.dtypes == sliced.dtypes
    assert bag(whole) == bag(sliced)


def test_large_groups_cost_no_further_reading(spark, rows):
    """The input is computed to count its groups and once more, whatever the groups are."""
    for least in (0, 100, 10**9):
        read = spark.sparkContext.accumulator(0)

        def counted(batches):
            for batch in batches:
                read.add(len(batch))
                yield batch

        source = rows.mapInPandas(counted, rows.schema)
        scd2_history(source, "key", "at", ["state"], max_group_rows=least, slices=3).collect()
        assert read.value == 2 * 600


@pytest.mark.parametrize("cut", CUTS)
def test_history(rows, cut):
    run = lambda **kw: scd2_history(rows, "key", "at", ["state"], **kw)
    whole, sliced = run(**ALL_WHOLE), run(**cut)
    assert bag(whole) == bag(sliced)
    current = sliced.filter("is_current").groupBy("key").count()
    assert current.filter("count <> 1").isEmpty()
    assert current.count() == rows.select("key").distinct().count()


def test_history_of_one_state(spark):
    """One version that spans every slice, and one that starts in the last row."""
    data = [("x", START + timedelta(hours=i), "same" if i < 99 else "new") for i in range(100)]
    df = spark.createDataFrame(data, "key string, at timestamp_ntz, state string")
    history = scd2_history(df, "key", "at", ["state"], max_group_rows=10, slices=8)
    assert bag(history.select("state", "valid_from", "valid_to", "is_current")) == [
        ("new", data[99][1], None, True),
        ("same", START, data[99][1], False),
    ]


@pytest.mark.parametrize("cut", CUTS)
def test_point_in_time(rows, cut):
    history = scd2_history(rows, "key", "at", ["state"]).filter("key is not null")
    # Closing some versions early leaves gaps in which nothing is valid.
    gap = F.when(
        F.minute("valid_from") % 5 == 0, F.col("valid_from") + F.expr("interval 30 seconds")
    ).otherwise(F.col("valid_to"))
    history = history.withColumn("valid_to", gap)
    facts = rows.select(
        "key", "id", (F.col("at") + F.expr("interval 45 seconds")).alias("asked")
    ).unionByName(rows.select("key", (F.col("id") + 1000).alias("id"), F.col("at").alias("asked")))
    run = lambda **kw: point_in_time_join(facts, history, "key", "asked", **kw)
    sliced = run(**cut)
    assert bag(run(**ALL_WHOLE)) == bag(sliced)
    assert sliced.count() == facts.count()
    h = history.select(
        F.col("key").alias("k"), "valid_from", "valid_to", "state"
    )
    inside = (F.col("valid_from") <= F.col("asked")) & (
        F.col("valid_to").isNull() | (F.col("asked") < F.col("valid_to"))
    )
    brute = facts.join(h, (F.col("key") == F.col("k")) & inside, "left")
    cols = ["key", "id", "asked", "state", "valid_from"]
    assert bag(brute.select(*cols)) == bag(sliced.select(*cols))


def test_point_in_time_of_many_equal_facts(spark):
    """A third of all facts ask about one key at one time."""
    t = [START + timedelta(days=i) for i in range(30)]
    history = spark.createDataFrame(
        [("k", t[i], t[i + 1], i) for i in range(29)],
        "k string, valid_from timestamp_ntz, valid_to timestamp_ntz, version int",
    )
    facts = spark.createDataFrame(
        [("k", t[i % 30]) for i in range(200)] + [("k", t[10])] * 100, "k string, at timestamp_ntz"
    ).repartition(6)
    out = point_in_time_join(facts, history, "k", "at", max_group_rows=50, slices=12)
    found = [(r["at"], r.version) for r in out.collect()]
    assert len(found) == 300
    assert all(v == (t.index(at) if at < t[29] else None) for at, v in found)


@pytest.mark.parametrize("cut", CUTS)
def test_lookup(rows, cut):
    lookup = extract_lookup(rows, ["state", "value"], "number", **cut)
    pairs = sorted({(r.state, r.value) for r in rows.collect() if r.state is not None})
    assert bag(lookup) == sorted(
        ((s, v, i) for i, (s, v) in enumerate(pairs, 1)), key=repr
    )


@pytest.mark.parametrize("cut", CUTS)
def test_quartiles(rows, cut):
    holes = rows.withColumn("value", F.when(F.col("id") % 7 > 0, F.col("value")))
    stats = distribution_stats(holes, "key", "value", **cut)
    exact = holes.groupBy("key").agg(
        F.count("value"), F.min("value"), F.max("value"),
        F.round(F.avg("value"), 6), F.round(F.stddev("value"), 6),
        *[F.round(F.percentile("value", p), 6) for p in (0.25, 0.5, 0.75)],
    )
    rounded = [F.round(c, 6) for c in ("mean", "stddev", "q1", "median", "q3")]
    assert bag(stats.select("key", "n", "min", "max", *rounded)) == bag(exact)


def test_funnel(rows):
    steps = ["a", "b", "a"]
    run = lambda n: bag(funnel_conversion(rows, "key", "at", "state", steps, n))
    by_key = {}
    for r in sorted(rows.collect(), key=lambda r: r.at):
        if r.key is not None:
            reached = by_key.setdefault(r.key, 0)
            if reached < 3 and r.state == steps[reached]:
                by_key[r.key] += 1
    n = [sum(v >= k for v in by_key.values()) for k in (1, 2, 3)]
    expected = sorted(
        ((k + 1, steps[k], n[k], n[k] / n[k - 1] if k else None) for k in range(3)), key=repr
    )
    assert run(10**9) == run(100) == run(0) == expected


def test_slices_are_ordered_ranges(rows):
    cut = slice_groups(rows.filter("key = 'hot'"), ["key"], ["at"], 6)
    ranges = cut.groupBy("_slice").agg(F.min("at").alias("lo"), F.max("at").alias("hi")).collect()
    ranges.sort(key=lambda r: r._slice)
    assert len(ranges) > 3
    assert all(a.hi < b.lo for a, b in zip(ranges, ranges[1:]))
