"""Fixed-width lines: written, read in ranges and with pushed filters, and streamed over restarts."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.session import scratch_path
from millrace.sources import fixed_width as ops
from millrace.streaming import run

COLUMNS = "id bigint, at timestamp_ntz, name string, size double, flag boolean, price decimal(9,2)"
WIDTHS = (6, 26, 9, 22, 5, 10)


@pytest.fixture(scope="module")
def layout(spark):
    return ops.Layout(StructType.fromDDL(COLUMNS), WIDTHS)


def made(spark, ids):
    pick = random.Random(len(ids))
    start = datetime(2024, 1, 1)
    rows = [
        (i, start + timedelta(microseconds=i * 1_234_567), pick.choice(["été", "a b", "日本", None]),
         pick.choice([None, -0.5, 1e300, float(i)]), pick.choice([True, False, None]), None)
        for i in ids
    ]
    return spark.createDataFrame(rows, COLUMNS).withColumn("price", F.expr("cast(id / 4 as decimal(9,2))"))


def bag(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def stored(spark, layout):
    path = scratch_path(spark, "fixed")
    df = made(spark, range(500)).repartition(3).cache()
    ops.write(df, path, layout)
    return path, df


def test_round_trip(spark, layout, stored):
    path, df = stored
    back = ops.read(spark, path, layout)
    assert back.schema == df.select(back.columns).schema or back.dtypes == df.dtypes
    assert bag(back) == bag(df)


@pytest.mark.parametrize("split", [1, 100, 1000])
def test_ranges_of_any_size_give_each_line_once(spark, layout, stored, split, monkeypatch):
    path, df = stored
    back = ops._options(spark.read, layout, ["id"]).option("splitbytes", split).load(path)
    assert sorted(r.id for r in back.collect()) == list(range(500))
    line = layout.line_bytes
    assert back.rdd.getNumPartitions() >= 500 * line // max(split, line) // 2


CONDITIONS = [
    "id = 7", "id > 490", "id >= 490 and id < 495", "id in (1, 2, 1000)", "name is null", "name is not null and id <= 20",
    "name = 'été'", "flag", "not flag", "at < timestamp_ntz'2024-01-01 00:01:00'", "price = 2.5", "size > 3", "id = 3 or id = 5",
    "not (id > 5)", "name <> 'a b'", "id in (1, null)", "id <=> 3", "name like 'a%'",
]


@pytest.mark.parametrize("condition", CONDITIONS)
def test_filters_mean_what_sql_means(spark, layout, stored, condition):
    path, df = stored
    found = ops.read(spark, path, layout).filter(condition)
    assert bag(found) == bag(df.filter(condition))


def test_filters_are_pushed(spark, layout, stored, capsys):
    ops.read(spark, stored[0], layout, ["id", "name"]).filter("id > 490").explain()
    plan = capsys.readouterr().out
    assert "Filter (" not in plan.replace("Filter (isnotnull", "")


def test_columns_without_any_and_empty_folders(spark, layout, stored):
    assert ops.read(spark, stored[0], layout).count() == 500
    empty = scratch_path(spark, "fixed")
    assert ops.read(spark, empty, layout).collect() == []
    ops.write(made(spark, range(1)).limit(0), empty, layout)
    assert ops.read(spark, empty, layout).collect() == []


@pytest.mark.parametrize("name", ["", " a", "a ", "a\nb", "0123456789", "日本日本"])
def test_values_that_would_not_come_back_are_refused(spark, layout, name):
    df = made(spark, range(1)).withColumn("name", F.lit(name))
    with pytest.raises(Exception, match="no place in 9 bytes"):
        ops.write(df, scratch_path(spark, "fixed"), layout)


@pytest.mark.parametrize("tail, says", [(b"x", "not whole lines"), (b"x" * 79, "does not end there"), (b"x" * 78 + b"\n", "x")])
def test_broken_files_fail(spark, layout, tail, says):
    path = scratch_path(spark, "fixed")
    ops.write(made(spark, range(5)).coalesce(1), path, layout)
    name = next(n for n in os.listdir(path) if n.startswith("part-"))
    with open(f"{path}/{name}", "ab") as file:
        file.write(tail)
    with pytest.raises(Exception, match=says):
        ops.read(spark, path, layout).collect()


def test_wrong_layouts_and_columns(spark, layout, stored):
    with pytest.raises(ValueError, match="one width"):
        ops.Layout(layout.columns, (1, 2))
    with pytest.raises(Exception, match="no column id int"):
        ops._options(spark.read, layout, ["id"]).schema("id int").load(stored[0]).collect()


def test_stream_takes_loads_and_grown_files_once(spark, layout):
    path, out, checkpoint = (scratch_path(spark, f"fixed-{n}") for n in ("in", "out", "checkpoint"))
    os.makedirs(path)

    def arrived():
        run.append_to(ops.read_stream(spark, path, layout, ["id", "name"]), out, checkpoint)
        return sorted(r.id for r in spark.read.schema("id bigint, name string").parquet(out).collect())

    ops.write(made(spark, range(10)).repartition(3), f"{path}/load-1", layout)
    assert arrived() == list(range(10))
    assert arrived() == list(range(10))  # nothing new
    ops.write(made(spark, range(10, 15)).coalesce(1), f"{path}/load-2", layout)
    ops.write(made(spark, range(15, 20)).repartition(2), f"{path}/load-3", layout)
    assert arrived() == list(range(20))
    # The last file grows, by a line and a half and then by the rest.
    last = max(f"{path}/load-3/{n}" for n in os.listdir(f"{path}/load-3") if n.startswith("part-"))
    extra = scratch_path(spark, "fixed")
    ops.write(made(spark, range(20, 22)).coalesce(1), extra, layout)
    lines = b"".join(open(f"{extra}/{n}", "rb").read() for n in sorted(os.listdir(extra)) if n.startswith("part-"))
    half = layout.line_bytes * 3 // 2
    with open(last, "ab") as file:
        file.write(lines[:half])
    assert arrived() == list(range(21))
    with open(last, "ab") as file:
        file.write(lines[half:])
    assert arrived() == list(range(22))
    # A load that is still written is not seen, nor what comes after it.
    ops.write(made(spark, range(22, 24)).coalesce(1), f"{path}/load-4", layout)
    os.makedirs(f"{path}/load-4/_temporary")
    ops.write(made(spark, range(24, 25)).coalesce(1), f"{path}/load-5", layout)
    assert arrived() == list(range(22))
    os.rmdir(f"{path}/load-4/_temporary")
    assert arrived() == list(range(25))
