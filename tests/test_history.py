"""History merged load by load against history of all changes at once."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.multisource import scd2_history
from millrace.session import scratch_path
from millrace.sources import history, journal
from millrace.sources.tables import table

SCHEMA = "k string, t int, a string, b int"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def merged(spark, loads, root=None, **options):
    root = root or scratch_path(spark, "test-history")
    for load in loads:
        changes = spark.createDataFrame(load, SCHEMA)
        history.merge_history(changes, root, "k", "t", ["a", "b"], **{"buckets": 5, **options})
    return root


def stored(spark, root):
    return rows_of(history.read_history(spark, root, "k", "t", SCHEMA))


def at_once(spark, rows):
    return rows_of(scd2_history(spark.createDataFrame(rows, SCHEMA), "k", "t", ["a", "b"]))


def changes(n, seed, hot):
    rng = random.Random(seed)
    rows = {}
    for _ in range(n):
        key = hot if rng.random() < 1 / 3 else rng.choice(["x", "y", "z", None, "w"])
        rows[key, rng.randrange(5 * n)] = (rng.choice(["p", "q", None]), rng.choice([1, None]))
    return [(*k, *v) for k, v in rows.items()]


@pytest.mark.parametrize(
    "hot, options", [("hot", {}), *[(hot, {"max_group_rows": 20, "slices": 6}) for hot in ("hot", None)]]
)
def test_loads_in_any_order_give_the_history_of_all_changes(spark, hot, options):
    rows = changes(150, 1, hot)
    random.Random(2).shuffle(rows)
    root = merged(spark, [rows[:70], rows[70:80], rows[80:]], **options)
    assert stored(spark, root) == at_once(spark, rows)


def test_a_late_change_splits_a_closed_version_at_the_changes_within(spark):
    first = [("x", 1, "p", 1), ("x", 3, "p", 1), ("x", 5, "q", 1)]
    root = merged(spark, [first])
    assert [r[3:5] for r in stored(spark, root)] == [(1, 5), (5, None)]
    merged(spark, [[("x", 2, "r", 1)]], root)
    assert [(r[1], *r[3:]) for r in stored(spark, root)] == [
        ("p", 1, 2, False), ("p", 3, 5, False), ("q", 5, None, True), ("r", 2, 3, False)
    ]
    # Equal values split nothing; the same key and time replaces.
    merged(spark, [[("x", 4, "p", 1)], [("x", 2, "p", 1)]], root)
    assert [r[3:5] for r in stored(spark, root)] == [(1, 5), (5, None)]


def test_other_folders_keep_their_files(spark):
    rows = changes(60, 3, "x")
    root = merged(spark, [rows], buckets=32)

    def files():
        versions = spark.read.parquet(f"{root}/versions")
        found = versions.select(history.BUCKET, F.input_file_name().alias("file")).distinct().collect()
        return {(r[history.BUCKET], r.file) for r in found}

    before = files()
    merged(spark, [[("y", 10_000, "new", 1)]], root, buckets=32)
    own = {f for f in files() if f not in before}
    assert len({b for b, _ in own}) == 1 and len({b for b, _ in before}) > 2
    assert {f for f in before if f[0] not in {b for b, _ in own}} <= files()
    # A load of no change leaves every file.
    now = files()
    merged(spark, [[]], root, buckets=32)
    assert files() == now


def test_repeated_loads_and_rows(spark):
    rows = [("x", 1, "p", 1), ("x", 1, "q", 1), ("x", 1, "q", 1), (None, 1, None, None), ("y", None, "n", 1)]
    root = merged(spark, [rows, rows, rows[::-1]])
    kept = [("x", 1, "q", 1), (None, 1, None, None), ("y", None, "n", 1)]
    assert [r[:4] for r in stored(spark, root)] == sorted([(k, a, b, t) for k, t, a, b in kept], key=repr)


@pytest.mark.parametrize("name", ["log", "overwrite_partitions", "mark", "forget"])
def test_a_load_that_is_cut_off_is_finished_by_the_next(spark, monkeypatch, name):
    rows = changes(40, 5, "x")
    root = merged(spark, [rows[:20]])
    real = getattr(journal, name)

    def lost(*args):
        real(*args)
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(journal, name, lost)
        with pytest.raises(RuntimeError, match="lost"):
            merged(spark, [rows[20:]], root)
    merged(spark, [rows[20:]], root)
    assert stored(spark, root) == at_once(spark, rows) and journal.entries(spark, f"{root}/journal") == []


def test_extra_columns_are_left_out(spark, small):
    events = table(spark, small, "events").withColumn("_load", F.lit(1))
    root = scratch_path(spark, "test-extra")
    history.merge_history(events, root, "user_id", "ts", ["event_type"])
    found = history.read_history(spark, root, "user_id", "ts", "user_id bigint, ts timestamp_ntz, event_type string")
    assert rows_of(found) == rows_of(scd2_history(events, "user_id", "ts", ["event_type"]))
