"""Keys, dependencies and references against brute force over all sets and pairs of columns."""

import datetime
import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from millrace.operators import agreement
from millrace.operators import discovery as ops

NAMES = ["a", "b", "c", "d", "e"]


def slow(rows, names, max_columns):
    """Every set tried; the minimal ones kept."""

    def classes(of):
        return len({tuple(r[i] for i in of) for r in rows})

    if not rows:
        return set()
    sets = [s for k in range(max_columns + 1) for s in combinations(range(len(names)), k)]
    keys = [s for s in sets if classes(s) == len(rows)]
    holds = [
        (s, a) for s in sets if len(s) < max_columns for a in range(len(names))
        if a not in s and classes(s) == classes((*s, a)) and not any(set(k) <= set(s) for k in keys)
    ]

    def name(s):
        return ",".join(names[i] for i in s)

    found = {("key", name(s), None) for s in keys if not any(set(o) < set(s) for o in keys)}
    found |= {
        ("dependency", name(s), names[a]) for s, a in holds
        if not any(b == a and set(o) < set(s) for o, b in holds)
    }
    return found


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("sample_rows", [10, 100_000])
def test_dependencies_equal_brute_force(spark, seed, sample_rows):
    pick = random.Random(seed)
    rows = []
    for i in range(60):
        a, b = pick.choice([None, 1, 2, 3]), pick.randrange(20)
        c = (a or 0) * 7 % 3 if seed % 2 else pick.randrange(3)
        d = (b + (a or 0)) % 5 if seed % 3 else i
        rows.append((a, b, c, d, 4.0 if seed < 4 else pick.choice([0.5, None])))
    schema = "a int, b bigint, c int, d int, e double"
    found = ops.dependencies(spark.createDataFrame(rows, schema), 3, sample_rows)
    assert {tuple(r) for r in found.collect()} == slow(rows, NAMES, 3)
    assert found.count() == len(slow(rows, NAMES, 3))


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, 2), (1, 2)]])
def test_dependencies_of_very_small_tables(spark, rows):
    found = ops.dependencies(spark.createDataFrame(rows, "`a.b` int, b int"), 2)
    assert {tuple(r) for r in found.collect()} == slow(rows, ["a.b", "b"], 2)


def test_dependencies_make_no_more_rows_in_a_job_than_the_table_has(spark, monkeypatch, tmp_path):
    """What many groups contradict is not counted over the table, and sets that nothing contradicts are counted one by one."""
    pick = random.Random(1)
    rows = [(i // 2, i % 2, pick.randrange(40), pick.randrange(40), i // 2 % 50 + i % 2) for i in range(4000)]
    schema = "a int, b int, c int, d int, e int"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "t"))
    table = spark.read.schema(schema).parquet(str(tmp_path / "t"))
    monkeypatch.setattr(ops, "LEAST_ROWS", 100)
    jobs, one, grouping_sets = [], type(table), type(table).groupingSets

    def counted(df, sets, *columns):
        jobs.append([len(df.inputFiles()) > 0 and str(tmp_path) in df.inputFiles()[0], len(sets)])
        return grouping_sets(df, sets, *columns)

    monkeypatch.setattr(one, "groupingSets", counted)
    found = {tuple(r) for r in ops.dependencies(table, 3, 20).collect()}
    assert found == slow(rows, NAMES, 3)
    whole = [n for of_table, n in jobs if of_table]
    # Each key is counted once, each dependency as two sets; without slices a level has up to ten sets.
    assert whole and set(whole) == {1}
    assert len(whole) <= 2 * len(found) + 2


def test_slices_refute_only(spark):
    """Over all slices' sizes what holds is kept; nulls, zeros of both signs and the empty set included."""
    rows = [(i, None if i % 3 else -0.0 if i % 2 else 0.0, i % 7, i % 7 * 2, 1) for i in range(1000)]
    df = spark.createDataFrame(rows, "a int, `b.c` double, c int, d int, e int")
    sets = [frozenset(s) for k in range(4) for s in combinations(df.columns, k)]
    pairs = [(s, a) for s in sets for a in df.columns if a not in s]
    whole = ops._Counts(df)
    for share in (1, 2, 50):
        part = ops._Slices(df, 1000, share)
        assert set(whole.unique(sets)) <= set(part.unique(sets))
        assert set(whole.determined(pairs)) <= set(part.determined(pairs))
    exact = ops._Slices(df, 1000, 1)
    assert set(exact.unique(sets)) == set(whole.unique(sets)) | {frozenset()}
    assert {p for p in exact.determined(pairs) if p[0]} == {p for p in whole.determined(pairs) if p[0]}


def dealt_rows(seed, n):
    """Hot values, nulls, zeros of both signs, values that are no number; b and c hold a key but for one pair of rows."""
    pick = random.Random(seed)
    nan = float("nan")
    rows = []
    for i in range(n):
        day = datetime.date(2024, 1, 1) + datetime.timedelta(pick.randrange(4))
        e = pick.choice([nan, 0.0, -0.0, None, 2.5])
        rows.append((pick.choice([None, None, None, i]), f"k{i // 3}", i % 3, day, e, pick.randrange(n)))
    if seed % 2:
        rows[-1] = (rows[0][0], *rows[0][1:3], *rows[-1][3:])
    return rows


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize(("sample_rows", "most_bytes"), [(40, 1 << 20), (40, 6_000), (100_000, 1 << 20)])
def test_dealt_rows_equal_brute_force(spark, monkeypatch, seed, sample_rows, most_bytes):
    """Many tasks; tasks that do not hold their rows; parts that many rows share a value of."""
    for name, value in {"DEALT_ROWS": 1, "TASK_ROWS": 200, "MOST_BYTES": most_bytes, "LEAST_SHARE": 10}.items():
        monkeypatch.setattr(ops, name, value)
    rows = dealt_rows(seed, 1500)
    df = spark.createDataFrame(rows, "`a.x` int, b string, c int, d date, e double, f bigint")
    found = {tuple(r) for r in ops.dependencies(df, 3, sample_rows).collect()}
    # Python's sets take each value that is no number as another one.
    plain = [(*r[:4], "none" if r[4] != r[4] else r[4], r[5]) for r in rows]
    assert found == slow(plain, df.columns, 3)


def test_dealt_rows_answer_for_every_claim(spark, monkeypatch):
    """Also for what no search would ask, as it follows from something else or has no columns."""
    monkeypatch.setattr(ops, "TASK_ROWS", 100)
    rows = [(i, i % 50, i % 25, 7, i // 50) for i in range(1000)]
    df = spark.createDataFrame(rows, "a int, b int, c int, d int, e int")
    whole = ops._Counts(df)
    dealt = ops._Dealt(whole, 3, 200)
    sets = [frozenset(s) for k in range(4) for s in combinations(df.columns, k)]
    pairs = [(s, a) for s in sets if len(s) < 3 for a in df.columns if a not in s]
    assert set(dealt.unique(sets)) == set(whole.unique(sets))
    assert set(dealt.determined(pairs)) == set(whole.determined(pairs))


def test_large_tables_are_dealt_once_for_many_sets(spark, monkeypatch, tmp_path):
    """Sets that nothing contradicts are compared together, none counted on its own over the table."""
    monkeypatch.setattr(ops, "DEALT_ROWS", 1000)
    pick = random.Random(5)
    rows = [(i, i // 2, i % 2, i // 2 % 40, pick.randrange(9)) for i in range(4000)]
    schema = "a int, b int, c int, d int, e int"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "t"))
    table = spark.read.schema(schema).parquet(str(tmp_path / "t"))
    counted, dealt = [], []
    one = type(table)
    grouping_sets, compared = one.groupingSets, ops._Dealt._compared
    monkeypatch.setattr(one, "groupingSets", lambda df, *a: counted.append(a[0]) or grouping_sets(df, *a))
    monkeypatch.setattr(ops._Dealt, "_compared", lambda self, *a: dealt.append(a[0]) or compared(self, *a))
    found = {tuple(r) for r in ops.dependencies(table, 3, 400).collect()}
    assert found == slow(rows, NAMES, 3)
    assert {("key", "a", None), ("key", "b,c", None), ("dependency", "b", "d")} <= found
    assert not counted
    assert 0 < len(dealt) <= 3


def test_a_task_that_cannot_hold_its_rows_says_so():
    claims = {0: {(0,): agreement.Claims(key=4, dependents={1: 5}), (0, 1): agreement.Claims(key=6)}}
    rows = pa.record_batch({"a": [1, 1, 2, 2], "b": [1, 1, 1, 2], "task": pa.array([0] * 4, pa.int32())})

    def run(batches, most, whole):
        out = agreement.contradictions(claims, most, whole)(iter(batches))
        return {n for b in out for n in b.column("claim").to_pylist()}

    assert run([rows], 1 << 20, True) == {4, 5, 6}
    halves = [rows.slice(0, 2), rows.slice(2)]
    assert run(halves, halves[0].nbytes, True) == {agreement.NOT_ALL, 4, 6}
    assert run(halves, halves[0].nbytes, False) == {4, 6}
    assert run([rows], 1, True) == {agreement.NOT_ALL}
    assert run([], 1, True) == set()


def test_groups_are_cut_the_same_by_either_sort():
    pick = np.random.default_rng(1)
    codes = [pick.integers(0, 60, 300) for _ in range(2)]
    rows, zeros = np.arange(300), np.zeros(300, np.int64)
    ways = []
    for size in (60, 1 << 53):
        some, groups = agreement._refined(rows, zeros, codes[0], 60)
        some, groups = agreement._refined(some, groups, codes[1], size)
        ways.append({frozenset(some[groups == g].tolist()) for g in np.unique(groups)})
    by_value = {}
    for i, pair in enumerate(zip(*codes)):
        by_value.setdefault(pair, set()).add(i)
    assert ways[0] == ways[1] == {frozenset(g) for g in by_value.values() if len(g) > 1}


def test_dependencies_refuse_too_many_columns(spark):
    with pytest.raises(ValueError, match="61 columns"):
        ops.dependencies(spark.range(1).selectExpr(*[f"id AS c{i}" for i in range(61)]), 1)


@pytest.mark.parametrize("least", [1.0, 0.5])
def test_inclusions_equal_sets(spark, least):
    """70 columns, so that a set takes more than one word; a hot value and the null hold most rows."""
    pick = random.Random(3)
    values = [[pick.choice([None, 7, 7, pick.randrange(40)]) for _ in range(200)] for _ in range(70)]
    values[5], values[6] = [None] * 200, [7] * 200
    names = [f"c{i}" for i in range(70)]
    wide = spark.createDataFrame(list(zip(*values[:40])), ", ".join(f"{n} bigint" for n in names[:40]))
    small = spark.createDataFrame(list(zip(*values[40:])), ", ".join(f"{n} smallint" for n in names[40:]))
    columns = [("wide" if i < 40 else "small", n) for i, n in enumerate(names)]
    found = ops.inclusions({"wide": wide, "small": small}, columns, least)
    sets = {f"{t}.{c}": set(v) - {None} for (t, c), v in zip(columns, values)}
    expected = {
        (x, y, len(sets[x]), len(sets[x] & sets[y])) for x in sets for y in sets
        if x != y and sets[x] & sets[y] and len(sets[x] & sets[y]) >= least * len(sets[x])
    }
    rows = [tuple(r) for r in found.collect()]
    assert set(rows) == expected and len(rows) == len(expected)
    assert rows and not any("wide.c5" in r[:2] for r in rows)


def test_inclusions_compare_types_that_fit(spark):
    df = spark.createDataFrame(
        [(1, "1", 1.0, bytearray(b"1"), 0.0), (2, "2", 2.0, bytearray(b"2"), -0.0)],
        "n int, s string, f double, x binary, z double",
    )
    other = spark.createDataFrame([(1, 0.0), (2, 1.0), (3, 2.0)], "n bigint, f double")
    columns = [("df", c) for c in df.columns] + [("other", c) for c in other.columns]
    found = ops.inclusions({"df": df, "other": other}, columns)
    assert {tuple(r) for r in found.collect()} == {
        ("df.n", "other.n", 2, 2), ("df.f", "other.f", 2, 2), ("df.z", "other.f", 1, 1),
    }


def test_inclusions_of_empty_and_wrong_input(spark):
    empty = spark.createDataFrame([], "a int, b int, l array<int>")
    assert ops.inclusions({"t": empty}, [("t", "a"), ("t", "b")]).collect() == []
    with pytest.raises(ValueError, match="array"):
        ops.inclusions({"t": empty}, [("t", "l")])
    with pytest.raises(ValueError, match="twice"):
        ops.inclusions({"t": empty}, [("t", "a"), ("t", "a")])


def test_inclusions_shuffle_values_once(spark, capsys):
    df = spark.range(10).selectExpr("id AS a", "id AS b")
    ops.inclusions({"t": df}, [("t", "a"), ("t", "b")]).explain()
    assert capsys.readouterr().out.count("hashpartitioning(kind") == 1
