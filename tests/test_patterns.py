"""Row patterns against attempts tried one by one."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.patterns import Pattern, match_rows, one, some

PATTERNS = {
    "view clicks purchase": [one("v"), some("c"), one("p")],
    "one step": [one("p")],
    "attempts that share rows": [one("v", "c"), some("c", "p"), one("c"), one("p")],
    "all alike": [one("v"), one("v"), one("v")],
}


def tried(symbols, steps):
    """Matches as (first, last): at each row the oldest attempt that can end there."""
    found, attempts = [], []  # attempts: (first, step)
    for k, symbol in enumerate(symbols):
        following, ended = [], None
        for first, step in [*attempts, (k, -1)]:
            if symbol in steps[step + 1].symbols:
                if step + 2 == len(steps):
                    ended = first if ended is None else ended
                else:
                    following.append((first, step + 1))
            if step >= 0 and steps[step].many and symbol in steps[step].symbols:
                following.append((first, step))
        if ended is not None:
            found.append((ended, k))
            following = []
        attempts = following
    return found


def rows(seed, hot, n=240):
    rng = random.Random(seed)
    keys = [hot if rng.random() < 0.4 else rng.choice(["a", "b", None, "d"]) for _ in range(n)]
    return [(key, rng.randrange(10**6), k, rng.choice(["v", "c", "c", "p", "e", None])) for k, key in enumerate(keys)]


def expected(data, steps):
    out = []
    for key in {r[0] for r in data}:
        own = sorted((r for r in data if r[0] == key and r[3] is not None), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        for first, last in tried([r[3] for r in own], steps):
            out.append((key, own[first][2], own[last][2], last - first + 1))
    return sorted(out, key=repr)


@pytest.mark.parametrize("name", sorted(PATTERNS))
@pytest.mark.parametrize("slices, hot", [(1, "a"), (7, "hot"), (40, None)])
def test_equals_attempts_tried_one_by_one(spark, name, slices, hot):
    data = rows(slices, hot) + [("n", None, 1000, "v"), ("n", 0, 1001, "c"), ("n", 1, 1002, "p")]
    df = spark.createDataFrame(data, "k string, t int, id int, s string").repartition(4)
    found = match_rows(df, ["k"], ["t", "id"], "id", F.col("s"), Pattern(PATTERNS[name]), slices)
    assert found.columns == ["k", "first", "last", "n_rows"]
    got = sorted(map(tuple, found.collect()), key=repr)
    assert got == expected(data, PATTERNS[name]) and got


def test_no_rows_and_several_keys(spark):
    df = spark.createDataFrame([("a", 1, 1, "v"), ("a", 2, 2, "p"), ("a", 1, 3, "p")], "k string, j int, id int, s string")
    pattern = Pattern([one("v"), one("p")])
    assert [tuple(r) for r in match_rows(df, ["k", "j"], ["id"], "id", F.col("s"), pattern).collect()] == [("a", 1, 1, 3, 2)]
    assert match_rows(df.limit(0), ["k"], ["id"], "id", F.col("s"), pattern).collect() == []


def test_patterns_are_checked():
    for steps in ([], [one("a"), some("b")]):
        with pytest.raises(ValueError, match="ends with"):
            Pattern(steps)
    assert len(Pattern(PATTERNS["attempts that share rows"]).table) < 20
