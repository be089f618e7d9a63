"""Overlapping intervals against every pair tried."""

import random

import pytest

from millrace.operators.intervals import overlap_join

LEFT, RIGHT = "l bigint, lb bigint, le bigint, note string", "r int, rb bigint, re bigint"


def pairs(left, right):
    return sorted(
        (a[0], b[0])
        for a in left
        for b in right
        if None not in (*a[1:3], *b[1:]) and a[1] <= a[2] and b[1] <= b[2] and a[1] <= b[2] and b[1] <= a[2]
    )


def joined(spark, left, right, **options):
    sides = spark.createDataFrame(left, LEFT).repartition(3), spark.createDataFrame(right, RIGHT).repartition(2)
    return overlap_join(*sides, ("lb", "le"), ("rb", "re"), **options)


def intervals(n, seed, hot=False):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        begin = rng.randrange(-200, 2000)
        if hot and rng.random() < 1 / 3:
            begin = 500  # a third of all begins at one place
        length = 5000 if rng.random() < 0.05 else rng.choice([0, 1, 5, 30, -1])  # some cross every slice
        rows.append((k, begin, begin + length))
    return rows


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("block_rows", [8, 2048])
def test_equals_every_pair_tried(spark, hot, block_rows):
    left = [(*r, "x") for r in intervals(150, 1, hot)] + [(900, None, 5, "x"), (901, 5, None, None)]
    right = intervals(120, 2, hot) + [(900, None, None)] + [(7, 500, 500)] * 5
    found = joined(spark, left, right, block_rows=block_rows).select("l", "r").collect()
    assert sorted(map(tuple, found)) == pairs(left, right)


def test_ends_belong_to_an_interval(spark):
    left = [(1, 0, 10, "a"), (2, 10, 20, "a"), (3, 21, 21, "a"), (4, 2**62, 2**62, "far")]
    right = [(1, 10, 10), (2, -5, 0), (3, 20, 21), (4, -(2**62), 2**62)]
    found = joined(spark, left, right)
    assert found.columns == ["l", "lb", "le", "note", "r", "rb", "re"]
    assert sorted((x.l, x.r) for x in found.collect()) == pairs(left, right)


@pytest.mark.parametrize("left, right", [([], []), ([(1, 1, 2, "")], []), ([], [(1, 1, 2)])])
def test_an_empty_side_has_no_pairs(spark, left, right):
    assert joined(spark, left, right).collect() == []


def test_a_name_on_both_sides_is_refused(spark):
    df = spark.createDataFrame([], "b bigint, e bigint")
    with pytest.raises(ValueError, match="both sides"):
        overlap_join(df, df, ("b", "e"), ("b", "e"))


def test_no_block_is_larger_than_agreed(spark, monkeypatch):
    """With a third of all rows at one place, tasks hold blocks and not the place."""
    from millrace.operators import intervals as module

    real = module._matched

    def checked(*args):
        run = real(*args)

        def inner(points, others):
            assert len(points) <= 12 and len(others) <= 12, (len(points), len(others))
            return run(points, others)

        return inner

    monkeypatch.setattr(module, "_matched", checked)
    left, right = [(*r, "") for r in intervals(200, 3, True)], intervals(200, 4, True)
    found = joined(spark, left, right, block_rows=8).select("l", "r").collect()
    assert sorted(map(tuple, found)) == pairs(left, right)
