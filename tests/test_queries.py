"""Every registered query against its SQL twin, and facts of the inputs held fixed."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from oracle import mismatch

ORACLES = contract.oracle_sql()
QUERIES = contract.queries()


def test_every_query_is_listed_once():
    assert set(ORACLES) <= set(QUERIES)
    assert all(re.match(r"op\d+_|pipeline$", name) for name in set(QUERIES) - set(ORACLES))


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0


# (scale, query) -> [(condition, number of rows)]
PINNED = {
    ("sf0.001", "with_and_without"): [("not has_partner", 27)],
    ("sf0.01", "with_and_without"): [("not has_partner", 257)],
    ("sf0.001", "scd2_history"): [("true", 802)],
    ("sf0.01", "scd2_history"): [("true", 8016), ("is_current", 150)],
    ("sf0.001", "stream_session"): [("true", 944)],
    ("sf0.01", "stream_session"): [("true", 9525)],
    ("sf0.001", "stream_interval_join"): [("true", 5)],
    ("sf0.01", "stream_interval_join"): [("true", 33)],
    ("sf0.01", "stream_tumbling"): [("true", 29)],
    ("sf0.01", "stream_sliding"): [("true", 61)],
    ("sf0.01", "stream_dedupe"): [("true", 10000)],
    ("sf0.001", "check_constraints"): [
        ("rule = 'line key is unique' and violations = 1401", 1),
    ],
    ("sf0.01", "check_constraints"): [
        ("rule = 'line key is unique' and violations = 14168", 1),
        ("rule = 'shipped after ordered' and violations = 29157", 1),
    ],
}
PINNED_ROWS = {
    ("sf0.01", "stream_tumbling"): 9671,
    ("sf0.01", "stream_sliding"): 20000,
    ("sf0.01", "stream_session"): 9975,
}


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, small, name, scale, capsys):
    root = small.replace("sf0.001", scale)
    result = QUERIES[name](spark, root)
    assert mismatch(result, root, ORACLES[name]) is None
    result.explain()
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    for condition, rows in PINNED.get((scale, name), []):
        assert result.filter(condition).count() == rows
    if (scale, name) in PINNED_ROWS:
        assert result.agg(F.sum("n_rows")).first()[0] == PINNED_ROWS[scale, name]
