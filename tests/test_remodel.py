import pytest
from pyspark.sql import functions as F

from millrace.operators import remodel as ops


@pytest.fixture(scope="module")
def facts(spark):
    data = [(1, "b", "x"), (2, "a", None), (3, "b", "x"), (4, None, "y"), (5, "a", "x")]
    return spark.createDataFrame(data, "id int, kind string, tone string")


def test_lookup_numbers_from_one_in_order(facts):
    lookup = ops.extract_lookup(facts, ["kind"], "kind_key")
    assert sorted(map(tuple, lookup.collect())) == [("a", 1), ("b", 2)]


def test_lookup_leaves_out_tuples_with_nulls(facts):
    lookup = ops.extract_lookup(facts, ["kind", "tone"], "k")
    assert sorted(map(tuple, lookup.collect())) == [("a", "x", 1), ("b", "x", 2)]


def test_replace_keeps_every_row_and_marks_the_unknown(facts):
    lookup = ops.extract_lookup(facts.filter("kind = 'a'"), ["kind"], "kind_key")
    out = ops.replace_with_keys(facts, lookup, ["kind"], "kind_key")
    assert out.columns == ["id", "tone", "kind_key"]
    assert {r.id: r.kind_key for r in out.collect()} == {1: -1, 2: 1, 3: -1, 4: -1, 5: 1}


def test_hash_key_tells_nulls_and_separators_apart(spark):
    data = [("a", None, "b"), ("a", "b", None), ("a|1:b", "", ""), ("a", "b", ""), (None,) * 3,
            ("-", "-", "-"), ("a", "b|0:", "")]
    df = spark.createDataFrame(data, "x string, y string, z string")
    keyed = ops.hash_key(df, ["x", "y", "z"], "key")
    assert keyed.select("key").distinct().count() == len(data)


def test_split_at_the_first_delimiter_only(spark):
    data = [("4-NOT-SET",), ("none",), (None,), ("-x",), ("y-",)]
    df = spark.createDataFrame(data, "v string")
    out = ops.split_delimited(df, "v", "-", ("code", "text"))
    assert {r.v: (r.code, r.text) for r in out.collect()} == {
        "4-NOT-SET": ("4", "NOT-SET"), "none": ("none", None), None: (None, None),
        "-x": ("", "x"), "y-": ("y", ""),
    }


@pytest.mark.parametrize("delimiter", [".", "||", "\\E"])
def test_split_takes_the_delimiter_literally(spark, delimiter):
    df = spark.createDataFrame([(f"l{delimiter}r{delimiter}s",)], "v string")
    row = ops.split_delimited(df, "v", delimiter, ("a", "b")).first()
    assert (row.a, row.b) == ("l", f"r{delimiter}s")


def test_star_mart_keeps_facts_without_a_dimension(spark, facts):
    dim = spark.createDataFrame([("a", 1.5)], "kind_id string, weight double")
    mart = ops.star_mart(facts, [(dim, {"kind": "kind_id"})])
    assert mart.columns == ["id", "kind", "tone", "weight"]
    assert {r.id: r.weight for r in mart.collect()} == {1: None, 2: 1.5, 3: None, 4: None, 5: 1.5}


def test_reconcile_counts_copies(facts):
    def sides(old, new):
        return {r.side: r.n_rows for r in ops.reconcile_models(old, new).collect()}

    assert sides(facts, facts.select("tone", "kind", "id")) == {"old_only": 0, "new_only": 0}
    twice = facts.unionByName(facts.filter("id = 4"))
    assert sides(facts, twice) == {"old_only": 0, "new_only": 1}
    changed = facts.withColumn("tone", F.coalesce("tone", F.lit("z")))
    assert sides(twice, changed) == {"old_only": 2, "new_only": 1}
    assert sides(facts.limit(0), facts.limit(0)) == {"old_only": 0, "new_only": 0}
