import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from millrace.operators import model as ops

TARGET = StructType(
    [
        StructField("id", LongType(), nullable=False),
        StructField("name", StringType()),
        StructField("size", IntegerType()),
    ]
)


@pytest.fixture(scope="module")
def raw(spark):
    data = [("1", "a", "10"), ("2", None, "20"), ("3", "a", None)]
    return spark.createDataFrame(data, "id string, name string, size string")


def test_conform_gives_names_order_and_types(raw):
    out = ops.conform_schema(raw, TARGET, {"size": F.col("size"), "id": F.col("id")})
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in TARGET]
    assert [tuple(r) for r in out.collect()] == [(1, None, 10), (2, None, 20), (3, None, None)]


def test_conform_refuses_unmapped_required_column(raw):
    with pytest.raises(ValueError, match="id"):
        ops.conform_schema(raw, TARGET, {"name": F.col("name")})


def test_conform_refuses_unknown_column(raw):
    with pytest.raises(ValueError, match="nome"):
        ops.conform_schema(raw, TARGET, {"id": F.col("id"), "nome": F.col("name")})


@pytest.mark.parametrize("source", ["name", "size"])
def test_conform_fails_on_bad_or_missing_required_value(raw, source):
    with pytest.raises(PySparkException):
        ops.conform_schema(raw, TARGET, {"id": F.col(source)}).collect()


def test_profile_counts_nulls(raw):
    rows = {r.column_name: tuple(r)[1:] for r in ops.profile_columns(raw).collect()}
    assert rows == {"id": (3, 0, 3), "name": (3, 1, 1), "size": (3, 1, 2)}


def test_profile_of_an_empty_table(raw):
    rows = {tuple(r) for r in ops.profile_columns(raw.limit(0)).collect()}
    assert rows == {("id", 0, 0, 0), ("name", 0, 0, 0), ("size", 0, 0, 0)}


def test_compat_view_restores_unmatched_as_null(spark):
    core = spark.createDataFrame([(1, 10), (2, -1)], "id int, kind_key int")
    kinds = spark.createDataFrame([(10, "x")], "kind_key int, kind string")
    view = ops.compat_view(core, {"kind_key": kinds}, ["id", "kind"])
    assert sorted(map(tuple, view.collect())) == [(1, "x"), (2, None)]


def test_constraints(spark):
    parent = spark.createDataFrame([(1, 5), (2, 5), (2, 9)], "id int, top int")
    child = spark.createDataFrame(
        [(1, 4), (1, 6), (3, 1), (None, 1), (3, None)], "parent_id int, size int"
    )
    rules = [
        ops.UniqueKey("unique", "parent", ("id",)),
        ops.ForeignKey("foreign", "child", ("parent_id",), "parent", ("id",)),
        ops.Domain("domain", "child", F.col("size") < 5),
        ops.Domain("always", "child", F.lit(True)),
        ops.CrossTable("cross", "child", ("parent_id",), "parent", ("id",),
                       F.col("size") <= F.col("top")),
    ]
    found = ops.check_constraints({"parent": parent, "child": child}, rules)
    assert {r.rule: (r.checked, r.violations) for r in found.collect()} == {
        "unique": (3, 1),
        "foreign": (5, 2),
        "domain": (5, 1),
        "always": (5, 0),
        "cross": (2, 1),
    }


def test_constraints_on_empty_tables(spark):
    empty = spark.createDataFrame([], "id int")
    rules = [
        ops.UniqueKey("unique", "t", ("id",)),
        ops.ForeignKey("foreign", "t", ("id",), "t", ("id",)),
        ops.Domain("domain", "t", F.col("id") > 0),
    ]
    found = ops.check_constraints({"t": empty}, rules).collect()
    assert {tuple(r) for r in found} == {("unique", 0, 0), ("foreign", 0, 0), ("domain", 0, 0)}


def test_conform_fails_on_a_bad_value_on_any_session(spark):
    from millrace.session import prepare

    spark.conf.set("spark.sql.ansi.enabled", "false")
    prepare(spark)
    df = spark.createDataFrame([("abc",)], "v string")
    target = StructType([StructField("v", IntegerType())])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        ops.conform_schema(df, target, {"v": F.col("v")}).collect()


def test_unique_keys_with_nulls_are_no_copies(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 2), (2, 2)], "a int, b int")
    out = ops.check_constraints({"t": df}, [ops.UniqueKey("u", "t", ("a", "b"))]).first()
    assert (out.checked, out.violations) == (4, 1)
