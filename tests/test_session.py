from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from millrace import session


class FakeSession:
    def __init__(self, master, checkpoint=None):
        values = {"spark.checkpoint.dir": checkpoint} if checkpoint else {}
        self.conf = SimpleNamespace(get=lambda name, default=None: values.get(name, default))
        self.sparkContext = SimpleNamespace(master=master, applicationId=f"app-{master}")


def test_the_named_folder_is_used():
    assert session.scratch_root(FakeSession("yarn", "s3a://lake/tmp/")) == "s3a://lake/tmp"


def test_a_cluster_without_a_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_root(FakeSession("yarn"))


def test_only_a_local_master_gets_a_temporary_folder():
    local = FakeSession("local[2]")
    assert session.scratch_root(local) == session.scratch_root(local)


def test_paths_do_not_repeat(spark):
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


def test_broadcast_only_below_the_bound(spark, capsys):
    small = spark.range(10)
    for rows, size, hinted in ((10, 10, True), (9, 10, False), (10, 9, False)):
        session.broadcast_if_small(small, rows, size).explain("extended")
        assert ("strategy=broadcast" in capsys.readouterr().out) is hinted


def test_settings_are_put_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with session.settings(spark, {"spark.sql.shuffle.partitions": "3", "millrace.test": "1"}):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("millrace.test", None) is None


def test_stage_keeps_rows_and_types(spark):
    df = spark.range(5).select(
        "id", F.lit("2024-01-01").cast("timestamp_ntz").alias("t"), F.struct("id").alias("s")
    )
    staged = session.stage(df)
    assert staged.dtypes == df.dtypes
    assert sorted(map(str, staged.collect())) == sorted(map(str, df.collect()))


def test_scratch_is_removed_with_its_block(spark):
    kept = session.stage(spark.range(3))
    with session.scratch(spark):
        inside = session.stage(spark.range(4))
        folder = inside.inputFiles()[0].rsplit("/", 1)[0]
        assert session.path_exists(spark, folder) and inside.count() == 4
    assert not session.path_exists(spark, folder) and kept.count() == 3
