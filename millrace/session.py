"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUNTIME_SETTINGS = {
    # A value that does not fit fails the job instead of becoming null.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where an aggregate on the same key follows it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

PACKAGE_ROOT = str(Path(__file__).resolve().parent.parent)
_scratch_roots: dict[str, str] = {}
_watched: list[list[str]] = []


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings that results and skew handling rely on.

    They stay set on the caller's session. Sizes that depend on the cluster, such as
    the number of shuffle partitions, stay as the cluster has them.
    """
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    # Python workers find this package where the driver does, whatever folder either was started in.
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if PACKAGE_ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *paths])
    return spark


def local_session(cpus: int | str = "*", memory: str = "12g") -> SparkSession:
    """Single-machine session for tests and benchmarks."""
    partitions = "8" if cpus == "*" else str(cpus)
    return prepare(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("millrace")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", partitions)
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    Only a local master may do without the setting: it gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _scratch_roots:
        _scratch_roots[app] = tempfile.mkdtemp(prefix="millrace-")
    return _scratch_roots[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other call gets."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    for made in _watched:
        made.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove what jobs in the ``with`` block put into the shared folder.

    Leave the block only when the job's result is written: a DataFrame that reads an
    intermediate table has nothing to read afterwards.
    """
    made: list[str] = []
    _watched.append(made)
    try:
        yield
    finally:
        _watched[:] = [other for other in _watched if other is not made]
        for path in made:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def stage(df: DataFrame, label: str = "stage", partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage so that a lost executor re-reads files instead of repeating the
    work, and gives the planner true file sizes for its broadcast decisions.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any storage that Spark can open."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def remove_path(spark: SparkSession, uri: str) -> None:
    """Remove a file or folder that is given by its URI."""
    where = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def broadcast_if_small(
    df: DataFrame, max_rows: int = 500_000, max_bytes: int = 64 * 1024 * 1024
) -> DataFrame:
    """Hint a broadcast only after measuring that ``df`` stays within both bounds.

    A larger side comes back unhinted: it is then joined by shuffle, with skewed
    partitions split at run time.
    """
    width = sum(
        (F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in df.columns),
        F.lit(0).cast("bigint"),
    )
    size = (
        df.limit(max_rows + 1)
        .agg(F.count(F.lit(1)).alias("rows"), F.sum(width).alias("bytes"))
        .first()
    )
    if size["rows"] <= max_rows and (size["bytes"] or 0) <= max_bytes:
        return F.broadcast(df)
    return df


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the length of a ``with`` block."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
