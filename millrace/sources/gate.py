"""Tables that a load replaces only if its rows keep the rules.

Each load is written to a folder of its own, and the rules are counted by the same pass that
writes. A mark in the folder publishes it; readers take the latest published one. So a load that
breaks a rule, or is lost on the way, leaves the table as it was. A table has one writer at a time.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.session import path_exists, remove_path
from millrace.sources.journal import mark

PUBLISHED = "_PUBLISHED"


@dataclass(frozen=True)
class GateReport:
    published: bool
    n_rows: int
    #: Rows that break each rule, and whether these are too many.
    broken: dict[str, int] = field(default_factory=dict)
    refused: list[str] = field(default_factory=list)


def gated_write(
    df: DataFrame,
    path: str,
    rules: dict[str, Column],
    tolerated: dict[str, float] | None = None,
    least_rows: int = 1,
) -> GateReport:
    """Write ``df`` as the table's next version and publish it if the counts hold.

    ``rules`` are conditions on a row; null breaks one. Of a rule's rows a share of ``tolerated`` (0
    where not named) may break it. Fewer rows than ``least_rows`` are refused too, so an
    empty load needs 0. A refused version is removed. ``df`` is read once; counts are those of the
    rows written, each task's once however often it is tried.
    """
    spark, tolerated = df.sparkSession, tolerated or {}
    unknown = set(tolerated) - set(rules)
    if unknown:
        raise ValueError(f"tolerated without a rule: {sorted(unknown)}")
    version = f"{path}/v{time.time_ns():020d}-{uuid.uuid4().hex}"
    seen = Observation()
    breaks = [
        F.count(F.when(~F.coalesce(rule, F.lit(False)), 1)).alias(f"r{k}") for k, rule in enumerate(rules.values())
    ]
    df.observe(seen, F.count(F.lit(1)).alias("n"), *breaks).write.parquet(version)
    counts = seen.get
    broken = {name: counts[f"r{k}"] for k, name in enumerate(rules)}
    refused = [name for name, n in broken.items() if n > tolerated.get(name, 0) * counts["n"]]
    if counts["n"] < least_rows:
        refused.append("least_rows")
    if refused:
        remove_path(spark, version)
    else:
        mark(spark, version, PUBLISHED)
    return GateReport(not refused, counts["n"], broken, refused)


def versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of the published versions, oldest first."""
    if not path_exists(spark, path):
        return []
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    found = sorted(f"{path}/{status.getPath().getName()}" for status in listed)
    return [version for version in found if path_exists(spark, f"{version}/{PUBLISHED}")]


def read_published(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The latest published version; no rows where there is none."""
    found = versions(spark, path)
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(found[-1])


def drop_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove all published versions but the last ``keep`` (at least one); readers of older ones must be done."""
    for version in versions(spark, path)[: -max(keep, 1)]:
        remove_path(spark, f"{version}/{PUBLISHED}")
        remove_path(spark, version)
