"""Layered storage: land, parse, promote, read, compact, take stock."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions.money import total
from millrace.functions.parsing import TIMESTAMP_FORMAT, checked_csv, checked_json, once, readable
from millrace.operators.etl import Split, dedupe_latest, overwrite_partitions
from millrace.session import path_exists, settings, stage
from millrace.sources import journal

CLEAN_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, value double, props string, "
    "event_date date, event_type string"
)
CLEAN_PARTS = ["event_date", "event_type"]
#: Which of several rows of one event and time stays: the greatest by these.
TIE_BREAK = ["event_type", "user_id", "value", "props"]
MART_SCHEMA = "event_type string, n_events bigint, total_value double, event_date date"


def write_json_lines(df: DataFrame, path: str) -> None:
    """One JSON object per line, times to the microsecond, nulls written out."""
    options = {"timestampNTZFormat": TIMESTAMP_FORMAT, "ignoreNullFields": "false"}
    df.select(F.to_json(F.struct("*"), options).alias("value")).write.mode("append").text(path)


def write_csv_lines(df: DataFrame, path: str) -> None:
    """One CSV line per row, times to the microsecond."""
    options = {"timestampNTZFormat": TIMESTAMP_FORMAT}
    df.select(F.to_csv(F.struct("*"), options).alias("value")).write.mode("append").text(path)


def land_raw(spark: SparkSession, path: str, file_format: str, schema: StructType) -> Split:
    """Read JSON or CSV lines with a declared schema: (typed rows, unreadable lines whole).

    A line that does not parse and a line with a value of the wrong type are
    both unreadable. Empty lines are neither.
    """
    parsers = {"json": checked_json, "csv": checked_csv}
    if file_format not in parsers:
        raise ValueError(f"not a line format: {file_format}")
    flag = "_is_valid"
    lines = spark.read.text(path).filter(F.trim("value") != "")
    tagged = once(lines, parsers[file_format]("value", schema), "_row").withColumn(
        flag, readable("_row")
    )
    # Stored in two parts, so that both results come from one pass over the source.
    landed = tagged.withColumn("value", F.when(~F.col(flag), F.col("value")))
    stored = stage(landed, "landed", (flag,))
    good = stored.filter(F.col(flag)).select(*[F.col(f"_row.{n}").alias(n) for n in schema.names])
    return Split(good, stored.filter(~F.col(flag)).select(F.col("value").alias("line")))


def parse_json_column(df: DataFrame, col: str, schema: StructType) -> DataFrame:
    """Add typed columns from JSON text; text that does not parse gives nulls."""
    parsed = F.from_json(F.col(col), schema)
    return df.withColumn("_json", parsed).select(
        *df.columns, *[F.col(f"_json.{n}").alias(n) for n in schema.names]
    )


def promote_clean(raw: DataFrame, root: str) -> str:
    """Merge raw events into the clean layer: one row per event, the newest, by date and type.

    Rewritten are the partitions of the new rows and those that hold older copies of the same
    events, which may have another date or type; all others stay as they are. Of copies with one
    time the later load wins, within a load the greatest by all other columns. A rerun changes
    nothing, also after a run that was cut off at any point: what is to be written stands in a
    journal first, see ``journal``. Returns the layer's path.
    """
    spark, path, journal_path = raw.sparkSession, f"{root}/clean", f"{root}/journal"
    journal.finish(spark, journal_path, path, CLEAN_SCHEMA, CLEAN_PARTS)
    typed = raw.withColumn("event_date", F.to_date("ts"))
    new = typed.select(*spark.createDataFrame([], CLEAN_SCHEMA).columns)
    new = stage(dedupe_latest(new, ["event_id"], ["ts", *TIE_BREAK]), "new-events")
    touched, merged = new.select(*CLEAN_PARTS), new.withColumn("_load", F.lit(1))
    if path_exists(spark, path):
        old = spark.read.schema(CLEAN_SCHEMA).parquet(path)
        same = F.col("event_id").eqNullSafe(F.col("_event_id"))
        ids = new.select(F.col("event_id").alias("_event_id"))
        touched = touched.union(old.join(ids, same, "left_semi").select(*CLEAN_PARTS))
        touched = stage(touched.distinct(), "touched")
        kept = journal.in_partitions(old, touched, CLEAN_PARTS).withColumn("_load", F.lit(0))
        merged = merged.unionByName(kept)
    merged = dedupe_latest(merged, ["event_id"], ["ts", "_load"]).drop("_load")
    journal.log(journal_path, merged, touched)
    journal.finish(spark, journal_path, path, CLEAN_SCHEMA, CLEAN_PARTS)
    return path


def promote_mart(clean: DataFrame, root: str, days: DataFrame | None = None) -> str:
    """Clean events to daily counts, of the given days or of all; returns the path of the mart.

    It follows from the clean layer alone, so a run that was cut off is repeated.
    """
    spark, path = clean.sparkSession, f"{root}/mart"
    if days is not None:
        clean = journal.in_partitions(clean, days, ["event_date"])
    daily = clean.groupBy("event_date", "event_type").agg(
        F.count(F.lit(1)).alias("n_events"), total("value").cast("double").alias("total_value")
    )
    if days is None:
        overwrite_partitions(daily, path, ["event_date"])
        return path
    # An entry of its own kind of journal, since days without events leave the mart.
    journal_path = f"{root}/mart-journal"
    journal.log(journal_path, daily, days.select("event_date"))
    journal.finish(spark, journal_path, path, MART_SCHEMA, ["event_date"])
    for entry in journal.entries(spark, journal_path):
        journal.forget(spark, entry)
    return path


def promote_layers(raw: DataFrame, root: str) -> tuple[str, str]:
    """raw -> clean -> mart, a load at a time.

    A load rewrites the partitions of the clean layer that it touches and the days of
    the mart that these belong to. Days stay in the journal until the mart has them, so that a
    rerun, or the next load, also counts the days of runs that were cut off.
    """
    spark = raw.sparkSession
    clean = promote_clean(raw, root)
    waiting = journal.entries(spark, f"{root}/journal")
    days = journal.touched(spark, waiting, CLEAN_SCHEMA, CLEAN_PARTS).select("event_date")
    mart = promote_mart(spark.read.schema(CLEAN_SCHEMA).parquet(clean), root, stage(days.distinct(), "days"))
    for entry in waiting:
        journal.forget(spark, entry)
    return clean, mart


def read_pruned(spark: SparkSession, path: str, schema: str, predicate: Column) -> DataFrame:
    """Read the directories that match a predicate on partition columns."""
    return spark.read.schema(schema).parquet(path).filter(predicate)


def compact_files(
    spark: SparkSession, src: str, dst: str, schema: str, partition_cols: list[str],
    target_bytes: int,
) -> None:
    """The same rows in fewer files, written to a new directory.

    Small partitions are put together and large ones split at about
    ``target_bytes`` of shuffled data.
    """
    sizing = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes)}
    with settings(spark, sizing):
        (
            spark.read.schema(schema)
            .parquet(src)
            .hint("rebalance", *partition_cols)
            .write.partitionBy(*partition_cols)
            .parquet(dst)
        )


def lake_inventory(
    spark: SparkSession, path: str, schema: str, partition_cols: list[str]
) -> DataFrame:
    """(partition columns, n_files, n_rows, n_bytes), files without rows included.

    Files and sizes come from a listing that opens no content; rows are counted by file.
    """
    types = spark.createDataFrame([], schema).schema
    listed = (
        spark.read.format("binaryFile")
        .load(path)
        .select(
            *[F.col(c).cast(types[c].dataType).alias(c) for c in partition_cols],
            F.col("_metadata.file_path").alias("_file"),
            F.col("length").alias("_bytes"),
        )
    )
    counted = (
        spark.read.schema(schema)
        .parquet(path)
        .groupBy(F.col("_metadata.file_path").alias("_counted"))
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    files = listed.join(counted, F.col("_file") == F.col("_counted"), "left")
    return files.groupBy(*partition_cols).agg(
        F.count(F.lit(1)).alias("n_files"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("n_rows"),
        F.sum("_bytes").alias("n_bytes"),
    )
