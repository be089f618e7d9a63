"""Version history kept as a table and brought up to date load by load.

The table holds every change, in folders by a hash of the key, and says of each change whether a
version begins there and when that ends. A load reads and rewrites the folders of its keys
only, and works out only the keys that it has. Changes may come in any order: one that falls into a
closed version splits it, as the changes within the version are still there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.operators.etl import dedupe_latest
from millrace.operators.ordered import MAX_GROUP_ROWS, SLICE, attach, by_group_size, last_before_slice, slice_groups
from millrace.session import path_exists, stage
from millrace.sources import journal

BUCKET, BEGINS, ENDS = "_bucket", "_begins", "_valid_to"


def mark_versions(
    changes: DataFrame,
    key: str,
    order_col: str,
    tracked: list[str],
    max_group_rows: int = MAX_GROUP_ROWS,
    slices: int | None = None,
) -> DataFrame:
    """Add ``_begins`` (the change differs from the one before) and ``_valid_to`` (of the version
    that begins there: the next such ``order_col``, else null).

    ``order_col`` is unique per key. Keys of any number of changes are worked out by ranges.
    """
    rows = stage(changes.select(key, order_col, *tracked), "changes")
    state = F.struct(*tracked)

    def flagged(df: DataFrame, previous: Column) -> DataFrame:
        df = df.withColumn("_previous", previous)
        begins = F.col("_previous").isNull() | ~F.col("_previous").eqNullSafe(state)
        return df.withColumn(BEGINS, begins)

    def finished(df: DataFrame, following: Column) -> DataFrame:
        return df.select(key, order_col, *tracked, BEGINS, F.when(F.col(BEGINS), following).alias(ENDS))

    start = F.when(F.col(BEGINS), F.col(order_col))

    def whole(part: DataFrame) -> DataFrame:
        w = Window.partitionBy(key).orderBy(order_col)
        later = w.rowsBetween(1, Window.unboundedFollowing)
        return finished(flagged(part, F.lag(state).over(w)), F.min(start).over(later))

    def sliced(part: DataFrame) -> DataFrame:
        cut = slice_groups(part, [key], [order_col], slices)
        w = Window.partitionBy(key, SLICE).orderBy(order_col)
        carried = last_before_slice(cut, [key], state, F.col(order_col), "_carried")
        local = attach(cut.withColumn("_local", F.lag(state).over(w)), [key], carried, ["_carried"])
        marked = flagged(local, F.coalesce("_local", "_carried"))
        beyond = Window.partitionBy(key).orderBy(SLICE).rowsBetween(1, Window.unboundedFollowing)
        following = (
            marked.groupBy(key, SLICE)
            .agg(F.min(start).alias("_first"))
            .select(key, SLICE, F.min("_first").over(beyond).alias("_following"))
            .filter(F.col("_following").isNotNull())
        )
        here = F.min(start).over(w.rowsBetween(1, Window.unboundedFollowing))
        ends = attach(marked.withColumn("_here", here), [key], following, ["_following"])
        return finished(ends, F.coalesce("_here", "_following"))

    return by_group_size(rows, [key], whole, sliced, max_group_rows)


def merge_history(
    changes: DataFrame,
    root: str,
    key: str,
    order_col: str,
    tracked: list[str],
    buckets: int = 64,
    max_group_rows: int = MAX_GROUP_ROWS,
    slices: int | None = None,
) -> None:
    """Merge a load of changes into the history below ``root``.

    A change of a key and time that is there already replaces it; of several in one load the
    greatest by ``tracked`` stays. A null key is a key. A load may be repeated, and one that was
    cut off is finished by the next (see ``journal``). ``buckets`` has to be the same in all
    loads of a history; an empty load changes nothing.
    """
    spark, path, journal_path = changes.sparkSession, f"{root}/versions", f"{root}/journal"
    new = changes.select(key, order_col, *tracked)
    schema = _schema(new, order_col)
    _finish(spark, root, schema)
    new = stage(dedupe_latest(new, [key, order_col], tracked), "load")
    bucketed = new.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    touched = stage(bucketed.select(BUCKET).distinct(), "touched")
    if path_exists(spark, path):
        known = journal.in_partitions(spark.read.schema(schema).parquet(path), touched, [BUCKET])
        keys = new.select(F.col(key).alias("_key")).distinct()
        mine = F.col(key).eqNullSafe(F.col("_key"))
        both = (
            known.join(keys, mine, "left_semi")
            .select(*new.columns, F.lit(0).alias("_load"))
            .unionByName(new.withColumn("_load", F.lit(1)))
        )
        changed = dedupe_latest(both, [key, order_col], ["_load"]).drop("_load")
        others = known.join(keys, mine, "left_anti")
    else:
        changed, others = new, None
    marked = mark_versions(changed, key, order_col, tracked, max_group_rows, slices)
    rows = marked.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    if others is not None:
        rows = rows.unionByName(others)
    journal.log(journal_path, rows, touched)
    _finish(spark, root, schema)


def read_history(spark: SparkSession, root: str, key: str, order_col: str, schema: str) -> DataFrame:
    """(key, tracked, valid_from, valid_to, is_current) as ``scd2_history`` gives, from the table.

    ``schema`` has the columns of the changes that were merged.
    """
    tracked = [f.name for f in spark.createDataFrame([], schema).schema if f.name not in (key, order_col)]
    stored = spark.read.schema(_schema(spark.createDataFrame([], schema), order_col)).parquet(f"{root}/versions")
    return stored.filter(BEGINS).select(
        key,
        *tracked,
        F.col(order_col).alias("valid_from"),
        F.col(ENDS).alias("valid_to"),
        F.col(ENDS).isNull().alias("is_current"),
    )


def _schema(changes: DataFrame, order_col: str) -> str:
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in changes.schema]
    end = changes.schema[order_col].dataType.simpleString()
    return ", ".join([*columns, f"{BEGINS} boolean", f"{ENDS} {end}", f"{BUCKET} int"])


def _finish(spark: SparkSession, root: str, schema: str) -> None:
    journal.finish(spark, f"{root}/journal", f"{root}/versions", schema, [BUCKET])
    for entry in journal.entries(spark, f"{root}/journal"):
        journal.forget(spark, entry)
