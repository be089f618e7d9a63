"""Tables whose files can be skipped by ranges of several columns.

Rows are ordered by a key that winds through the ranges of all chosen columns at once, and cut into
files along it, so each file holds a narrow range of every column. An index with the least and
greatest value per file and column picks the files before any is opened.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    MapType,
    NumericType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

#: A column's values are cut into 2 ** BITS ranges of about as many rows.
BITS = 8
#: Lower and upper end of a range, both included; None is open.
Ends = tuple[object, object]


def _place(name: str, kind: DataType) -> Column:
    """A number that rises with the column; strings by their first seven bytes."""
    col = F.col(f"`{name}`")
    if isinstance(kind, NumericType | BooleanType):
        return col.cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(col).cast("double")
    if isinstance(kind, TimestampType | TimestampNTZType):
        return F.unix_micros(col.cast("timestamp")).cast("double")
    if isinstance(kind, StringType):
        first = F.substring(col.cast("binary"), 1, 7)
        return F.conv(F.rpad(F.hex(first), 14, "0"), 16, 10).cast("double")
    raise TypeError(f"cannot cluster by {name}, a {kind.simpleString()}")


def _rank(place: Column, bounds: list[float]) -> Column:
    """How many of the ascending bounds are not above the place, by bisection; 0 for null."""
    table = F.split(F.lit(",".join(map(repr, bounds))), ",").cast("array<double>")  # folded to a constant
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(BITS))])
    return F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: at + F.when(F.get(table, at + step - 1) <= place, step).otherwise(0),
    )


def _interleaved(ranks: list[Column]) -> Column:
    """One number from the bits of all ranks in turn, highest first."""
    bits = [
        F.shiftleft(F.shiftright(rank, bit).bitwiseAND(1).cast("bigint"), bit * len(ranks) + k)
        for bit in range(BITS)
        for k, rank in enumerate(ranks)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def write_clustered(df: DataFrame, path: str, columns: list[str], rows_per_file: int = 2_000_000) -> None:
    """Write ``df`` to a new folder in files that hold narrow ranges of ``columns``, with their index.

    Up to seven columns: numbers, truth values, dates, times or strings. Nulls are placed first. ``df``
    is read three times, so it should be a stored table. Rows that are alike in the columns are cut by
    their first column's exact place, then by a hash of the row; only copies of one whole row stay in
    one file. An empty table has an empty index. A write that was cut off has no index and cannot
    be read; write again to another folder.
    """
    if not 1 <= len(columns) <= 7:
        raise ValueError("cluster by one to seven columns")
    places = [_place(c, df.schema[c].dataType) for c in columns]
    shares = [k / 2**BITS for k in range(1, 2**BITS)]
    measured = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.percentile_approx(p, shares, 16 * 2**BITS).alias(f"b{k}") for k, p in enumerate(places)],
    ).first()
    ranks = [_rank(p, measured[f"b{k}"] or [0.0] * len(shares)) for k, p in enumerate(places)]
    hashed = [F.col(f"`{f.name}`") for f in df.schema if not isinstance(f.dataType, MapType)]
    keys = {"_curve": _interleaved(ranks), "_first": places[0], "_any": F.xxhash64(*hashed)}
    files = max(1, -(-measured["n"] // rows_per_file))
    placed = df.withColumns(keys).repartitionByRange(files, *keys).sortWithinPartitions(*keys)
    placed.drop(*keys).write.parquet(f"{path}/data")
    _write_index(df, path, columns)


def _write_index(df: DataFrame, path: str, columns: list[str]) -> None:
    """Per file: name, rows, and least and greatest value of each column (null: none)."""
    stored = df.sparkSession.read.schema(df.schema).parquet(f"{path}/data")
    ends = [f(F.col(f"`{c}`")).alias(f"{side}_{c}") for c in columns for side, f in (("min", F.min), ("max", F.max))]
    name = F.regexp_extract("_metadata.file_path", "([^/]+)$", 1).alias("file")
    index = stored.groupBy(name).agg(F.count(F.lit(1)).alias("n_rows"), *ends)
    index.coalesce(1 + index.sparkSession.sparkContext.defaultParallelism // 64).write.parquet(f"{path}/index")


def _within(ranges: dict[str, Ends], low_of: str = "{}", high_of: str = "{}") -> Column:
    tests = [F.lit(True)]
    for name, (low, high) in ranges.items():
        if low is not None:
            tests.append(F.col(f"`{high_of.format(name)}`") >= F.lit(low))
        if high is not None:
            tests.append(F.col(f"`{low_of.format(name)}`") <= F.lit(high))
    return reduce(lambda a, b: a & b, tests)


def pick_files(spark: SparkSession, path: str, ranges: dict[str, Ends]) -> list[str]:
    """Paths of the files that may hold rows within all ranges, from the index alone.

    Ranges are of columns that the table is clustered by. A column whose values are all null in a file
    is in no range. The list passes through the driver, as any list of files to read does.
    """
    index = spark.read.parquet(f"{path}/index")
    unknown = [c for c in ranges if f"min_{c}" not in index.columns]
    if unknown:
        raise ValueError(f"not clustered by {unknown}")
    chosen = index.filter(_within(ranges, "min_{}", "max_{}")).select("file").orderBy("file")
    return [f"{path}/data/{row['file']}" for row in chosen.collect()]


def read_clustered(spark: SparkSession, path: str, schema: str, ranges: dict[str, Ends]) -> DataFrame:
    """Rows within all ranges, from the files that may hold some; null is in no range."""
    files = pick_files(spark, path, ranges)
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*files).filter(_within(ranges))
