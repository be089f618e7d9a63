"""Parsing text into declared types while telling unreadable text apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    "timestampNTZFormat": TIMESTAMP_FORMAT,
}


def _with_corrupt(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(CORRUPT, StringType())])


def checked_json(col: str, schema: StructType) -> Column:
    """The struct parsed from JSON, its corrupt field set where the text does not fit."""
    return F.from_json(col, _with_corrupt(schema), OPTIONS)


def checked_csv(col: str, schema: StructType) -> Column:
    """The same for one CSV line."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _with_corrupt(schema))
    return F.from_csv(F.col(col), ddl, OPTIONS)


def once(df: DataFrame, parsed: Column, name: str) -> DataFrame:
    """Add a column that is worked out once per row, however often filters and fields use it.

    A generator keeps the optimizer from copying the expression to each place of use.
    """
    return df.select("*", F.inline(F.array(F.struct(parsed.alias(name)))))


def readable(parsed: str) -> Column:
    return F.col(parsed).isNotNull() & F.col(f"{parsed}.{CORRUPT}").isNull()
