"""Arrow batches in tasks: bounded slices, columns as Python values, tables of inputs."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "benchmark": "item_id bigint, text string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
#: Rows and bytes of text that a task holds as Python values at once (one row at least).
SLICE_ROWS, SLICE_BYTES = 512, 8 << 20


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{str(root).rstrip('/')}/{name}.parquet")


def text_bytes(text: str = "`text`") -> Column:
    """UTF-8 bytes of a text column; null counts as empty."""
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


def slices(
    batches: Iterator[pa.RecordBatch], text: str | None = None, most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that rows, and bytes of column ``text``, stay bounded in a task."""
    for batch in batches:
        at, size = 0, batch.num_rows
        widths = _widths(batch.column(text)) if text else None
        while at < size:
            end = min(at + SLICE_ROWS, size)
            if widths is not None:
                total = 0
                for k in range(at, end):
                    total += widths[k]
                    if total > most and k > at:
                        end = k
                        break
            yield batch.slice(at, end - at)
            at = end


def _widths(column: pa.Array) -> list[int]:
    return pc.fill_null(pc.binary_length(column), 0).to_pylist()


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less the columns that an operator is about to add, whatever their case."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def extended(df: DataFrame, ddl: str) -> StructType:
    """Schema of ``df`` with the columns of ``ddl`` behind."""
    return StructType([*df.schema.fields, *StructType.fromDDL(ddl).fields])
