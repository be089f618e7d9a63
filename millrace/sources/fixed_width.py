"""Lines of fixed width as a data source of their own, for batches and streams.

``spark.read.format("fixed_width")`` and ``spark.readStream`` take files whose lines all have the
same number of bytes. A line's place then follows from its number, so a file of any size is
cut into ranges that tasks read on their own. A task takes the columns of a range as arrays; it
types those that pushed filters ask about first, and the others for the rows that pass only.

As a stream, files are read in the order of their paths, and an offset is a path with the bytes read of
it. A load therefore brings files whose paths come after all earlier ones (a folder a load,
say) or adds lines to the last file. A line that is not finished waits for the rest. A folder in which a Spark
job is still writing is not read, nor what comes after it. A micro-batch takes all
that has arrived, in as many tasks as its bytes need.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, FloatType, StructType

#: Bytes of a file that a task reads (one line at least), and that it holds at once.
SPLIT_BYTES, CHUNK_BYTES = 128 << 20, 4 << 20
COMPARED = {
    EqualTo: pc.equal,
    GreaterThan: pc.greater,
    GreaterThanOrEqual: pc.greater_equal,
    LessThan: pc.less,
    LessThanOrEqual: pc.less_equal,
}


@dataclass(frozen=True)
class Layout:
    """Names and types of the columns, and the bytes that each has, in the order of a line."""

    columns: StructType
    widths: tuple[int, ...]

    def __post_init__(self) -> None:
        if len(self.widths) != len(self.columns) or min(self.widths, default=0) < 1:
            raise ValueError("a layout has one width of at least 1 for each column")

    @property
    def line_bytes(self) -> int:
        return sum(self.widths) + 1

    def place(self, name: str) -> slice:
        at = self.columns.names.index(name)
        start = sum(self.widths[:at])
        return slice(start, start + self.widths[at])


def write(df: DataFrame, path: str, layout: Layout) -> None:
    """Write the layout's columns as lines: text, padded with spaces.

    A value that is longer than its column, or that would come back as another one (an empty text,
    a space at an end, a line break), fails the job. Null is a column of spaces.
    """
    parts = []
    for field, width in zip(layout.columns, layout.widths):
        text = F.col(f"`{field.name}`").cast(field.dataType).cast("string")
        spare = F.lit(width) - F.octet_length(text)
        bad = (spare < 0) | (text == "") | text.startswith(" ") | text.endswith(" ") | text.contains("\n")
        told = F.concat(F.lit(f"{field.name}: no place in {width} bytes for "), text)
        padded = F.when(bad, F.raise_error(told)).otherwise(F.concat(text, F.repeat(F.lit(" "), spare)))
        parts.append(F.coalesce(padded, F.lit(" " * width)))
    df.select(F.concat(*parts).alias("value")).write.text(path)


def read(spark: SparkSession, path: str, layout: Layout, columns: list[str] | None = None) -> DataFrame:
    """Rows of all files below ``path``; of ``columns`` only, if given.

    Without files there are no rows. Bytes that are no value of their column's type or not UTF-8, a line that
    does not end where it should, and a file that ends within a line, fail the job.
    """
    _register(spark)
    return _options(spark.read, layout, columns).load(path)


def read_stream(spark: SparkSession, path: str, layout: Layout, columns: list[str] | None = None) -> DataFrame:
    """The same rows as a stream; a line that has only begun is waited for."""
    _register(spark)
    return _options(spark.readStream, layout, columns).load(path)


def _register(spark: SparkSession) -> None:
    spark.dataSource.register(FixedWidthSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def _options(reader, layout: Layout, columns: list[str] | None):
    asked = layout.columns if columns is None else StructType([layout.columns[c] for c in columns])
    widths = ",".join(map(str, layout.widths))
    return reader.format("fixed_width").schema(asked).option("layout", layout.columns.json()).option("widths", widths)


class FixedWidthSource(DataSource):
    """``format("fixed_width")``: options ``path``, ``layout`` (schema as JSON), ``widths``, ``splitbytes``."""

    @classmethod
    def name(cls) -> str:
        return "fixed_width"

    def _layout(self) -> Layout:
        import json

        columns = StructType.fromJson(json.loads(self.options["layout"]))
        return Layout(columns, tuple(int(w) for w in self.options["widths"].split(",")))

    def schema(self) -> StructType:
        return self._layout().columns

    def _files(self, schema: StructType) -> _Files:
        split = int(self.options.get("splitbytes", SPLIT_BYTES))
        return _Files(self.options["path"], self._layout(), schema, split)

    def reader(self, schema: StructType) -> FixedWidthReader:
        return FixedWidthReader(self._files(schema))

    def streamReader(self, schema: StructType) -> FixedWidthStream:  # noqa: N802
        return FixedWidthStream(self._files(schema))


@dataclass
class Lines(InputPartition):
    """Bytes of one file, from the begin of a line to the end of one."""

    path: str
    start: int
    stop: int


class _Files:
    """What the batch and the stream reader share."""

    def __init__(self, path: str, layout: Layout, schema: StructType, split_bytes: int):
        for field in schema:
            if field.name not in layout.columns.names or layout.columns[field.name].dataType != field.dataType:
                raise ValueError(f"the layout has no column {field.name} {field.dataType.simpleString()}")
        self.path, self.layout, self.schema, self.split_bytes = path, layout, schema, split_bytes

    def listed(self) -> list[tuple[str, int]]:
        """Paths, in order, and sizes of the files, up to a folder that is still written."""
        store, path = fs.FileSystem.from_uri(self.path)
        found = store.get_file_info(path)
        if found.type == fs.FileType.File:
            return [(found.path, found.size)]
        if found.type != fs.FileType.Directory:
            return []
        infos = sorted(store.get_file_info(fs.FileSelector(path, recursive=True)), key=lambda f: f.path)
        written = [f.path.rpartition("/")[0] + "/" for f in infos if f.base_name == "_temporary"]
        first = min(written, default=None)
        out = []
        for f in infos:
            hidden = any(part[0] in "._" for part in f.path[len(path) :].split("/") if part)
            if f.is_file and not hidden:
                if first is not None and (f.path.startswith(first) or f.path > first):
                    break
                out.append((f.path, f.size))
        return out

    def cut(self, path: str, start: int, stop: int) -> Iterator[Lines]:
        line = self.layout.line_bytes
        step = max(self.split_bytes // line, 1) * line
        for begin in range(start, stop, step):
            yield Lines(path, begin, min(begin + step, stop))

    def rows(self, part: Lines, filters: list[Filter]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(self.path)
        arrow = to_arrow_schema(self.schema)
        line = self.layout.line_bytes
        step = max(CHUNK_BYTES // line, 1) * line
        with store.open_input_file(part.path) as raw:
            for begin in range(part.start, part.stop, step):
                size = min(step, part.stop - begin)
                data = raw.read_at(size, begin)
                if len(data) != size:
                    raise ValueError(f"{part.path}: cut short at byte {begin + len(data)}")
                lines = np.frombuffer(data, np.uint8).reshape(-1, line)
                if (lines[:, -1] != ord("\n")).any():
                    wrong = int(np.argmax(lines[:, -1] != ord("\n")))
                    raise ValueError(f"{part.path}: the line at byte {begin + wrong * line} does not end there")
                yield from self._typed(lines, arrow, filters)

    def _typed(self, lines: np.ndarray, arrow: pa.Schema, filters: list[Filter]) -> Iterator[pa.RecordBatch]:
        def column(name: str) -> pa.Array:
            return _values(lines[:, self.layout.place(name)], arrow.field(name).type)

        for each in filters:
            lines = lines[_mask(each, column(each.attribute[0]))]
        if len(lines):
            columns = [column(f.name) for f in self.schema]
            if columns:
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)
            else:
                yield pa.RecordBatch.from_struct_array(pa.array([{}] * len(lines), pa.struct([])))


def _values(block: np.ndarray, kind: pa.DataType) -> pa.Array:
    """One column of the lines, typed; null where there are only spaces."""
    size, width = block.shape
    cells = pa.Array.from_buffers(pa.binary(width), size, [None, pa.py_buffer(np.ascontiguousarray(block))])
    text = pc.utf8_rtrim(cells.cast(pa.binary()).cast(pa.string()), characters=" ")
    filled = pc.if_else(pc.equal(text, ""), pa.scalar(None, pa.string()), text)
    return filled if pa.types.is_string(kind) else filled.cast(kind)


def _takes(asked: Filter, schema: StructType) -> bool:
    """Whether arrays compare as SQL does; floating point does not, because of NaN."""
    if not isinstance(asked, (*COMPARED, In, IsNull, IsNotNull)) or len(asked.attribute) != 1:
        return False
    return asked.attribute[0] in schema.names and not isinstance(
        schema[asked.attribute[0]].dataType, (DoubleType, FloatType)
    )


def _mask(asked: Filter, values: pa.Array) -> np.ndarray:
    """The rows for which a filter is true; null is not."""
    if isinstance(asked, (IsNull, IsNotNull)):
        passed = values.is_null() if isinstance(asked, IsNull) else values.is_valid()
    elif isinstance(asked, In):
        known = [v for v in asked.value if v is not None]
        passed = pc.and_(pc.is_in(values, pa.array(known, values.type)), values.is_valid())
    else:
        compare: Callable = COMPARED[type(asked)]
        passed = compare(values, pa.scalar(asked.value, values.type)).fill_null(False)
    return passed.to_numpy(zero_copy_only=False)


class FixedWidthReader(DataSourceReader):
    def __init__(self, files: _Files):
        self.files = files
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        """Take comparisons with constants; give the others back."""
        for each in filters:
            if _takes(each, self.files.schema):
                self.filters.append(each)
            else:
                yield each

    def partitions(self) -> list[Lines]:
        parts = []
        for path, size in self.files.listed():
            if size % self.files.layout.line_bytes:
                raise ValueError(f"{path}: {size} bytes are not whole lines of {self.files.layout.line_bytes}")
            parts += self.files.cut(path, 0, size)
        return parts or [Lines("", 0, 0)]

    def read(self, partition: Lines) -> Iterator[pa.RecordBatch]:
        return self.files.rows(partition, self.filters) if partition.stop else iter(())


class FixedWidthStream(DataSourceStreamReader):
    def __init__(self, files: _Files):
        self.files = files

    def initialOffset(self) -> dict:  # noqa: N802
        return {"path": "", "bytes": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        listed = self.files.listed()
        if not listed:
            return self.initialOffset()
        path, size = listed[-1]
        return {"path": path, "bytes": size - size % self.files.layout.line_bytes}

    def partitions(self, start: dict, end: dict) -> list[Lines]:
        parts = []
        for path, size in self.files.listed():
            if start["path"] <= path <= end["path"]:
                begin = start["bytes"] if path == start["path"] else 0
                stop = end["bytes"] if path == end["path"] else size
                if stop % self.files.layout.line_bytes:
                    raise ValueError(f"{path}: ends within a line, though later files are there")
                parts += self.files.cut(path, begin, stop)
        return parts or [Lines("", 0, 0)]

    def read(self, partition: Lines) -> Iterator[pa.RecordBatch]:
        return self.files.rows(partition, []) if partition.stop else iter(())
