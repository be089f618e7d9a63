"""WARC archives as a Spark data source, and an archive of web pages without second copies.

``spark.read.format("warc")`` plans partitions of whole files, small ones together. A task
parses a record's header first and asks the pushed predicates; only a record that passes, of
a read whose schema has ``payload``, has its payload decoded. All other payloads are skipped:
in plain files by Content-Length, in compressed ones (a gzip member a record) by the length
that the writer notes in the member's extra field 'sl', in files of other writers by inflating
without keeping. A read produces only the columns of the schema it is given.

``df.write.format("warc")`` writes a file or more per task under names of its own in a
folder ``_temporary``; the commit moves the files of the tasks that counted. A task may
therefore run twice. Files are reached through ``pyarrow.fs``: local or shared folders and
the stores that it opens.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
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
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, LongType, MapType, StringType, StructType
from pyspark.taskcontext import TaskContext

from millrace.llm.arrow import slices, text_bytes
from millrace.session import stage

#: Columns that come from a record's header, by the name of the WARC field.
NAMED = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "record_date": "warc-date",
    "target_uri": "warc-target-uri",
    "content_type": "content-type",
    "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
}
IN_BRACKETS = ("record_id", "refers_to")
TYPES = {
    "file": StringType(), "offset": LongType(), **dict.fromkeys(NAMED, StringType()), "content_length": LongType(),
    "payload_bytes": LongType(), "fields": MapType(StringType(), StringType()), "payload": BinaryType(),
}
SCHEMA = ", ".join(f"{name} {kind.simpleString()}" for name, kind in TYPES.items())
#: Columns that are written, in any order.
WRITTEN = (
    "record_type", "record_id", "target_uri", "record_date", "payload_digest", "refers_to", "payload_bytes", "payload",
)
#: Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
HTTP = "application/http;msgtype=response"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_DATE = "1970-01-01T00:00:00Z"
BLANK = b"\r\n\r\n"
#: Bytes of files that a partition takes (one file at least), of a written file, and of a header at most.
SPLIT_BYTES, FILE_BYTES, HEADER_BYTES = 128 << 20, 256 << 20, 1 << 20
#: Rows and bytes of payload that a task hands on at once.
BATCH_ROWS, BATCH_BYTES = 2048, 8 << 20


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri(path)


class WarcSource(DataSource):
    """``format("warc")``; option ``path``; for writing also ``level`` (of compression, 6)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options["path"], schema, int(self.options.get("splitbytes", SPLIT_BYTES)))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        if {f.name: f.dataType for f in schema} != {name: TYPES[name] for name in WRITTEN}:
            raise ValueError(f"a WARC file is written from the columns {', '.join(WRITTEN)}")
        roll, level = (int(self.options.get(n, d)) for n, d in (("filebytes", FILE_BYTES), ("level", 6)))
        return WarcWriter(self.options["path"], overwrite, roll, level)


@dataclass
class Files(InputPartition):
    """Paths of the files of one task."""

    paths: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType, split_bytes: int):
        for field in schema:
            if TYPES.get(field.name) != field.dataType:
                raise ValueError(f"no column {field.name} {field.dataType.simpleString()}; there are {SCHEMA}")
        self.path, self.schema, self.split_bytes = path, schema, split_bytes
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        """Take predicates on header columns; give the others back."""
        for each in filters:
            if predicate(each) is None:
                yield each
            else:
                self.filters.append(each)

    def partitions(self) -> list[Files]:
        store, path = opened(self.path)
        found = store.get_file_info(path)
        if found.type == fs.FileType.Directory:
            listed = store.get_file_info(fs.FileSelector(path, recursive=True))
        else:
            listed = [found]
        taken = sorted(
            (f.path, f.size)
            for f in listed
            if f.is_file and f.path.endswith((".warc", ".warc.gz")) and "/_temporary/" not in f.path
        )
        planned, size = [], 0
        for name, length in taken:
            if not planned or size + length > self.split_bytes:
                planned.append(Files([]))
                size = 0
            planned[-1].paths.append(name)
            size += length
        return planned or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = opened(self.path)
        asked = [predicate(each) for each in self.filters]
        names = [f.name for f in self.schema]
        arrow = to_arrow_schema(self.schema)
        held, size = [], 0
        for path in partition.paths:
            with store.open_input_file(path) as raw:
                for record in records(io.BufferedReader(raw, 1 << 20), path):
                    if all(passes(record) for passes in asked):
                        row = [record.value(name) for name in names]
                        size += sum(len(v) for v in row if isinstance(v, bytes))
                        held.append(row)
                        if len(held) >= BATCH_ROWS or size >= BATCH_BYTES:
                            yield _batch(held, arrow)
                            held, size = [], 0
        if held:
            yield _batch(held, arrow)


def _batch(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if len(schema) else ()
    arrays = [pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


class Record:
    """One record: its header, and its block, which is decoded when it is asked for."""

    def __init__(self, file: str, offset: int, fields: dict[str, str], block: Callable[[int | None], bytes]):
        self.file, self.offset, self.fields, self.block = file, offset, fields, block

    def value(self, name: str):
        if name in NAMED:
            text = self.fields.get(NAMED[name])
            return text.strip("<>") if text is not None and name in IN_BRACKETS else text
        if name == "content_length":
            return int(self.fields["content-length"])
        return getattr(self, name)

    @property
    def is_http(self) -> bool:
        return self.fields.get("content-type", "").lower().startswith("application/http")

    @property
    def payload_bytes(self) -> int:
        """Length of the whole payload; of a revisit as its HTTP header says."""
        if not self.is_http:
            return self.value("content_length")
        head, at = b"", -1
        while at < 0 and len(head) < min(HEADER_BYTES, self.value("content_length")):
            head = self.block(2 * len(head) or 1024)
            at = head.find(BLANK)
        if at < 0:
            raise ValueError(f"{self.file}, {self.offset}: no end of the HTTP header")
        said = _fields(head[:at]).get("content-length")
        if self.fields.get("warc-type") == "revisit" and said is not None:
            return int(said)
        return self.value("content_length") - at - len(BLANK)

    @property
    def payload(self) -> bytes | None:
        """The block without an HTTP header; a revisit has none, as its payload is elsewhere."""
        if self.fields.get("warc-type") == "revisit":
            return None
        block = self.block(None)
        return block.partition(BLANK)[2] if self.is_http else block


def _fields(head: bytes) -> dict[str, str]:
    """Named fields below the first line; a folded line goes on, a repeated field is joined by commas."""
    fields: dict[str, str] = {}
    name = ""
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            fields[name] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        name = name.strip().lower()
        if not colon:
            raise ValueError(f"not a header line: {line[:80]!r}")
        fields[name] = f"{fields[name]}, {value.strip()}" if name in fields else value.strip()
    return fields


def records(stream: io.BufferedReader, file: str) -> Iterator[Record]:
    """Records of a file, in order; the block of one can be had until the next is asked for."""
    offset = 0
    while True:
        stream.seek(offset)
        begin = stream.read(2)
        if not begin:
            return
        stream.seek(offset)
        unit = _Member(stream, offset) if begin == b"\x1f\x8b" else _Plain(stream, offset)
        try:
            head = unit.head()
            if not head.startswith(b"WARC/"):
                raise ValueError(f"starts with {head[:20]!r}")
            fields = _fields(head)
            length = int(fields["content-length"])
        except (ValueError, KeyError, EOFError, zlib.error) as wrong:
            raise ValueError(f"{file}: no WARC record at byte {offset}: {wrong}") from wrong
        yield Record(file, offset, fields, lambda most, u=unit, n=length: u.block(n if most is None else min(n, most)))
        offset = unit.end(length)


class _Plain:
    """A record that is not compressed."""

    def __init__(self, stream: io.BufferedReader, offset: int):
        self.stream, self.offset, self.at = stream, offset, 0

    def head(self) -> bytes:
        held = b""
        while (at := held.find(BLANK)) < 0:
            more = self.stream.read(4096)
            if not more or len(held) > HEADER_BYTES:
                raise EOFError("the header does not end")
            held += more
        self.at = self.offset + at + len(BLANK)
        return held[:at]

    def block(self, length: int) -> bytes:
        self.stream.seek(self.at)
        block = self.stream.read(length)
        if len(block) < length:
            raise EOFError(f"record at byte {self.offset} is cut short")
        return block

    def end(self, length: int) -> int:
        return self.at + length + len(BLANK)


class _Member:
    """A record in a gzip member of its own; inflated as far as it is asked for."""

    def __init__(self, stream: io.BufferedReader, offset: int):
        self.stream, self.offset = stream, offset
        first = stream.read(24)
        # The extra field 'sl': length of the member, length inflated.
        known = len(first) == 24 and first[3] & 4 and first[10:16] == b"\x0c\x00sl\x08\x00"
        self.length = struct.unpack("<I", first[16:20])[0] if known else 0
        self.inflate = zlib.decompressobj(31)
        self.held = bytearray()
        self.read_to, self.waiting, self.body = offset + len(first), first, 0

    def _more(self, most: int) -> bytes:
        """Up to ``most`` more bytes inflated; none at the member's end."""
        while not self.inflate.eof:
            if not self.waiting:
                self.stream.seek(self.read_to)
                self.waiting = self.stream.read(16384)
                self.read_to += len(self.waiting)
                if not self.waiting:
                    raise EOFError(f"member at byte {self.offset} is cut short")
            out = self.inflate.decompress(self.waiting, most)
            self.waiting = self.inflate.unconsumed_tail
            if out:
                return out
        return b""

    def head(self) -> bytes:
        while (at := self.held.find(BLANK)) < 0:
            more = self._more(1024)
            if not more or len(self.held) > HEADER_BYTES:
                raise EOFError("the header does not end")
            self.held += more
        self.body = at + len(BLANK)
        return bytes(self.held[:at])

    def block(self, length: int) -> bytes:
        while (missing := self.body + length - len(self.held)) > 0:
            more = self._more(missing)
            if not more:
                raise EOFError(f"record at byte {self.offset} is cut short")
            self.held += more
        return bytes(self.held[self.body : self.body + length])

    def end(self, length: int) -> int:
        if self.length:
            return self.offset + self.length
        while self._more(1 << 16):
            pass
        return self.read_to - len(self.inflate.unused_data)


#: Kinds of predicate on a value that is there.
COMPARED = {
    EqualTo: lambda x, y: x == y,
    In: lambda x, y: x in y,
    GreaterThan: lambda x, y: x > y,
    GreaterThanOrEqual: lambda x, y: x >= y,
    LessThan: lambda x, y: x < y,
    LessThanOrEqual: lambda x, y: x <= y,
    StringStartsWith: lambda x, y: x.startswith(y),
    StringEndsWith: lambda x, y: x.endswith(y),
    StringContains: lambda x, y: y in x,
}


def predicate(asked: Filter) -> Callable[[Record], bool] | None:
    """A test of a record's header with the meaning of SQL, or None if the header cannot tell."""
    wanted = not isinstance(asked, Not)
    inner = asked if wanted else asked.child
    name = ".".join(getattr(inner, "attribute", ()))
    if name not in (*NAMED, "content_length"):
        return None
    if isinstance(inner, (IsNull, IsNotNull)):
        empty = isinstance(inner, IsNull) == wanted
        return lambda record: (record.value(name) is None) == empty
    value = getattr(inner, "value", None)
    if isinstance(inner, EqualNullSafe):
        return lambda record: (record.value(name) == value) == wanted
    compare = COMPARED.get(type(inner))
    if compare is None or value is None or (isinstance(value, (tuple, list)) and None in value):
        return None

    def passes(record: Record) -> bool:
        found = record.value(name)
        if isinstance(found, str) and not isinstance(value, (tuple, list)):
            # Strings compare by their bytes, as in Spark.
            return compare(found.encode(), value.encode()) == wanted
        return found is not None and compare(found, value) == wanted

    return passes


@dataclass
class Written(WriterCommitMessage):
    """Names of the files of one task."""

    names: list[str]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool, file_bytes: int, level: int):
        self.path, self.overwrite, self.file_bytes, self.level = path, overwrite, file_bytes, level

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, path = opened(self.path)
        store.create_dir(f"{path}/_temporary", recursive=True)
        own = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        names: list[str] = []
        out, size = None, 0
        for batch in slices(iterator, "payload"):
            for row in batch.to_pylist():
                if out is None or size >= self.file_bytes:
                    if out is not None:
                        out.close()
                    names.append(f"{own}-{len(names)}.warc.gz")
                    out = store.open_output_stream(f"{path}/_temporary/{names[-1]}", compression=None)
                    size = 0
                member = _member(_record(row), self.level)
                size += len(member)
                out.write(member)
        if out is not None:
            out.close()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        store, path = opened(self.path)
        store.create_dir(f"{path}/_temporary", recursive=True)
        if self.overwrite:
            for old in store.get_file_info(fs.FileSelector(path)):
                if old.is_file:
                    store.delete_file(old.path)
        for name in [n for m in messages if m for n in m.names]:
            store.move(f"{path}/_temporary/{name}", f"{path}/{name}")
        store.delete_dir(f"{path}/_temporary")

    def abort(self, messages: list[Written | None]) -> None:
        store, path = opened(self.path)
        for name in [n for m in messages if m for n in m.names]:
            store.delete_file(f"{path}/_temporary/{name}")


def _record(row: dict) -> bytes:
    """A record of an HTTP response, or of a revisit, whose block has the HTTP header alone."""
    payload = row["payload"] or b""
    length = len(payload) if row["payload_bytes"] is None else row["payload_bytes"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    revisit = row["record_type"] == "revisit"
    block = http if revisit else http + payload
    fields = {
        "WARC-Type": row["record_type"],
        "WARC-Record-ID": f"<{_line(row['record_id'])}>",
        "WARC-Date": row["record_date"] or NO_DATE,
        "WARC-Target-URI": row["target_uri"],
        "WARC-Payload-Digest": row["payload_digest"],
        "WARC-Refers-To": None if row["refers_to"] is None else f"<{_line(row['refers_to'])}>",
        "WARC-Profile": SAME_PAYLOAD if revisit else None,
        "Content-Type": HTTP,
        "Content-Length": str(len(block)),
    }
    head = "".join(f"{name}: {_line(value)}\r\n" for name, value in fields.items() if value is not None)
    return VERSION + head.encode() + b"\r\n" + block + BLANK


def _line(value: str) -> str:
    """A value without control characters, which would end the line, as in a URI."""
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in value)


def _member(data: bytes, level: int) -> bytes:
    """A gzip member that notes its own length, if that fits 32 bits."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    trailer = struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    length = 24 + len(body) + len(trailer)
    fits = max(length, len(data)) < 1 << 32
    extra = struct.pack("<H2sHII", 12, b"sl", 8, length, len(data)) if fits else b""
    return struct.pack("<4BIBB", 31, 139, 8, 4 if fits else 0, 0, 0, 255) + extra + body + trailer


def register(spark: SparkSession) -> None:
    """Make ``format("warc")`` known to a session; predicates reach Python sources from then on."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read(spark: SparkSession, path: str, schema: str = SCHEMA) -> DataFrame:
    """Records below ``path``, or of one file, with the columns of ``schema``, some of ``SCHEMA``.

    Without files there are no rows. Column ``payload`` is null for revisits, ``payload_bytes``
    is the length of the whole payload. A file that is cut short or not WARC fails the job.
    """
    register(spark)
    return spark.read.format("warc").schema(schema).load(path)


def archive(
    df: DataFrame, path: str, key: str, uri: str, text: str, least: int = 100, level: int = 6
) -> None:
    """Write a record per row of ``df`` below ``path``, to files there already added.

    The payload is column ``text`` in UTF-8 (null: empty). Of rows with equal payloads of at least
    ``least`` bytes the one of smallest ``key`` is a response, the others are revisits that
    refer to it; other rows are responses. Rows that repeat the smallest key are all responses,
    rows without a key are revisits where an equal payload has one, else responses. Record ids
    are ``urn:<key column>:<key>``, so keys should be unique. A null ``uri`` is left out. Other
    columns of ``df`` are not written. Without rows there is no file.

    Digests meet in an aggregation; payloads move only for the join with digests that occur
    several times, and not at all while these are few enough for Spark to broadcast.
    """
    register(df.sparkSession)
    payload, number = text_bytes(f"`{text}`"), F.col(f"`{key}`").cast("bigint")
    rows = df.select(
        number.alias("key"), F.col(f"`{uri}`").cast("string").alias("target_uri"), payload.alias("payload")
    ).withColumns(
        {"payload_bytes": F.octet_length("payload").cast("bigint"), "digest": F.unhex(F.sha2("payload", 256))}
    )
    several = rows.filter(F.col("payload_bytes") >= least).groupBy("digest")
    several = several.agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    # Smaller payloads have no equals that count, whatever their digest.
    several = stage(several.select(F.col("digest").alias("_digest"), "first"), "digests")
    judged = rows.join(
        several, (F.col("digest") == F.col("_digest")) & (F.col("payload_bytes") >= least), "left"
    )
    revisit = F.col("first").isNotNull() & ~F.col("key").eqNullSafe(F.col("first"))

    def urn(number: str):
        return F.concat(F.lit(f"urn:{key}:"), F.coalesce(F.col(number).cast("string"), F.lit("")))

    judged.withColumn("_revisit", revisit).select(
        F.when(F.col("_revisit"), "revisit").otherwise("response").alias("record_type"),
        urn("key").alias("record_id"),
        "target_uri",
        F.lit(None).cast("string").alias("record_date"),
        F.concat(F.lit("sha256:"), F.lower(F.hex("digest"))).alias("payload_digest"),
        F.when(F.col("_revisit"), urn("first")).alias("refers_to"),
        "payload_bytes",
        F.when(~F.col("_revisit"), F.col("payload")).alias("payload"),
    ).write.format("warc").option("level", level).mode("append").save(path)
