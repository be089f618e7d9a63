"""WARC files: written and read back, read from other writers, skipped by header."""

import gzip
import io
import os
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from millrace.llm import warc
from millrace.llm.queries import QUERIES
from millrace.session import scratch_path
from oracle import mismatch

LONG = "<p>" + "long é " * 40
ROWS = [
    (5, "http://a/1", LONG), (3, "http://a/2", LONG), (9, None, LONG), (3, "http://a/2", LONG),
    (None, "http://a/null", LONG), (1, "http://b/short", "x" * 99), (2, "http://b/short", "x" * 99),
    (10, "http://c", "y" * 100), (11, "http://c", "y" * 100), (12, "http://d", None), (13, "http://d", ""),
    (14, "bad\r\nWARC-Type: resource\r\n\r\n", "text with\r\n\r\nWARC/1.1\r\n inside"),
    (15, "http://big", "many words " * 400_000), (None, "http://n", "z" * 200), (None, "http://n", "z" * 200),
]


def expected(rows):
    groups = {}
    for key, _, text in rows:
        groups.setdefault(text or "", []).append(key)
    out = []
    for key, _, text in rows:
        data = (text or "").encode()
        known = [k for k in groups[text or ""] if k is not None]
        first = min(known) if len(data) >= 100 and known else None
        again = first is not None and key != first
        out.append((key, len(data), sha256(data).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


def stored(spark, rows):
    root = scratch_path(spark, "test-pages")
    data = [(*row, "x", 1) for row in rows]
    schema = "page_id bigint, url string, html string, digest string, key int"
    spark.createDataFrame(data, schema).repartition(3).write.parquet(f"{root}/pages.parquet")
    return root


@pytest.mark.parametrize("n", [0, 1, len(ROWS)])
def test_query_equals_digests_made_one_by_one(spark, n):
    result = QUERIES["op12_warc_archive"].run(spark, stored(spark, ROWS[:n]))
    assert sorted(map(tuple, result.collect()), key=repr) == expected(ROWS[:n])


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, small, scale):
    root, query = small.replace("sf0.001", scale), QUERIES["op12_warc_archive"]
    assert mismatch(query.run(spark, root), root, query.sql) is None


@pytest.fixture(scope="module")
def written(spark):
    path = scratch_path(spark, "test-warc")
    rows = spark.createDataFrame(ROWS, "page_id bigint, url string, html string").repartition(4)
    warc.archive(rows, path, "page_id", "url", "html")
    return path


def local(path):
    return path.removeprefix("file://")


def test_files_are_members_that_any_gzip_reader_opens(spark, written):
    names = [n for n in os.listdir(local(written)) if not n.startswith(".")]
    assert names and all(n.endswith(".warc.gz") for n in names)
    inflated = b"".join(gzip.open(f"{local(written)}/{n}").read() for n in names)
    assert inflated.count(b"WARC-Record-ID: <urn:page_id:") == len(ROWS)
    # A new line in a value cannot start a field.
    assert b"WARC-Target-URI: bad%0D%0AWARC-Type: resource%0D%0A%0D%0A\r\n" in inflated


def test_all_columns_come_back(spark, written):
    found = warc.read(spark, written).collect()
    big = next(r for r in found if r.record_id == "urn:page_id:15")
    assert bytes(big.payload).decode() == ROWS[12][2] and big.payload_bytes == len(ROWS[12][2])
    assert big.fields["warc-target-uri"] == big.target_uri == "http://big"
    assert big.content_length > big.payload_bytes and big.record_date == warc.NO_DATE
    again = next(r for r in found if r.record_id == "urn:page_id:5")
    assert (again.record_type, again.refers_to, again.payload) == ("revisit", "urn:page_id:3", None)
    assert again.payload_bytes == len(LONG.encode()) and again.fields["warc-profile"] == warc.SAME_PAYLOAD
    assert {r.record_id: r.target_uri for r in found}["urn:page_id:9"] is None


CONDITIONS = [
    "record_type = 'revisit'", "record_type <> 'revisit'", "record_type in ('revisit', 'x')",
    "target_uri is null", "target_uri is not null", "target_uri like 'http://a%'", "target_uri like '%short'",
    "target_uri like '%a%'", "content_length > 300", "content_length <= 300", "refers_to <=> 'urn:page_id:3'",
    "not (target_uri <=> null)", "target_uri >= 'http://c'", "target_uri < 'http://c' and record_type = 'response'",
    "record_type = 'revisit' or target_uri is null", "not target_uri like 'http://a%'", "payload_bytes > 99",
    "payload is null", "fields['warc-type'] = 'revisit'",
]


@pytest.mark.parametrize("condition", CONDITIONS)
def test_predicates_mean_what_they_mean_in_spark(spark, written, condition, all_records=[]):  # noqa: B006
    if not all_records:
        all_records.extend(warc.read(spark, written).collect())
    schema = warc.read(spark, written).schema
    plain = spark.createDataFrame(all_records, schema).filter(condition)
    found = warc.read(spark, written).filter(condition)
    order = ["file", "offset"]
    assert found.orderBy(*order).collect() == plain.orderBy(*order).collect()


def test_pushed_predicates_leave_the_plan(spark, written, capsys):
    warc.read(spark, written).filter("record_type = 'revisit' and payload_bytes > 3").explain()
    plan = capsys.readouterr().out
    assert "payload_bytes" in plan.split("Filter")[1].split("\n")[0]
    assert "revisit" not in plan.split("+-")[-2].split("BatchScan")[0]


def reader(path, names, *filters):
    schema = warc.StructType()
    for name in names:
        schema.add(name, warc.TYPES[name])
    made = warc.WarcReader(path, schema, warc.SPLIT_BYTES)
    assert list(made.pushFilters(list(filters))) == []
    return made


@pytest.mark.parametrize("names, filters", [
    (["record_id", "record_type"], []),
    (["record_id", "record_type", "payload"], [warc.EqualTo(("record_type",), "revisit")]),
])
def test_unwanted_payloads_are_not_inflated(spark, written, names, filters, monkeypatch):
    inflated = []

    class Counting:
        def __init__(self, stream):
            self.stream = stream

        def decompress(self, data, most):
            out = self.stream.decompress(data, most)
            inflated.append(len(out))
            return out

        def __getattr__(self, name):
            return getattr(self.stream, name)

    real = warc.zlib.decompressobj
    monkeypatch.setattr(warc.zlib, "decompressobj", lambda bits: Counting(real(bits)))
    made = reader(written, names, *filters)
    rows = sum(b.num_rows for p in made.partitions() for b in made.read(p))
    assert rows == len(ROWS) - (len([r for r in expected(ROWS) if r[3] == "response"]) if filters else 0)
    assert sum(inflated) <= 1100 * len(ROWS)  # the largest payload alone has 4.4 million bytes


def test_files_of_other_writers(spark, tmp_path):
    def record(kind, block, *more):
        fields = [f"WARC-Type: {kind}", "warc-record-id: <urn:x:1>", *more, f"CONTENT-LENGTH: {len(block)}"]
        return b"WARC/1.0\r\n" + "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"

    info = record("warcinfo", b"software: a\r\n")
    page = record("response", b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nbody", "Content-Type: application/http", "X: a", " b", "x: c")
    lone = record("resource", b"WARC/1.0\r\n\r\n" * 3, "Content-Type: text/plain")
    os.makedirs(tmp_path / "sub")
    (tmp_path / "plain.warc").write_bytes(info + page + lone)
    (tmp_path / "sub" / "members.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in (info, page, lone)))
    (tmp_path / "empty.warc").write_bytes(b"")
    (tmp_path / "notes.txt").write_bytes(b"not an archive")
    found = warc.read(spark, str(tmp_path)).collect()
    for name in ("plain.warc", "members.warc.gz"):
        own = [r for r in found if r.file.endswith(name)]
        assert [r.record_type for r in own] == ["warcinfo", "response", "resource"]
        assert [bytes(r.payload) for r in own] == [b"software: a\r\n", b"body", b"WARC/1.0\r\n\r\n" * 3]
        assert [r.payload_bytes for r in own] == [13, 4, 36] and own[1].fields["x"] == "a b, c"
    one = warc.read(spark, str(tmp_path / "plain.warc"), "offset bigint").collect()
    assert [r.offset for r in one] == [0, len(info), len(info + page)]


@pytest.mark.parametrize("data", [b"plain text", b"WARC/1.0\r\nno end", b"WARC/1.0\r\nContent-Length: x\r\n\r\n", gzip.compress(b"WARC/1.0\r\n")[:-9]])
def test_other_bytes_are_refused(data):
    with pytest.raises(ValueError, match="no WARC record at byte 0"):
        list(warc.records(io.BufferedReader(io.BytesIO(data)), "x.warc"))


def test_small_files_share_a_partition(tmp_path):
    for k in range(10):
        (tmp_path / f"{k}.warc").write_bytes(b"x" * 10)
    planned = warc.WarcReader(str(tmp_path), warc.StructType(), 30).partitions()
    assert [len(p.paths) for p in planned] == [3, 3, 3, 1]


def test_unknown_columns_are_refused(spark, written):
    with pytest.raises(Exception, match="no column color"):
        warc.read(spark, written, "color string").collect()
    with pytest.raises(Exception, match="written from the columns"):
        spark.range(1).write.format("warc").mode("append").save(written)


def test_files_roll_and_overwriting_replaces(spark):
    path = scratch_path(spark, "test-roll")
    rows = warc.read(spark, path).schema  # the folder is not there yet
    assert "payload" in rows.names
    made = spark.range(20).select(
        F.lit("response").alias("record_type"), F.col("id").cast("string").alias("record_id"),
        *[F.lit(None).cast("string").alias(c) for c in ("target_uri", "record_date", "payload_digest", "refers_to")],
        F.lit(None).cast("bigint").alias("payload_bytes"), F.lit("x" * 1000).cast("binary").alias("payload"),
    ).coalesce(1)
    for mode, count in (("append", 20), ("append", 40), ("overwrite", 20)):
        made.write.format("warc").option("filebytes", 500).mode(mode).save(path)
        assert warc.read(spark, path, "record_id string").count() == count
    files = [n for n in os.listdir(local(path)) if n.endswith(".gz")]
    assert 3 <= len(files) <= 20 and not os.path.exists(f"{local(path)}/_temporary")
