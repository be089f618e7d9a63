"""Asking about 64-bit numbers across all rows, with packed arrays instead of a row each.

A task that holds documents sends numbers to the partition that owns them, one packet of
arrays per target. The owner sees all occurrences of its numbers and answers to the
partitions of the documents that asked. Numbers are hashes, so owners have even shares;
numbers that are frequent within a slice of documents are answered there, and the owner hears
of them once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.words import U

#: A packet: its target partition; documents by number with their count of entries; then an
#: entry each in places (what of the document) and values.
PACKET = "target int, kind int, docs binary, counts binary, places binary, values binary"
ASK, ANSWER, DOCUMENT = 0, 1, 2


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def document_number(key: str, text: str) -> Column:
    """Number of a document; rows equal in key and text share it and get the same answers."""
    return F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text}`"))


def document_target(docs: np.ndarray, count: int) -> np.ndarray:
    return np.mod(docs, count).astype(np.int32)


def number_target(numbers: np.ndarray, count: int) -> np.ndarray:
    return ((numbers >> U(32)) * U(count) >> U(32)).astype(np.int32)


def _planes(values: np.ndarray) -> bytes:
    """Differences of 32-bit integers, all lowest bytes first: mostly zeros, which shuffles compress."""
    steps = np.diff(values.astype(np.int32), prepend=np.int32(0))
    return steps.view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(packed: bytes) -> np.ndarray:
    steps = np.frombuffer(packed, np.uint8).reshape(4, -1).T
    return np.cumsum(np.ascontiguousarray(steps).view(np.int32).ravel(), dtype=np.int32)


def packets(
    kind: int, target: np.ndarray, docs: np.ndarray, places: np.ndarray, values: np.ndarray | None
) -> pa.RecordBatch:
    """One packet per target; entries of a document that follow each other stay together."""
    order = np.argsort(target, kind="stable")
    target, docs, places = target[order], docs[order], places[order]
    new_target = np.ones(len(order), bool)
    new_target[1:] = target[1:] != target[:-1]
    new_doc = new_target.copy()
    new_doc[1:] |= docs[1:] != docs[:-1]
    doc_at = np.flatnonzero(new_doc)
    entry_cuts = np.append(np.flatnonzero(new_target), len(order))
    doc_cuts = np.append(np.flatnonzero(new_target[doc_at]), len(doc_at))
    counts = np.diff(np.append(doc_at, len(order))).astype(np.int32)

    def planes(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
        return pa.array([_planes(part) for part in np.split(values, cuts[1:-1])][: len(cuts) - 1], pa.binary())

    def cut(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
        ends = (cuts * values.itemsize).astype(np.int32)
        buffers = [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(values.tobytes())]
        return pa.Array.from_buffers(pa.binary(), len(ends) - 1, buffers)

    rows = len(entry_cuts) - 1
    columns = [
        pa.array(target[entry_cuts[:-1]], pa.int32()),
        pa.array(np.full(rows, kind, np.int32)),
        cut(docs[doc_at].astype(np.int64), doc_cuts),
        planes(counts, doc_cuts),
        planes(places, entry_cuts),
        pa.nulls(rows, pa.binary()) if values is None else cut(values[order].astype(U), entry_cuts),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["target", "kind", "docs", "counts", "places", "values"])


def entries(batch: pa.RecordBatch, *more: str) -> tuple[np.ndarray, ...]:
    """docs and places, and values if named, of all entries of all packets of a batch."""

    def joined(name: str, kind) -> np.ndarray:
        return np.frombuffer(b"".join(batch.column(name).to_pylist()), kind)

    def unfolded(name: str) -> np.ndarray:
        parts = [_from_planes(packed) for packed in batch.column(name).to_pylist()]
        return np.concatenate(parts) if parts else np.empty(0, np.int32)

    docs = np.repeat(joined("docs", np.int64), unfolded("counts"))
    return docs, unfolded("places"), *(joined(name, U) for name in more)


def asked(docs: np.ndarray, places: np.ndarray, values: np.ndarray, count: int) -> Iterator[pa.RecordBatch]:
    """Packets asking whether each value occurs more than once anywhere.

    What occurs twice in these entries is answered here; its owner gets one entry of
    place -1 that stands for several.
    """
    distinct, inverse, found = np.unique(values, return_inverse=True, return_counts=True)
    several = found[inverse] > 1
    yield packets(ANSWER, document_target(docs[several], count), docs[several], places[several], None)
    many = distinct[found > 1]
    yield packets(ASK, number_target(many, count), np.zeros(len(many), np.int64), np.full(len(many), -1), many)
    docs, places, values = docs[~several], places[~several], values[~several]
    yield packets(ASK, number_target(values, count), docs, places, values)


def answered(count: int):
    """Task of the owners: entries whose value occurs more than once, dealt to their documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            kinds = np.array(batch.column("kind"))
            if (kinds == ANSWER).any():
                yield batch.filter(pa.array(kinds == ANSWER))
            if (kinds == ASK).any():
                held.append(entries(batch.filter(pa.array(kinds == ASK)), "values"))
        if held:
            docs, places, values = (np.concatenate(parts) for parts in zip(*held, strict=True))
            held.clear()
            _, inverse, found = np.unique(values, return_inverse=True, return_counts=True)
            found = found + np.bincount(inverse, places < 0, len(found)).astype(np.int64)
            hit = (found[inverse] > 1) & (places >= 0)
            docs, places = docs[hit], places[hit]
            order = np.argsort(docs, kind="stable")
            docs, places = docs[order], places[order]
            yield packets(ANSWER, document_target(docs, count), docs, places, None)

    return run


def deal(df: DataFrame, count: int) -> DataFrame:
    """Rows to the partition that ``target`` names."""
    return df.repartitionById(count, F.col("target"))


class Answers:
    """Answers of one partition by document."""

    def __init__(self, held: list[tuple[np.ndarray, ...]]):
        docs = np.concatenate([h[0] for h in held]) if held else np.empty(0, np.int64)
        places = np.concatenate([h[1] for h in held]) if held else np.empty(0, np.int32)
        values = np.concatenate([h[2] for h in held]) if held and len(held[0]) > 2 else None
        order = np.lexsort((places, docs))
        self.docs, self.places = docs[order], places[order]
        self.values = None if values is None else values[order].view(np.float64)

    def of(self, doc: int) -> np.ndarray:
        """Places answered for a document, ascending; a place may come several times."""
        begin = np.searchsorted(self.docs, doc, "left")
        end = np.searchsorted(self.docs, doc, "right")
        return self.places[begin:end]

    def sums_of(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums of the places, and of the values as numbers, answered for each document."""
        begin, end = np.searchsorted(self.docs, docs, "left"), np.searchsorted(self.docs, docs, "right")
        values = np.zeros(0) if self.values is None else self.values
        sums = [np.concatenate([[0], np.cumsum(x)]) for x in (self.places.astype(np.int64), values)]
        return sums[0][end] - sums[0][begin], sums[1][end] - sums[1][begin]


def documents_with(answers: DataFrame, documents: DataFrame, count: int) -> DataFrame:
    """Answers before documents in the partition of each document.

    ``documents`` has columns doc (its number) and more; these are null in rows of answers.
    """
    dealt = documents.withColumns(
        {"target": F.pmod("doc", F.lit(count)).cast("int"), "kind": F.lit(DOCUMENT)}
    )
    rows = deal(answers.unionByName(dealt, allowMissingColumns=True), count)
    return rows.sortWithinPartitions("kind")


def partition_of(batches: Iterator[pa.RecordBatch], *more: str) -> Iterator[tuple[Answers, pa.RecordBatch]]:
    """Batches of documents of a partition with the partition's answers, values too if named."""
    held, answers = [], None
    for batch in batches:
        kinds = np.array(batch.column("kind"))
        known = kinds != DOCUMENT
        if known.any():
            held.append(entries(batch.filter(pa.array(known)), *more))
        if not known.all():
            if answers is None:
                answers = Answers(held)
                held = []
            yield answers, batch.filter(pa.array(~known))
