"""Benchmark items found inside documents by containment.

An item is contained in a document if the document holds at least a given share of the
item's shingles. Items are partitioned by size, since a sample that finds a short item
inside a long document must not depend on the document's size: each size class takes
from its items the MinHash sample, that is the shingles of smallest hash, that is large
enough that a document holding the share must hold a fixed number of sampled shingles.
Documents whose shingles meet a sample often enough are candidates and are
verified on the words of all shingles.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from millrace.llm.arrow import fresh, slices, text_bytes, without
from millrace.llm.words import PLAIN, U, numbers_by_text, shingles

#: Bytes of item texts that are broadcast at a time; more items take several passes.
BLOCK_BYTES = 8 << 20
#: Sampled shingles that a document has to hold beyond none, as far as the item is long enough.
SPARE_HITS = 2


def words_of(text: bytes) -> list[bytes]:
    """Words compared: A to Z lowered, ASCII punctuation counted as space."""
    return text.translate(PLAIN).split()


@dataclass(frozen=True)
class Item:
    number: int
    width: int
    parts: frozenset[tuple[bytes, ...]]
    needed: int


def items_of(texts: list[bytes], words: int, share: float) -> list[Item]:
    """Shingle sets; an item of fewer words than ``words`` is one shingle, one without words none."""
    items = []
    for number, text in enumerate(texts):
        found = words_of(text)
        width = min(words, len(found))
        if width:
            parts = frozenset(zip(*(found[k:] for k in range(width)), strict=False))
            items.append(Item(number, width, parts, ceil(share * len(parts) - 1e-9)))
    return items


class Sample:
    """Sampled shingles of the items of one width, and all their shingles by number."""

    def __init__(self, items: list[Item], share: float):
        self.width = items[0].width
        hits: dict[int, list[int]] = defaultdict(list)
        self.needed_hits: dict[int, int] = {}
        by_class: dict[int, list[Item]] = defaultdict(list)
        for item in items:
            by_class[len(item.parts).bit_length()].append(item)
        for members in by_class.values():
            # A document with the share lacks at most ``lacking`` shingles of an item, so it
            # holds ``size - lacking`` of any sample; the class's largest item sets the size.
            lacking = max(len(item.parts) - item.needed for item in members)
            size = lacking + 1 + SPARE_HITS
            for item in members:
                values = np.sort(_numbered(item))[:size]
                self.needed_hits[item.number] = max(1, len(values) - (len(item.parts) - item.needed))
                for value in values.tolist():
                    hits[value].append(item.number)
        self.values = np.array(sorted(hits), U)
        self.of = [hits[v] for v in self.values.tolist()]
        self.low = np.zeros(1 << 20, bool)
        self.low[(self.values & U((1 << 20) - 1)).astype(np.int64)] = True

    def candidates(self, found: np.ndarray) -> list[int]:
        """Items whose samples the shingles of a document meet often enough."""
        near = found[self.low[(found & U((1 << 20) - 1)).astype(np.int64)]]
        if not len(near):
            return []
        near = np.unique(near)
        at = np.minimum(np.searchsorted(self.values, near), len(self.values) - 1)
        count: dict[int, int] = defaultdict(int)
        for k in at[self.values[at] == near].tolist():
            for number in self.of[k]:
                count[number] += 1
        return [number for number, n in count.items() if n >= self.needed_hits[number]]


def _numbered(item: Item) -> np.ndarray:
    parts = numbers_by_text([b" ".join(part) for part in item.parts])
    return np.array([shingles(p, item.width)[0] for p in parts], U)


def mark_contained(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    words: int = 5,
    share: float = 0.8,
) -> DataFrame:
    """Add ``contained``, an array of (item, n_shared, n_shingles), to every row of ``documents``.

    Items are compared as sets of shingles of ``words`` words; shorter items are one shingle
    of their own width. Null and empty texts contain nothing and are contained in nothing; without items
    all arrays are empty. Repeated rows on either side give repeated answers; null items are kept. An
    existing column ``contained`` is replaced. Nothing is missed: a document that holds the share
    holds the sampled shingles asked for.

    Documents are read once for each block of ``BLOCK_BYTES`` of item texts, and nothing is
    shuffled: the items are a query set, and a block of it is what tasks get by broadcast.
    """
    spark = documents.sparkSession
    items = benchmark.select(F.col(f"`{item}`").alias("item"), text_bytes().alias("text"))
    kind = items.schema["item"].dataType
    found = f"array<struct<item: {kind.simpleString()}, n_shared: bigint, n_shingles: bigint>>"
    rows = without(documents, "contained")
    bytes_column = fresh(rows, "_source_bytes")
    rows = rows.withColumn(bytes_column, text_bytes(f"`{text}`"))
    rows = rows.withColumn("contained", F.array().cast(found))
    for block in _blocks(items):
        shared = spark.sparkContext.broadcast(block)
        rows = rows.mapInArrow(_search(shared, bytes_column, words, share, to_arrow_type(rows.schema["contained"].dataType)), rows.schema)
    return rows.drop(bytes_column)


def contained_items(
    documents: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    words: int = 5,
    share: float = 0.8,
) -> DataFrame:
    """(key, item, n_shared, n_shingles, containment) for each document row and item it contains.

    As ``mark_contained``; null keys are kept, other columns are not returned.
    """
    rows = documents.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    marked = mark_contained(rows, benchmark, "text", item, words, share)
    pairs = marked.select("key", F.explode("contained").alias("hit"))
    return pairs.select(
        F.col("key").alias(key),
        F.col("hit.item").alias(item),
        "hit.n_shared",
        "hit.n_shingles",
        (F.col("hit.n_shared") / F.col("hit.n_shingles")).alias("containment"),
    )


def _blocks(items: DataFrame) -> Iterator[list[tuple]]:
    """Items in blocks of bounded size, read one partition at a time."""
    block, size = [], 0
    for row in items.filter(F.octet_length("text") > 0).toLocalIterator():
        block.append((row["item"], bytes(row["text"])))
        size += len(row["text"])
        if size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def _search(shared, bytes_column: str, words: int, share: float, found: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [name for name, _ in shared.value]
        items = {item.number: item for item in items_of([text for _, text in shared.value], words, share)}
        by_width: dict[int, list[Item]] = defaultdict(list)
        for item in items.values():
            by_width[item.width].append(item)
        samples = [Sample(members, share) for members in by_width.values()]
        for batch in slices(batches, bytes_column):
            texts = [text.translate(PLAIN) for text in batch.column(bytes_column).to_pylist()]
            marked = batch.column("contained").to_pylist()
            for k, numbered in enumerate(numbers_by_text(texts)):
                for sample in samples:
                    candidates = sample.candidates(shingles(numbered, sample.width))
                    if not candidates:
                        continue
                    found_words = texts[k].split()
                    parts = set(zip(*(found_words[j:] for j in range(sample.width)), strict=False))
                    for number in sorted(candidates):
                        item = items[number]
                        n = len(item.parts & parts)
                        if n >= item.needed:
                            hit = {"item": names[number], "n_shared": n, "n_shingles": len(item.parts)}
                            marked[k].append(hit)
            at = batch.schema.get_field_index("contained")
            yield batch.set_column(at, "contained", pa.array(marked, found))

    return run
