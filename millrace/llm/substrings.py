"""Repeated word sequences found by recompression and removed.

Rounds of recompression turn texts into symbols that stand for several words. Their names are
counted over all documents; a window of words can only occur twice if all symbols that it
decides occur twice. The windows that pass are verified by counting the windows
themselves. Both counts are exchanges of packed numbers (``exchange``), and text moves to
the answers twice, never to other text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import exchange
from millrace.llm.arrow import extended, slices, text_bytes
from millrace.llm.recompress import Symbols, candidate_windows, recompressed
from millrace.llm.words import shingles, text_numbers


def remove_repeats(
    df: DataFrame, key: str = "doc_id", text: str = "text", window: int = 35
) -> DataFrame:
    """(key, n_words, n_removed, kept) for every row: ``kept`` has the words left, joined by a space.

    A word goes if a window of ``window`` words that covers it has the same words as a window
    that starts anywhere else, in the same text too; windows are judged on the input. Windows
    are compared as 64-bit numbers. Null and empty texts have no words; texts shorter than a
    window keep theirs. Repeated rows are each other's copies. Null keys are kept, other
    columns are not returned, and an empty table gives an empty one.
    """
    count = exchange.partitions(df.sparkSession)
    rows = df.select(
        exchange.document_number(key, text).alias("doc"),
        F.col(f"`{key}`").alias("key"),
        text_bytes(f"`{text}`").alias("text"),
    )
    marked = exchange.deal(rows.select("doc", "text").mapInArrow(_ask_symbols(count), exchange.PACKET), count)
    repeated = marked.mapInArrow(exchange.answered(count), exchange.PACKET)
    held = exchange.documents_with(repeated, rows.select("doc", "text"), count)
    windows = exchange.deal(held.mapInArrow(_ask_windows(window, count), exchange.PACKET), count)
    verified = windows.mapInArrow(exchange.answered(count), exchange.PACKET)
    final = exchange.documents_with(verified, rows, count).drop("values")
    schema = extended(rows.select("key"), "n_words bigint, n_removed bigint, kept string")
    return final.mapInArrow(_cut(window, schema.names), schema).withColumnRenamed("key", key)


def _symbols(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, Symbols, np.ndarray]:
    """Word numbers, words per text, symbols, and the first symbol of each text."""
    numbers, sizes = text_numbers(texts)
    symbols = recompressed(numbers, sizes)
    return numbers, sizes, symbols, np.searchsorted(symbols.texts, np.arange(len(sizes)))


def _ask_symbols(count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            _, _, symbols, first = _symbols(batch.column("text").to_pylist())
            docs = np.array(batch.column("doc"), np.int64)[symbols.texts]
            places = np.arange(len(docs)) - first[symbols.texts]
            yield from exchange.asked(docs, places, symbols.names, count)

    return run


def _ask_windows(window: int, count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for answers, rows in exchange.partition_of(batches):
            for batch in slices([rows], "text"):
                numbers, sizes, symbols, first = _symbols(batch.column("text").to_pylist())
                docs = np.array(batch.column("doc"), np.int64)
                unique = np.ones(len(symbols.names), bool)
                for begin, doc in zip(first.tolist(), docs.tolist(), strict=True):
                    unique[begin + answers.of(doc)] = False
                starts = candidate_windows(symbols, unique, sizes, window)
                if len(starts):
                    before = np.cumsum(sizes) - sizes
                    text = np.searchsorted(before, starts, "right") - 1
                    places = starts - before[text]
                    values = shingles(numbers, window)[starts]
                    yield from exchange.asked(docs[text], places, values, count)

    return run


def _cut(window: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for answers, rows in exchange.partition_of(batches):
            for batch in slices([rows], "text"):
                out = []
                texts = batch.column("text").to_pylist()
                for doc, text in zip(batch.column("doc").to_pylist(), texts, strict=True):
                    words = text.split()
                    total, places = len(words), answers.of(doc)
                    if len(places):
                        depth = np.zeros(total + 1, np.int64)
                        places = np.unique(places)
                        depth[places] += 1
                        depth[places + window] -= 1
                        words = [words[k] for k in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]
                    out.append((total, total - len(words), b" ".join(words).decode()))
                kinds = (pa.int64(), pa.int64(), pa.string())
                columns = [pa.array(v, t) for v, t in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("key"), *columns], names=names)

    return run
