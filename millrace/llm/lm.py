"""Language-model scores of whole texts by a hidden Markov model over all words.

Words fall into classes: frequent words have one of their own, others share one by their
last bytes. The chance of a text is the sum over hidden states of start, transition and class
chances, times each word's share of its class. Word counts are gathered from all training
texts (``exchange``); counts of frequent words, of which there can only be so many, and class
totals are broadcast, and all other counts go back to the documents that asked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import exchange
from millrace.llm.arrow import extended, slices, text_bytes
from millrace.llm.hmm import Hmm, expected_counts, log_likelihoods
from millrace.llm.words import LOWER, U, text_numbers, word_tails
from millrace.session import stage

#: A word is broadcast if it has at least this share of all tokens, so at most a million are.
FREQUENT = 1e-6
#: Classes: 0 is the end of a text, then frequent words, then tails of words.
OWN, TAILS = 4096, 2048
CLASSES = OWN + TAILS
#: Stretches of the class range in which expected counts are added up.
PARTS = 16
SUMS = "target int, sums binary"
#: Bytes of class sequences, two a token, that a task works on at once.
CODED_BYTES = 1 << 19


def held_out(key: Column, fold: int = 2, folds: int = 7) -> Column:
    """Rows whose crc32 of the key's text leaves ``fold``; rows with a null key are for training."""
    return F.coalesce(F.crc32(key.cast("string")) % folds == fold, F.lit(False))


def score_texts(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    test: Column | None = None,
    states: int = 6,
    rounds: int = 4,
) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.

    Tokens are the words, A to Z lowered, and one end. The model learns from all rows where
    ``test`` is false. ``base_score`` is the sum of log10((c + 1) / (N + V + 1)) of the tokens'
    training counts c, with N tokens and V distinct ones in training; ``score`` is the log10 of the
    model's chance of the text, by forward recursion over the whole text.

    Null and empty texts are an end alone. Repeated rows count and are scored each. Without
    training rows all counts are 0. Other columns are not returned; an empty table gives an empty one.
    """
    spark = df.sparkSession
    count = exchange.partitions(spark)
    test = held_out(F.col(f"`{key}`")) if test is None else test
    rows = df.select(
        exchange.document_number(key, text).alias("doc"),
        F.col(f"`{key}`").alias("key"),
        test.alias("held_out"),
        text_bytes(f"`{text}`").alias("text"),
    )
    trained = rows.filter(~F.col("held_out"))
    counted = exchange.deal(trained.select("text").mapInArrow(_ask_counts(count), exchange.PACKET), count)
    totals = "tokens bigint, distinct bigint, words binary, tails binary, counts binary"
    counts = stage(counted.mapInArrow(_add_counts, totals), "counts")
    sums = counts.agg(F.sum("tokens"), F.sum("distinct")).first()
    n_texts = trained.count()
    tokens, distinct = (sums[0] or 0) + n_texts, (sums[1] or 0) + (n_texts > 0)
    lexicon = Lexicon.of(counts, tokens, n_texts)
    shared = spark.sparkContext.broadcast(lexicon)

    coded = extended(
        rows.drop("text"), "n_tokens bigint, n_rare bigint, log_counts double, n_known bigint, classes binary"
    )
    documents = stage(rows.mapInArrow(_code(shared, coded.names), coded), "coded")
    model = fit(documents.filter(~F.col("held_out")).select("classes"), lexicon, states, rounds)
    scored = documents.mapInArrow(
        _forward(spark.sparkContext.broadcast(model), shared), extended(documents.drop("classes"), "log_chance double")
    )
    asked = exchange.deal(rows.drop("key").mapInArrow(_ask_rare(shared, count), exchange.PACKET), count)
    rare = asked.mapInArrow(_rare_answers(count), exchange.PACKET)
    final = exchange.documents_with(rare, scored, count)
    schema = extended(
        rows.select("key", "held_out"),
        "n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    )
    result = final.mapInArrow(_combined(tokens, distinct, schema.names), schema)
    return result.withColumnRenamed("key", key)


def _ask_counts(count: int):
    """Packets of words with their counts in a slice; counts stand in the place of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = [text.translate(LOWER) for text in batch.column("text").to_pylist()]
            numbers, _ = text_numbers(texts)
            words, first, found = np.unique(numbers, return_index=True, return_counts=True)
            tails = word_tails(texts, TAILS)[first]
            order = np.argsort(found, kind="stable")
            words, tails, found = words[order], tails[order], found[order]
            yield exchange.packets(exchange.ASK, exchange.number_target(words, count), found, tails, words)

    return run


def _add_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [exchange.entries(batch, "values") for batch in batches]
    if not held:
        return
    found, tails, words = (np.concatenate(parts) for parts in zip(*held, strict=True))
    held.clear()
    words, first, inverse = np.unique(words, return_index=True, return_inverse=True)
    sums = np.bincount(inverse, found, len(words)).astype(np.int64)
    row = [sums.sum(), len(words), words.tobytes(), tails[first].astype(np.int16).tobytes(), sums.tobytes()]
    types = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    columns = [pa.array([value], kind) for value, kind in zip(row, types, strict=True)]
    yield pa.RecordBatch.from_arrays(columns, names=["tokens", "distinct", "words", "tails", "counts"])


class Lexicon:
    """Frequent words with count and class, and the size of each class."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, classes: np.ndarray, sizes: np.ndarray, n_texts: int):
        self.words, self.counts, self.classes = words, counts, classes
        #: Sum of count + 1 over a class, and 1 for a word not met in training.
        self.sizes = sizes
        self.n_texts = n_texts

    @staticmethod
    def of(counts: DataFrame, tokens: int, n_texts: int) -> Lexicon:
        least = max(2, int(np.ceil(FREQUENT * tokens)))
        found = counts.mapInArrow(_frequent(least), "word bigint, tail int, n bigint").collect()
        words = np.array([r["word"] for r in found], np.int64).view(U)
        tails, n = np.array([r["tail"] for r in found], int), np.array([r["n"] for r in found], np.int64)
        order = np.lexsort((words, -n))
        words, tails, n = words[order], tails[order], n[order]
        classes = OWN + tails
        classes[: OWN - 1] = np.arange(1, min(OWN - 1, len(words)) + 1)
        own = n[: OWN - 1]
        sizes = np.zeros(CLASSES, np.int64)
        sizes[OWN:] = _summed(counts.mapInArrow(_class_sizes, SUMS), TAILS)
        np.subtract.at(sizes, OWN + tails[: OWN - 1], own + 1)
        sizes[OWN:] += 1
        sizes[1 : len(own) + 1] = own + 1
        sizes[0] = n_texts + 1
        order = np.argsort(words)
        return Lexicon(words[order], n[order], classes[order], np.maximum(sizes, 1), n_texts)

    def shares(self) -> np.ndarray:
        return self.sizes / self.sizes.sum()

    def look_up(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of numbers among the frequent words, and whether they are there."""
        if not len(self.words):
            return np.zeros(len(numbers), np.int64), np.zeros(len(numbers), bool)
        at = np.minimum(np.searchsorted(self.words, numbers), len(self.words) - 1)
        return at, self.words[at] == numbers


def _frequent(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, tails, counts in _stored(batches):
            hit = counts >= least
            columns = [words[hit].view(np.int64), tails[hit].astype(np.int32), counts[hit]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["word", "tail", "n"])

    return run


def _class_sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, tails, counts in _stored(batches):
        yield _sum_rows(np.bincount(tails, counts + 1, TAILS))


def _stored(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("words", "tails", "counts")), strict=True):
            yield tuple(np.frombuffer(v, kind) for v, kind in zip(row, (U, np.int16, np.int64), strict=True))


def _code(shared, names: list[str]):
    """Class sequences of documents, and what their frequent words and end add to the counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon: Lexicon = shared.value
        logs = np.log10(lexicon.counts + 1)
        for batch in slices(batches, "text"):
            texts = [text.translate(LOWER) for text in batch.column("text").to_pylist()]
            numbers, sizes = text_numbers(texts)
            at, known = lexicon.look_up(numbers)
            classes = OWN + word_tails(texts, TAILS)
            classes[known] = lexicon.classes[at[known]]
            text = np.repeat(np.arange(len(sizes)), sizes)
            n_known = np.bincount(text[known], minlength=len(sizes))
            log_counts = np.bincount(text[known], logs[at[known]], len(sizes)) + np.log10(lexicon.n_texts + 1)
            ends = np.cumsum(sizes)
            sequences = [
                np.append(part, 0).astype(np.int16).tobytes() for part in np.split(classes, ends[:-1])
            ]
            columns = [
                pa.array(sizes + 1),
                pa.array(sizes - n_known),
                pa.array(log_counts),
                pa.array(n_known + (lexicon.n_texts > 0)),
                pa.array(sequences, pa.binary()),
            ]
            kept = [batch.column(c) for c in ("doc", "key", "held_out")]
            yield pa.RecordBatch.from_arrays([*kept, *columns], names=names)

    return run


def _ask_rare(shared, count: int):
    """Packets of each document's distinct rare words; a place is the word's count in it.

    Counts of documents held out are negative: they ask without adding to the word's count.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = [text.translate(LOWER) for text in batch.column("text").to_pylist()]
            numbers, sizes = text_numbers(texts)
            _, known = shared.value.look_up(numbers)
            text = np.repeat(np.arange(len(sizes)), sizes)[~known]
            numbers = numbers[~known]
            order = np.lexsort((numbers, text))
            text, numbers = text[order], numbers[order]
            begins = np.ones(len(text), bool)
            begins[1:] = (text[1:] != text[:-1]) | (numbers[1:] != numbers[:-1])
            at = np.flatnonzero(begins)
            found = np.diff(np.append(at, len(text)))
            text, numbers = text[at], numbers[at]
            sign = np.where(np.array(batch.column("held_out")), -1, 1)[text]
            docs = np.array(batch.column("doc"), np.int64)[text]
            yield exchange.packets(exchange.ASK, exchange.number_target(numbers, count), docs, sign * found, numbers)

    return run


def _rare_answers(count: int):
    """Per document, from its owner's words: known tokens (place) and the sum of log10(c + 1) (value)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [exchange.entries(batch, "values") for batch in batches]
        if not held:
            return
        docs, found, words = (np.concatenate(parts) for parts in zip(*held, strict=True))
        held.clear()
        # A document that is there several times asks once and counts each time.
        order = np.lexsort((docs, words))
        docs, found, words = docs[order], found[order], words[order]
        new_word = np.ones(len(words), bool)
        new_word[1:] = words[1:] != words[:-1]
        word = np.cumsum(new_word) - 1
        counts = np.bincount(word, np.maximum(found, 0))
        once = new_word.copy()
        once[1:] |= docs[1:] != docs[:-1]
        docs, times, c = docs[once], np.abs(found[once]), counts[word[once]]
        distinct, doc = np.unique(docs, return_inverse=True)
        logs = np.bincount(doc, times * np.log10(c + 1), len(distinct))
        known = np.bincount(doc, times * (c > 0), len(distinct)).astype(np.int32)
        yield exchange.packets(
            exchange.ANSWER, exchange.document_target(distinct, count), distinct, known, logs.view(U)
        )

    return run


def _combined(tokens: int, distinct: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for answers, batch in exchange.partition_of(batches, "values"):
            docs = np.array(batch.column("doc"), np.int64)
            known, logs = answers.sums_of(docs)
            log_counts = np.array(batch.column("log_counts")) + logs
            n_tokens = np.array(batch.column("n_tokens"))
            base = log_counts - n_tokens * np.log10(tokens + distinct + 1)
            columns = [
                batch.column("key"),
                batch.column("held_out"),
                pa.array(n_tokens),
                pa.array(np.array(batch.column("n_known")) + known),
                pa.array(np.full(len(docs), tokens, np.int64)),
                pa.array(base),
                pa.array(np.array(batch.column("log_chance")) + log_counts),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _forward(model, shared):
    """log10 of the chance of each class sequence, less the sizes of its classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log_sizes = np.log10(shared.value.sizes)
        for batch in slices(batches, "classes", CODED_BYTES):
            sequences = [np.frombuffer(s, np.int16) for s in batch.column("classes").to_pylist()]
            chance = log_likelihoods(model.value, sequences) / np.log(10)
            chance -= [log_sizes[s].sum() for s in sequences]
            yield batch.drop_columns(["classes"]).append_column("log_chance", pa.array(chance))

    return run


def fit(sequences: DataFrame, lexicon: Lexicon, states: int, rounds: int) -> Hmm:
    """Baum-Welch over all class sequences.

    A round reads every sequence, each as a whole; tasks add up expected
    counts, which are added up again by stretch of classes. Only (classes, states) sums reach the driver.
    """
    spark = sequences.sparkSession
    shares = lexicon.shares()
    model = Hmm.start(shares, states)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(model)
        flat = _summed(sequences.mapInArrow(_expect(shared), SUMS), states * (1 + states + CLASSES))
        head, emit = flat[: states * (1 + states)], flat[states * (1 + states) :].reshape(-1, states)
        model = model.reestimated(head[:states], head[states:].reshape(states, states), emit, shares)
        shared.unpersist()
    return model


def _expect(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Hmm = shared.value
        total = None
        for batch in slices(batches, "classes", CODED_BYTES):
            sequences = [np.frombuffer(s, np.int16) for s in batch.column("classes").to_pylist() if s]
            if not sequences:
                continue
            counts = expected_counts(model, sequences)
            total = counts if total is None else tuple(a + b for a, b in zip(total, counts, strict=True))
        if total is not None:
            yield _sum_rows(np.concatenate([part.ravel() for part in total]))

    return run


def _sum_rows(values: np.ndarray) -> pa.RecordBatch:
    """What a task has added up, in ``PARTS`` rows."""
    parts = [part.tobytes() for part in np.array_split(values.astype(np.float64), PARTS)]
    return pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array(parts)], names=["target", "sums"])


def _summed(rows: DataFrame, size: int) -> np.ndarray:
    """Sums over all tasks, part by part; zeros where there is no task."""
    added = exchange.deal(rows, PARTS).mapInArrow(_add_sums, SUMS).collect()
    sums = {row["target"]: np.frombuffer(row["sums"], np.float64) for row in added}
    return np.concatenate([sums[k] for k in range(PARTS)]) if sums else np.zeros(size)


def _add_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in slices(batches):
        for target, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            part = np.frombuffer(packed, np.float64)
            sums[target] = sums[target] + part if target in sums else part
    if sums:
        columns = [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()])]
        yield pa.RecordBatch.from_arrays(columns, names=["target", "sums"])
