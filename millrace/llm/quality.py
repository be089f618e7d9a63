"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or nothing on each document. Expectation-maximisation over
the counts of vote patterns estimates how far each labeller can be trusted and gives
every pattern a posterior chance of being good; no labelled rows are used. Posteriors of a sample
train a linear scorer over hashed features, which then judges every document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import rules
from millrace.llm.arrow import extended, fresh, slices, text_bytes, without
from millrace.llm.words import LOWER, U, text_numbers, word_tails
from millrace.session import stage

GOOD, BAD, NONE = 1, 0, 2
#: Hashed features: words, tails of words, and ranges of the text's rates.
WORDS, TAILS, RANGES = 2048, 512, 16
FEATURES = WORDS + TAILS + RANGES * len(rules.RATES)
#: Mean and weight of the priors on being right on bad, and on good documents.
PRIOR = ((0.4, 10.0), (0.995, 1000.0))


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, BAD).when(good, GOOD).otherwise(NONE)


def labellers() -> dict[str, Column]:
    """Votes from the counts and rates of ``rules``; labellers about words abstain on short texts."""
    some, many = F.col("n_words") >= 20, F.col("n_words") >= 60

    def per_word(count: str) -> Column:
        return F.coalesce(F.try_divide(F.col(count).cast("double"), F.col("n_words")), F.lit(0.0))

    return {
        "length": _vote(F.col("n_words") < 1, many),
        "symbols": _vote(F.col("symbols_per_char") > 0.02, some & (F.col("symbols_per_char") < 0.002)),
        "symbols_per_word": _vote(per_word("n_symbols") > 0.2, some & (per_word("n_symbols") < 0.02)),
        "capitals_per_word": _vote(some & (per_word("n_capitals") > 1.5), some & (per_word("n_capitals") < 0.4)),
        "lines": _vote((F.col("n_lines") >= 5) & (F.col("dup_line_share") > 0.2), (F.col("n_lines") >= 3) & (F.col("n_dup_lines") == 0)),
        "repeats": _vote(many & (F.col("repeat_word_share") > 0.3), many & (F.col("repeat_word_share") < 0.05)),
        "variety": _vote(many & (F.col("distinct_word_share") < 0.3), some & (F.col("distinct_word_share") > 0.6)),
        "capitals": _vote(some & (F.col("capital_share") > 0.25), some & (F.col("capital_share") < 0.06)),
        "word_size": _vote(
            some & ((F.col("chars_per_word") < 3) | (F.col("chars_per_word") > 7)),
            some & F.col("chars_per_word").between(4, 6.2),
        ),
    }


def pattern() -> Column:
    """All votes of a row as one number in base 3."""
    return sum((vote * 3**at for at, vote in enumerate(labellers().values())), F.lit(0)).cast("int")


def posteriors(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100, prior: tuple = PRIOR) -> np.ndarray:
    """Chance of good for each vote pattern, by expectation-maximisation over pattern counts.

    Each labeller has a chance of being right on good documents, at first 0.995, and one on bad
    documents, at first 0.4, since a heuristic knows one way of being bad and calls the others
    good; abstaining tells nothing. ``prior`` gives the means and weights, in votes, of Beta priors on bad and
    on good documents. The weights are fixed, so with many rows the votes alone decide.
    """
    return estimated(patterns, counts, rounds, prior)[0]


def estimated(
    patterns: np.ndarray, counts: np.ndarray, rounds: int = 100, prior: tuple = PRIOR
) -> tuple[np.ndarray, np.ndarray, float]:
    """Posteriors of the patterns, chance of being right by (bad or good, labeller), share of good."""
    number = len(labellers())
    votes = (patterns[:, None] // 3 ** np.arange(number)) % 3
    prior = np.array([(mean * weight, weight) for mean, weight in prior])  # right and all votes
    right = np.repeat(prior[:, :1] / prior[:, 1:], number, axis=1)
    share = 0.8
    for _ in range(rounds):
        good = np.where(votes == GOOD, right[1], np.where(votes == BAD, 1 - right[1], 1.0))
        bad = np.where(votes == BAD, right[0], np.where(votes == GOOD, 1 - right[0], 1.0))
        joint_good = share * good.prod(axis=1)
        joint_bad = (1 - share) * bad.prod(axis=1)
        chance = joint_good / (joint_good + joint_bad)
        weight = np.stack([(1 - chance) * counts, chance * counts])
        share = (weight[1].sum() + 8) / (counts.sum() + 10)
        for side, said in ((0, BAD), (1, GOOD)):
            agreed = weight[side] @ (votes == said)
            spoken = weight[side] @ (votes != NONE)
            right[side] = (agreed + prior[side, 0]) / (spoken + prior[side, 1])
    return chance, right, share


def features(texts: list[bytes], rates: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, columns and values of the hashed features of texts; words weigh 1 in all, ranges 1 each."""
    lowered = [text.translate(LOWER) for text in texts]
    numbers, sizes = text_numbers(lowered)
    text = np.repeat(np.arange(len(sizes)), sizes)
    share = np.repeat(1 / np.maximum(sizes, 1), sizes)
    tails = word_tails(lowered, TAILS)
    ranges = np.minimum(np.sqrt(rates / np.array([12, 1, 1, 1, 1, 1])) * RANGES, RANGES - 1).astype(np.int64)
    places = WORDS + TAILS + RANGES * np.arange(rates.shape[1])
    rows = np.concatenate([text, text, np.repeat(np.arange(len(sizes)), rates.shape[1])])
    columns = np.concatenate([(numbers % U(WORDS)).astype(np.int64), WORDS + tails, (ranges + places).ravel()])
    values = np.concatenate([share, share, np.ones(ranges.size)])
    return rows, columns, values


def trained(matrix: np.ndarray, chance: np.ndarray, rounds: int = 300, rate: float = 1.0) -> np.ndarray:
    """Weights, the last one the offset, of a logistic model of soft labels; both classes weigh the same."""
    if not len(matrix):
        return np.zeros(FEATURES + 1)
    x = np.hstack([matrix, np.ones((len(matrix), 1), matrix.dtype)])
    balance = chance / max(chance.sum(), 1) + (1 - chance) / max((1 - chance).sum(), 1)
    weights, speed = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for _ in range(rounds):
        error = (1 / (1 + np.exp(-(x @ weights))) - chance) * balance
        speed = 0.9 * speed - rate * (x.T @ error + 1e-4 * weights)
        weights = weights + speed
    return weights


def fit(df: DataFrame, text: str = "text", max_sample: int = 3000) -> np.ndarray:
    """Weights of the scorer.

    Votes are counted over all documents. At most ``max_sample`` documents, half of them from
    either side of the posterior as far as there are, train the weights: those of smallest
    hash. Pattern counts (3 to the power of the labellers) and the sample's features, of a fixed size
    a document, are collected.
    """
    hashed = df.select(F.xxhash64(F.col(f"`{text}`")).alias("_hash"), F.col(f"`{text}`").alias("text"))
    counted = rules.rates(rules.text_counts(hashed))
    voted = stage(counted.select("_hash", pattern().alias("pattern")), "votes")
    found = voted.groupBy("pattern").count().orderBy("pattern").collect()
    if not found:
        return np.zeros(FEATURES + 1)
    patterns = np.array([r["pattern"] for r in found])
    chance = posteriors(patterns, np.array([r["count"] for r in found], float))
    by_pattern = df.sparkSession.createDataFrame(
        [(int(p), float(c)) for p, c in zip(patterns, chance, strict=True)], "pattern int, chance double"
    )
    labelled = voted.join(F.broadcast(by_pattern), "pattern").select("_hash", "chance").distinct()
    half = max_sample // 2
    sides = [
        labelled.filter(f"chance {sign} 0.5").orderBy("_hash", "chance").limit(half) for sign in (">=", "<")
    ]
    # Documents of one hash are copies of one text; the sample is small enough to broadcast.
    sample = stage(sides[0].union(sides[1]), "sample")
    chosen = hashed.join(F.broadcast(sample), "_hash").dropDuplicates(["_hash", "chance"])
    made = chosen.select("_hash", "chance", text_bytes().alias("source")).mapInArrow(
        _featured, "_hash bigint, chance double, features binary"
    )
    rows = sorted(made.collect(), key=lambda r: (r["_hash"], r["chance"]))
    matrix = np.array([np.frombuffer(r["features"], np.float32) for r in rows]).reshape(-1, FEATURES)
    return trained(matrix, np.array([r["chance"] for r in rows]))


def _rates_of(counts: np.ndarray) -> np.ndarray:
    at = {name: k for k, name in enumerate(rules.COUNTS)}
    return np.stack([counts[:, at[a]] / np.maximum(counts[:, at[b]], 1) for a, b in rules.RATES.values()], axis=1)


def _counted(texts: list[bytes]) -> np.ndarray:
    return np.array([rules.counts_of(t) for t in texts], float).reshape(-1, len(rules.COUNTS))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "source"):
        texts = batch.column("source").to_pylist()
        matrix = np.zeros((len(texts), FEATURES), np.float32)
        row, column, value = features(texts, _rates_of(_counted(texts)))
        np.add.at(matrix, (row, column), value)
        batch = batch.drop_columns(["source"])
        yield batch.append_column("features", pa.array([vector.tobytes() for vector in matrix], pa.binary()))


def classify(df: DataFrame, weights: np.ndarray, text: str = "text", least: float = 0.2) -> DataFrame:
    """Add double ``quality_score`` between 0 and 1 and boolean ``good`` (score of ``least`` or more).

    A null text counts as empty; a text without words is never good. Repeated rows get the same
    score. Existing columns of these names are replaced, all others stay. The weights have a fixed size.
    """
    shared = df.sparkSession.sparkContext.broadcast(weights)
    kept = without(df, "quality_score", "good")
    bytes_column = fresh(kept, "_source_bytes")
    schema = extended(kept, "quality_score double, good boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in slices(batches, bytes_column):
            texts = batch.column(bytes_column).to_pylist()
            counts = _counted(texts)
            row, column, value = features(texts, _rates_of(counts))
            score = np.bincount(row, weights[column] * value, len(texts)) + weights[-1]
            score = 1 / (1 + np.exp(-np.clip(score, -50, 50)))
            good = (score >= least) & (counts[:, 0] > 0)
            batch = batch.drop_columns([bytes_column])
            batch = batch.append_column("quality_score", pa.array(score))
            yield batch.append_column("good", pa.array(good))

    return kept.withColumn(bytes_column, text_bytes(f"`{text}`")).mapInArrow(run, schema)
