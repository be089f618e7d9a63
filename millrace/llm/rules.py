"""Quality rules as a learned decision list.

Statistics of every whole text are computed in one pass. Sequential covering on a
bounded sample of labelled rows grows a conjunction of thresholds that covers bad
rows, prunes it on rows held back, removes what it covers and goes on. The ordered
rules come back as text and as one Spark conditional expression.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrow import extended, fresh, slices, text_bytes, without

COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_distinct_words",
    "n_lines",
    "n_capitals",
)
SYMBOLS = b"#*$%&|<>"
CAPITALS = bytes(range(65, 91))
#: What rules look at: numerator and denominator; the rate is 0 where the latter is 0.
RATES = {
    "chars_per_word": ("word_chars", "n_words"),
    "symbols_per_char": ("n_symbols", "word_chars"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_word_share": ("n_repeat_words", "n_words"),
    "distinct_word_share": ("n_distinct_words", "n_words"),
    "capital_share": ("n_capitals", "word_chars"),
}


def counts_of(text: bytes) -> tuple[int, ...]:
    """``COUNTS`` of one text given as UTF-8 bytes."""
    words = text.split()
    joined = b"".join(words)
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        len(joined.decode("utf-8", "replace")),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        _repeated(words),
        len(set(words)),
        len(lines),
        len(text) - len(text.translate(None, CAPITALS)),
    )


def _repeated(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    found = Counter(windows)
    total = covered_to = 0
    for at, window in enumerate(windows):
        if found[window] > 1:
            total += at + 3 - max(at, covered_to)
            covered_to = at + 3
    return total


def text_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the bigint columns ``COUNTS``; a null or empty text has zeros.

    Columns of the same names are replaced; rows stay as they are, and ``text`` is
    not returned. Bytes that are no UTF-8 count as U+FFFD.
    """
    bytes_column = fresh(df, "_source_bytes")
    rows = without(df.withColumn(bytes_column, text_bytes(f"`{text}`")), text, *COUNTS)
    schema = extended(without(rows, bytes_column), ", ".join(f"{c} bigint" for c in COUNTS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, bytes_column):
            counted = [counts_of(t) for t in batch.column(bytes_column).to_pylist()]
            batch = batch.drop_columns([bytes_column])
            for name, values in zip(COUNTS, zip(*counted, strict=True), strict=True):
                batch = batch.append_column(name, pa.array(values, pa.int64()))
            yield batch

    return rows.mapInArrow(run, schema)


def rates(df: DataFrame) -> DataFrame:
    """Add the double columns of ``RATES`` to a table of counts."""
    made = {
        name: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))
        for name, (a, b) in RATES.items()
    }
    return df.withColumns(made)


@dataclass(frozen=True)
class Condition:
    rate: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.rate)
        return value >= self.threshold if self.above else value <= self.threshold

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        x = values[self.rate]
        return x >= self.threshold if self.above else x <= self.threshold

    def __str__(self) -> str:
        return f"{self.rate} {'>=' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


@dataclass(frozen=True)
class DecisionList:
    """Ordered rules; a row is rejected by the first rule that holds, else kept."""

    rules: tuple[Rule, ...]

    def rule_number(self) -> Column:
        """Position from 1 of the rule that rejects the row, null if none does."""
        chosen = F.lit(None).cast("int")
        for number, rule in reversed(list(enumerate(self.rules, 1))):
            condition = rule[0].column()
            for more in rule[1:]:
                condition = condition & more.column()
            chosen = F.when(condition, F.lit(number)).otherwise(chosen)
        return chosen

    def __str__(self) -> str:
        lines = [f"if {' and '.join(map(str, rule))}: reject" for rule in self.rules]
        return "\n".join([*lines, "keep"])


def learn(
    values: dict[str, np.ndarray],
    bad: np.ndarray,
    max_rules: int = 16,
    max_conditions: int = 4,
    min_precision: float = 0.8,
    thresholds: int = 64,
) -> DecisionList:
    """Sequential covering of the rows where ``bad`` is true.

    Every third row is held back for pruning. A rule is grown by the condition of
    best FOIL gain until it covers no good row or is full, then conditions are
    dropped from its end while that does not lower (p - n) / (p + n) on the rows held
    back. Learning stops when a rule's share of bad rows, on all rows left, falls below
    ``min_precision``. Without bad or without good rows there is no rule. Ties go to the
    first rate in name order and the lowest threshold.
    """
    left = np.ones(len(bad), bool)
    held = np.arange(len(bad)) % 3 == 2
    rules: list[Rule] = []
    while len(rules) < max_rules and (bad & left & ~held).any() and (~bad & left).any():
        rule = _pruned(_grown(values, bad, left & ~held, max_conditions, thresholds), values, bad, left & held)
        if not rule:
            break
        covered = _covers(rule, values, left)
        n_bad = int((covered & bad).sum())
        if n_bad < 2 or n_bad < min_precision * covered.sum():
            break
        rules.append(rule)
        left &= ~covered
    return DecisionList(tuple(rules))


def _covers(rule: Rule, values: dict[str, np.ndarray], among: np.ndarray) -> np.ndarray:
    for condition in rule:
        among = among & condition.holds(values)
    return among


def _grown(values, bad, rows, max_conditions: int, thresholds: int) -> Rule:
    rule: Rule = ()
    while len(rule) < max_conditions:
        p, n = int((rows & bad).sum()), int((rows & ~bad).sum())
        if not n or not p:
            break
        best, best_gain = None, 1e-9
        for rate in sorted(values):
            x = values[rate]
            cuts = np.unique(np.quantile(x[rows & bad], np.linspace(0, 1, thresholds)))
            for above in (True, False):
                good_x, bad_x = np.sort(x[rows & ~bad]), np.sort(x[rows & bad])
                if above:
                    p1 = len(bad_x) - np.searchsorted(bad_x, cuts, "left")
                    n1 = len(good_x) - np.searchsorted(good_x, cuts, "left")
                else:
                    p1 = np.searchsorted(bad_x, cuts, "right")
                    n1 = np.searchsorted(good_x, cuts, "right")
                share = np.maximum(p1, 1e-9) / np.maximum(p1 + n1, 1e-9)
                gain = p1 * (np.log2(share) - np.log2(p / (p + n)))
                k = int(np.argmax(gain))
                if gain[k] > best_gain:
                    best, best_gain = Condition(rate, above, float(cuts[k])), gain[k]
        if best is None:
            break
        rule += (best,)
        rows = rows & best.holds(values)
    return rule


def _pruned(rule: Rule, values, bad, rows) -> Rule:
    def worth(r: Rule) -> float:
        covered = _covers(r, values, rows)
        p, n = int((covered & bad).sum()), int((covered & ~bad).sum())
        return (p - n) / (p + n) if p + n else -1.0

    best = rule
    for size in range(len(rule) - 1, 0, -1):
        if worth(rule[:size]) >= worth(best):
            best = rule[:size]
    return best


def fit(
    documents: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    label: str = "quality",
    max_labelled: int = 20_000,
    **settings,
) -> DecisionList:
    """Learn from at most ``max_labelled`` labelled rows, those of smallest hash.

    A row is bad where the label is 0. A document with several labels counts as bad if
    one of them is 0; null keys and null labels are left out. The sample is bounded,
    so its keys are broadcast and its rates are collected.
    """
    marked = (
        labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(key))
        .agg((F.min(label) == 0).alias("_bad"))
        .orderBy(F.xxhash64(F.col(key)), F.col(key))
        .limit(max_labelled)
    )
    texts = documents.select(key, "text").join(F.broadcast(marked), key)
    counted = rates(text_counts(texts)).orderBy(F.xxhash64(F.col(key)), *COUNTS)
    # Repeated document rows could exceed the bound, hence the second limit.
    rows = counted.select("_bad", *RATES).limit(max_labelled).collect()
    values = {name: np.array([r[name] for r in rows], float) for name in RATES}
    return learn(values, np.array([r["_bad"] for r in rows], bool), **settings)


def judge(df: DataFrame, rules: DecisionList, text: str = "text") -> DataFrame:
    """Add ``COUNTS``, ``RATES`` and int column ``rule`` (null: no rule rejects the row)."""
    return rates(text_counts(df, text)).withColumn("rule", rules.rule_number())
