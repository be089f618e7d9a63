"""Clashing column names, unreadable input, long texts, and estimates against plain versions."""

import itertools
import json

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import chat, decontaminate, licenses, pii, quality, rules
from millrace.llm.words import Taken

TEXT = "call +1 555 010 9999 now. Licensed under the Apache License, Version 2.0"


@pytest.fixture(scope="module")
def clashing(spark):
    rows = [(1, TEXT, "mine", "own"), (2, None, None, "own"), (3, "", "x", None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, _source_bytes string, _ordered string")


def test_columns_of_the_caller_stay(spark, clashing):
    items = spark.createDataFrame([(7, "call +1 555 010 9999 now")], "item_id bigint, text string")
    results = [
        pii.redact(pii.find_spans(clashing, None)),
        quality.classify(clashing, quality.fit(clashing)),
        licenses.find_licenses(clashing),
        decontaminate.mark_contained(clashing, items),
        rules.text_counts(clashing),
    ]
    for result in results:
        assert [r[0] for r in result.orderBy("doc_id").select("_source_bytes").collect()] == ["mine", None, "x"]
        assert [r[0] for r in result.orderBy("doc_id").select("_ordered").collect()] == ["own", "own", None]
    assert results[0].filter("doc_id = 1").first()["text"].startswith("call [phone] now")
    assert [i["item"] for i in results[3].filter("doc_id = 1").first()["contained"]] == [7]


def test_unreadable_records_are_rows_without_layout(spark):
    deep = '{"a":' * 5000 + "1" + "}" * 5000
    middling = '{"a":' * 150 + "1" + "}" * 150
    half = '{"prompt": "\\ud800", "response": "b"}'
    pair = '{"prompt": "\\ud83d\\ude00", "response": "b"}'
    rows = [(k, 0, r) for k, r in enumerate([deep, middling, half, pair, "[" * 9000, None, "", "nope", "[1]"])]
    records = spark.createDataFrame(rows, "conv_id bigint, turn bigint, record string")
    found = chat.canonical_turns(records).orderBy("key", "position").collect()
    assert [(r["key"], r["text"]) for r in found if r["layout"]] == [(3, "\U0001f600"), (3, "b")]
    assert sorted(r["key"] for r in found if not r["layout"]) == [0, 1, 2, 4, 5, 6, 7, 8]
    assert json.loads(pair)["prompt"] == "\U0001f600"


def test_bytes_that_are_no_text(spark):
    broken = spark.sql("SELECT 1L AS doc_id, cast(X'FF40C3' AS string) AS text")
    for result in (pii.find_spans(broken, None), quality.classify(broken, quality.fit(broken)), rules.text_counts(broken)):
        assert result.count() == 1


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(1, 8)), max_size=30), st.integers(0, 5))
def test_taken_stretches_are_those_of_comparing_all(spans, start):
    spans = [(b, b + n) for b, n in spans]
    taken, plain = Taken(spans[:start]), list(spans[:start])
    for begin, end in spans[start:]:
        free = all(end <= b or begin >= e for b, e in plain)
        assert taken.take(begin, end) == free
        plain += [(begin, end)] if free else []


@settings(max_examples=150, deadline=None)
@given(st.permutations(range(8)))
def test_rising_places_are_a_longest_subsequence(order):
    found = licenses._longest_rising(list(enumerate(order)))
    assert all(a[0] < b[0] and a[1] < b[1] for a, b in itertools.pairwise(found))
    longest = max(
        n for n in range(1, 9) for part in itertools.combinations(order, n) if list(part) == sorted(part)
    )
    assert len(found) == longest


def test_dates_are_no_phones_and_spans_reach_the_end_of_their_word():
    for date in ("2024-01-15", "12-34-5678", "15.01.2024", "2024 01 15 10.30", "1/2/2024"):
        assert not pii.valid(3, date)
    assert pii.valid(3, "555-010-9999") and pii.valid(3, "+44 2024 01 15")
    text = "write to maria.lopez (at) mail.example.co.uk."
    begin, end = text.index("lopez"), text.index("le.co")
    assert text[slice(*pii._whole(text, 0, begin, end))] == "maria.lopez (at) mail.example.co.uk"
    assert pii._whole("no 4111.1111.1111.1111", 2, 4, 20) == (3, 22)
    assert pii._whole("(555) 12", 3, 0, 5) == (0, 5)


def _simulated(rows, accuracy, share=0.7, speaks=0.9, seed=5):
    """Votes of labellers that are right as often as stated on (bad, good) rows."""
    rng = np.random.default_rng(seed)
    good = rng.random(rows) < share
    right = rng.random((rows, len(accuracy[0]))) < np.where(good[:, None], accuracy[1], accuracy[0])
    votes = np.where(right == good[:, None], quality.GOOD, quality.BAD)
    return np.where(rng.random(votes.shape) < speaks, votes, quality.NONE), good


def _patterns(votes):
    return np.unique(votes @ 3 ** np.arange(votes.shape[1]), return_counts=True, return_inverse=True)


def test_estimates_find_known_accuracies():
    bad, good = np.linspace(0.45, 0.9, 9), np.linspace(0.97, 0.75, 9)
    votes, truth = _simulated(200_000, (bad, good))
    patterns, of, counts = _patterns(votes)
    chance, right, share = quality.estimated(patterns, counts.astype(float))
    assert np.abs(right[0] - bad).max() < 0.03 and np.abs(right[1] - good).max() < 0.03
    assert abs(share - truth.mean()) < 0.03
    right_share = ((chance[of] >= 0.5) == truth).mean()
    # As good as with the accuracies known, and far better than any bad vote.
    known = [np.log(p) for p in (bad, 1 - bad, good, 1 - good)]
    said_bad, said_good = (votes == quality.BAD).astype(float), (votes == quality.GOOD).astype(float)
    odds = np.log(0.7 / 0.3) + said_good @ (known[2] - known[1]) + said_bad @ (known[3] - known[0])
    any_bad = (votes == quality.BAD).any(axis=1)
    assert right_share > ((odds >= 0) == truth).mean() - 0.005
    assert right_share > (~any_bad == truth).mean() + 0.2


def test_estimates_from_counts_are_those_from_rows():
    votes, _ = _simulated(3_000, (np.full(9, 0.6), np.full(9, 0.9)))
    patterns, of, counts = _patterns(votes)
    by_count = quality.estimated(patterns, counts.astype(float))
    by_row = quality.estimated(patterns[of], np.ones(len(of)))
    np.testing.assert_allclose(by_count[0][of], by_row[0], atol=1e-9)
    np.testing.assert_allclose(by_count[1], by_row[1], atol=1e-9)


def test_verdicts_differ_from_any_bad_vote_and_are_better_there(spark, medium):
    """At scale 0.1, documents that only the labeller of lines calls bad are good by their labels."""
    root = medium.replace("sf0.01", "sf0.1")
    docs = spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{root}/labels.parquet").select("doc_id", (F.col("quality") == 1).alias("truth"))
    voted = rules.rates(rules.text_counts(docs)).select("doc_id", quality.pattern().alias("pattern"))
    rows = voted.join(labels, "doc_id").collect()
    patterns, of, counts = np.unique([r["pattern"] for r in rows], return_counts=True, return_inverse=True)
    chance = quality.posteriors(patterns, counts.astype(float))[of]
    votes = (patterns[of][:, None] // 3 ** np.arange(9)) % 3
    truth = np.array([r["truth"] for r in rows])
    any_bad = (votes == quality.BAD).any(axis=1)
    differ = (chance >= 0.5) == any_bad
    assert differ.any() and ((chance >= 0.5) == truth)[differ].mean() > 0.9
    assert not (truth & (chance < 0.5)).any()
