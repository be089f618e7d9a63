"""Operators that compare texts with each other, against plain versions."""

import hashlib
import itertools
import math
import random
import re
import string
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from millrace.llm import components, decontaminate, hmm, lm, neardup, queries, recompress, substrings, words

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def split(text):
    return re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode())


def documents(spark, root):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{root}/documents.parquet").collect()}


def frame(spark, rows):
    return spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id bigint, text string, class string, root int")


# --- near-duplicates


def plain_components(texts, size):
    sets = {}
    for k, text in texts.items():
        found = split((text or "").translate(LOWER))
        sets[k] = set(zip(*(found[j:] for j in range(size)))) if len(found) >= size else {tuple(found)} - {()}
    root = {k: k for k in texts}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(sorted(texts), 2):
        shared = len(sets[a] & sets[b])
        if shared and 100 * shared >= 80 * len(sets[a] | sets[b]):
            root[max(top(a), top(b))] = min(top(a), top(b))
    return {k: (len(sets[k]), top(k)) for k in texts}


def near_texts(seed=1):
    """Groups of near copies, some linked in a chain only, and odd texts."""
    rng = random.Random(seed)
    texts = [None, "", " \n", "one", "ONE", "one two", "One Two", "One Two"]
    for group in range(6):
        base = [f"w{rng.randrange(5000)}" for _ in range(60)]
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.randrange(0, 6)):
                copy[rng.randrange(60)] = f"e{rng.randrange(5000)}"
            texts.append(" ".join(copy))
            if group % 2:
                base = copy
    return dict(enumerate(texts))


@pytest.mark.parametrize("block,side", [(250_000, 512), (300, 3)])
def test_near_duplicates(spark, monkeypatch, block, side):
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", block)
    monkeypatch.setattr(neardup, "SIDE", side)
    texts = near_texts()
    for size in (2, 5):
        rows = neardup.near_duplicates(frame(spark, texts.items()), words=size).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == plain_components(texts, size)
        assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_near_duplicates_of_odd_tables(spark):
    assert neardup.near_duplicates(frame(spark, [])).count() == 0
    text = " ".join(f"w{k}" for k in range(20))
    rows = [(None, text), (None, None), (7, text), (7, text), (9, text), (9, "other words than these"), (11, "other words than these")]
    got = sorted(neardup.near_duplicates(frame(spark, rows), words=2).collect(), key=str)
    assert len(got) == len(rows)
    assert {r.component_id for r in got if r.doc_id} == {7}
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)


def test_near_duplicates_query(spark, small):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op10_odd_sketch_neardup(spark, small).collect()}
    assert got == plain_components(documents(spark, small), 2)


def test_components_of_chains_stars_and_loops(spark):
    links = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(200, 200), (300, 301), (301, 300)]
    frame_ = spark.createDataFrame([*links, (None, 3)], "a bigint, b bigint")
    got = {r.node: r.root for r in components.components(frame_).collect()}
    assert got == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(100, 160), 100), 300: 300, 301: 300}
    assert components.components(frame_.limit(0)).count() == 0


# --- benchmark containment


def plain_words(text):
    return (text or "").translate(LOWER | {ord(c): " " for c in string.punctuation}).encode().split()


def plain_contained(texts, items, share=0.8):
    out = {}
    for number, text in items.items():
        found = plain_words(text)
        size = min(5, len(found))
        parts = set(zip(*(found[j:] for j in range(size)))) if size else set()
        for k, doc in texts.items():
            own = plain_words(doc)
            n = len(parts & set(zip(*(own[j:] for j in range(size))))) if size else 0
            if parts and n >= share * len(parts) - 1e-9:
                out[k, number] = n
    return out


def test_containment(spark, small, monkeypatch):
    texts = documents(spark, small)
    items = {r.item_id: r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id): r.n_shared for r in queries.op9_containment(spark, small).collect()}
    assert got == plain_contained(texts, items) and got
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 500)
    docs, table = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "benchmark"))
    again = decontaminate.contained_items(docs, table.limit(12))
    assert {(r.doc_id, r.item_id) for r in again.collect()} <= set(got)


def test_containment_of_odd_items(spark):
    rng = random.Random(2)
    long = " ".join(f"w{rng.randrange(400)}" for _ in range(4000))
    part = " ".join(long.split()[1000:1030])
    cut = " ".join(part.split()[:26] + ["q"] * 6)
    rows = [(1, f"{long} tail"), (2, None), (3, ""), (4, "Only, a few!"), (4, "Only, a few!"), (None, cut)]
    items = [(1, part), (2, None), (3, "..."), (4, "a few"), (5, "few a"), (None, "only a"), (6, part.upper())]
    docs = frame(spark, rows)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = Counter((r.doc_id, r.item_id) for r in decontaminate.contained_items(docs, benchmark).collect())
    assert got[1, 1] == got[1, 6] == 1 and got[4, 4] == got[4, None] == 2
    assert set(got) - {(None, 1), (None, 6)} == {(1, 1), (1, 6), (4, 4), (4, None)}
    assert ((None, 1) in got) == bool(plain_contained({0: cut}, {1: part}))
    marked = decontaminate.mark_contained(docs, benchmark.limit(0))
    assert marked.columns == [*docs.columns, "contained"] and marked.filter("size(contained) > 0").count() == 0


# --- repeated word sequences


def plain_cut(texts, window):
    starts = Counter()
    for text in texts.values():
        found = split(text)
        starts.update(tuple(found[k : k + window]) for k in range(len(found) - window + 1))
    out = {}
    for key, text in texts.items():
        found = split(text)
        gone = set()
        for k in range(len(found) - window + 1):
            if starts[tuple(found[k : k + window])] > 1:
                gone.update(range(k, k + window))
        left = b" ".join(w for k, w in enumerate(found) if k not in gone).decode()
        out[key] = (len(found), len(gone), left)
    return out


def repeating_texts(seed):
    rng = random.Random(seed)
    passage = [f"p{k}" for k in range(30)]
    texts = [None, "", "a", "ha " * 40, "ha " * 50, "x y " * 30, "x y " * 31 + "z"]
    for _ in range(30):
        found = [rng.choice("abcdefgh") * rng.randrange(1, 3) for _ in range(rng.randrange(5, 60))]
        if rng.random() < 0.6:
            begin, end = sorted(rng.sample(range(30), 2))
            at = rng.randrange(len(found))
            found[at:at] = passage[begin:end]
        texts.append(rng.choice([" ", "\n", "\t "]).join(found))
    return dict(enumerate(texts + texts[-3:]))


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_are_cut(spark, seed):
    texts = repeating_texts(seed)
    for window in (4, 10):
        rows = substrings.remove_repeats(frame(spark, texts.items()), window=window).collect()
        assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in rows} == plain_cut(texts, window)


def test_repeats_of_odd_tables(spark):
    assert substrings.remove_repeats(frame(spark, [])).count() == 0
    rows = [(1, "a b c d e"), (1, "a b c d e"), (None, "q a b c d"), (None, None)]
    got = sorted(tuple(r) for r in substrings.remove_repeats(frame(spark, rows), window=4).select("n_removed", "kept").collect())
    assert got == [(0, ""), (4, "q"), (5, ""), (5, "")]


def test_repeats_query(spark, small):
    expected = plain_cut(documents(spark, small), 35)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op7_recompression(spark, small).collect()}
    assert got == {k: (n, m, hashlib.sha256(t.encode()).hexdigest()) for k, (n, m, t) in expected.items()}


def test_symbols_agree_inside_equal_words():
    """Equal words decide equal symbols, wherever they stand."""
    rng = np.random.default_rng(4)
    shared = rng.integers(0, 9, 60).astype(np.uint64)
    texts = [np.concatenate([rng.integers(0, 9, n).astype(np.uint64), shared, rng.integers(0, 9, n).astype(np.uint64)]) for n in (0, 5, 33)]
    sizes = np.array([len(t) for t in texts])
    symbols = recompress.recompressed(words.mixed(np.concatenate(texts)), sizes, ("runs", *["pairs"] * 4))
    found = []
    for k, n in enumerate((0, 5, 33)):
        begin = int(sizes[:k].sum()) + n
        own = (symbols.low >= begin) & (symbols.high <= begin + 60)
        found.append({(int(s) - begin, int(m)) for s, m in zip(symbols.starts[own], symbols.names[own])})
    assert found[0] and found[0] == found[1] == found[2]


# --- language model


def test_forward_and_expected_counts():
    rng = np.random.default_rng(1)
    model = hmm.Hmm(np.array([0.3, 0.7]), np.array([[0.9, 0.1], [0.2, 0.8]]), hmm.Hmm.start(np.array([0.2, 0.3, 0.5]), 2).emit)
    sequences = [rng.integers(0, 3, n) for n in (4, 1, 6, 3)]
    sums = [np.zeros(2), np.zeros((2, 2)), np.zeros((3, 2))]
    logs = []
    for s in sequences:
        paths = []
        for p in itertools.product(range(2), repeat=len(s)):
            chance = model.first[p[0]] * model.emit[s[0], p[0]]
            for t in range(1, len(s)):
                chance *= model.step[p[t - 1], p[t]] * model.emit[s[t], p[t]]
            paths.append((p, chance))
        total = sum(c for _, c in paths)
        logs.append(math.log(total))
        for p, chance in paths:
            sums[0][p[0]] += chance / total
            for t in range(len(s)):
                sums[2][s[t], p[t]] += chance / total
                if t:
                    sums[1][p[t - 1], p[t]] += chance / total
    assert np.allclose(hmm.log_likelihoods(model, sequences), logs)
    for segment in (1, 2, 3, 512):  # cuts that change nothing
        found = hmm.expected_counts(model, sequences, segment)
        assert all(np.allclose(a, b, atol=1e-5) for a, b in zip(found, sums))


def test_long_sequences_are_trained_as_wholes():
    """Segments of any length give the counts of whole sequences, transitions over their ends included."""
    rng = np.random.default_rng(0)
    shares = np.full(40, 1 / 40)
    model = hmm.Hmm.start(shares, 4).reestimated(rng.random(4) * 9, rng.random((4, 4)) * 9, rng.random((40, 4)) * 90, shares)
    sequences = [rng.integers(0, 40, n).astype(np.int16) for n in (1, 511, 512, 513, 1024, 1025, 3000, 2)]
    whole = hmm.expected_counts(model, sequences, 10**9)
    for segment in (64, 512, 1024):
        cut = hmm.expected_counts(model, sequences, segment)
        assert all(np.allclose(a, b, rtol=1e-4, atol=1e-4) for a, b in zip(whole, cut))
    assert np.isclose(whole[0].sum(), len(sequences)) and np.isclose(whole[2].sum(), sum(map(len, sequences)))
    assert np.isclose(whole[1].sum(), sum(len(s) - 1 for s in sequences))


def plain_base(texts, held):
    tokens = {k: [*split((t or "").translate(LOWER)), None] for k, t in texts}
    counts = Counter(w for k in tokens if not held(k) for w in tokens[k])
    n, v = sum(counts.values()), len(counts)
    return {
        k: (len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws))
        for k, ws in tokens.items()
    }


def test_scores_query(spark, medium):
    texts = documents(spark, medium)

    def held(k):
        return zlib.crc32(str(k).encode()) % 7 == 2

    expected = plain_base(texts.items(), held)
    rows = queries.op4_hidden_markov_lm(spark, medium).collect()
    assert len(rows) == len(texts)
    better = 0
    for r in rows:
        n_tokens, n_known, total, base = expected[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), n_tokens, n_known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        better += r.held_out and r.score > r.base_score
    assert better >= 0.9 * sum(r.held_out for r in rows)


def test_scores_of_odd_tables(spark, monkeypatch):
    assert lm.score_texts(frame(spark, [])).count() == 0
    monkeypatch.setattr(lm, "FREQUENT", 0.2)  # most words are rare
    rows = [(1, None), (3, ""), (4, "A b a"), (4, "A b a"), (5, "b c"), (None, "a"), (15, "a z")]
    got = {}
    for r in lm.score_texts(frame(spark, rows), rounds=1).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert len(got[4]) == 2 and got[4][0] == got[4][1]
    tokens = [[*split((t or "").lower()), None] for k, t in rows]
    counts = Counter(w for ws, (k, _) in zip(tokens, rows) if k is None or zlib.crc32(str(k).encode()) % 7 != 2 for w in ws)
    n, v = sum(counts.values()), len(counts)
    for ws, (k, _) in zip(tokens, rows):
        r = got[k][0]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(counts[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws))
        assert math.isfinite(r.score) and r.score < 0


def test_scores_are_chances(spark, monkeypatch):
    """Chances of all texts of one known or unknown word and no word add up to less than 1."""
    rows = [(1, "a b"), (3, "b"), (4, "a")] + [(10 + k, t) for k, t in enumerate(["", "a", "b", "zz"])]
    from pyspark.sql import functions as F

    out = lm.score_texts(frame(spark, rows), test=F.col("doc_id") >= 10, rounds=2).filter("held_out").collect()
    assert sum(10**r.score for r in out) < 1


# --- pipeline


def test_pipeline(spark, small):
    root = small
    texts = documents(spark, root)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{root}/labels.parquet").collect()}
    docs = spark.read.parquet(f"{root}/documents.parquet")
    (_, quality_stage), (_, dedup), (_, leaks), (_, private), (_, tokens) = corpus_pipeline.STAGES
    good = quality_stage(spark, docs, root)
    kept = {r.doc_id: r.text for r in good.collect()}
    assert good.columns == corpus_pipeline.COLUMNS
    assert sum((k in kept) == (q == 1) for k, q in labels.items()) >= 0.95 * len(labels)
    one = dedup(spark, docs, root)
    assert {r.doc_id for r in one.collect()} == {k for k, (_, top) in plain_components(texts, 5).items() if k == top}
    clean = leaks(spark, docs, root)
    items = {r.item_id: r.text for r in spark.read.parquet(f"{root}/benchmark.parquet").collect()}
    assert {r.doc_id for r in clean.collect()} == set(texts) - {k for k, _ in plain_contained(texts, items)}
    redacted = private(spark, docs, root).collect()
    assert all(r.n_chars == len(r.text) for r in redacted)
    assert all(r.text == texts[r.doc_id] for r in redacted if not re.search("[0-9@]", texts[r.doc_id]))
    assert all(c.columns == corpus_pipeline.COLUMNS for c in (one, clean))
    rows = corpus_pipeline.run(spark, root).collect()
    assert rows and all(r.decodes and r.n_tokens == len(r.ids) for r in rows)
    assert len({r.doc_id for r in rows}) == len(rows)


def test_pipeline_stages_of_odd_tables(spark, small):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "a b c d e f g", None, "s", 13), (2, "a b c d e f g", None, "s", 13), (None, "mail a.b@c.de", "en", "s", 13)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for table in (docs, docs.limit(0)):
        for _, function in corpus_pipeline.STAGES:
            out = function(spark, table, small)
            assert out.count() <= table.count()
    assert corpus_pipeline.STAGES[1][1](spark, docs, small).count() == 4
