"""Operators that work on each text alone, against plain versions."""

import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import bilstm, bpe, chat, licenses, pii, queries, quality, rules, words

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
TEXTS = [None, "", " ", "a", "A b\tc\nA b\tc", "Ünï çödé 12.3 x@y.zz", "ab" * 3000, "x y z " * 400, "a b c"]
SCHEMA = "doc_id bigint, text string, ids string, good string, spans int, n_words int"


def frame(spark, texts):
    rows = [(k, t, "own", "own", 1, 2) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def coder():
    return bpe.Bpe(bpe.read_ranks(VOCABULARY), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference_coder(coder):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={}
    )


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abé \n't1.x Ü", max_size=20), max_size=5))
def test_bpe_is_that_of_the_library(coder, reference_coder, texts):
    for text, ids in zip(texts, coder.encode(texts), strict=True):
        ids = np.frombuffer(ids, np.int32).tolist()
        assert ids == reference_coder.encode_ordinary(text)
        assert bytes(coder.decode(np.array(ids, int), np.array([len(ids)]))[0]) == text.encode()


def test_bpe_of_long_pre_tokens_and_a_lower_rank_coming_up(coder, reference_coder):
    for text in ("ab" * 40_000, "a" * 50_001, "thethethe" * 5_000):
        assert np.frombuffer(coder.encode([text])[0], np.int32).tolist() == reference_coder.encode_ordinary(text)
    # Ranks of which a merge makes a pair of lower rank than its own.
    odd = bpe.Bpe([b"a", b"b", b"c", b"abc", b"bc", b"abca"], ".+")
    assert odd.merged([b"abcabc"]) == [[3, 3]] or odd.merged([b"abcabc"]) == [[5, 4]]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab", min_size=1, max_size=30), min_size=1, max_size=12), st.permutations(range(3, 12)))
def test_bpe_by_buckets_is_bpe_one_by_one(pieces, order):
    """Vocabularies whose merges often bring up lower ranks, with every bucket merged at once or none."""
    joined = [b"ab", b"ba", b"aa", b"bab", b"aba", b"aab", b"abab", b"aaaa", b"bb"]
    own = bpe.Bpe([b"a", b"b", b"c", *(joined[k - 3] for k in order)], ".+")

    def one_by_one(piece):
        parts = [bytes([c]) for c in piece]
        while True:
            found = [(own.ranks.get(a + b), k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
            found = [f for f in found if f[0] is not None]
            if not found:
                return [own.ranks[p] for p in parts]
            k = min(found)[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    coded = [p.encode() for p in pieces]
    for many in (1, 4, 10**9):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(bpe, "MANY", many)
            assert own.merged(coded) == [one_by_one(p) for p in coded]


def test_bpe_of_a_byte_that_is_not_in_the_vocabulary():
    with pytest.raises(ValueError, match="lacks a byte"):
        bpe.Bpe([b"a"], ".+").encode(["ab"])


def test_bpe_round_trip_of_a_table(spark, reference_coder):
    coded = bpe.round_trip(frame(spark, TEXTS + TEXTS), VOCABULARY, public_tokenizers.PATTERN)
    assert coded.columns == ["doc_id", "text", "good", "spans", "n_words", "ids", "decoded"]
    for row in coded.collect():
        assert list(row.ids) == reference_coder.encode_ordinary(row.text or "")
        assert bytes(row.decoded).decode() == (row.text or "")
    once = bpe.encode(frame(spark, ["hello there", None]).select("text"), VOCABULARY, public_tokenizers.PATTERN)
    assert [bytes(r.decoded) for r in bpe.decode(once, VOCABULARY).collect()] == [b"hello there", b""]
    ids = spark.createDataFrame([(None,), ([],), ([0, 1],)], "ids array<int>")
    assert [len(r.decoded) for r in bpe.decode(ids, VOCABULARY).collect()] == [0, 0, 2]
    assert bpe.encode(frame(spark, []), VOCABULARY, public_tokenizers.PATTERN).count() == 0


def test_bpe_query(spark, small, reference_coder):
    got = {r.doc_id: r for r in queries.op6_byte_bpe(spark, small).collect()}
    for row in spark.read.parquet(f"{small}/documents.parquet").collect():
        ids = reference_coder.encode_ordinary(row.text)
        assert got[row.doc_id].n_tokens == len(ids)
        assert got[row.doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[row.doc_id].decoded_sha256 == hashlib.sha256(row.text.encode()).hexdigest()


def plain_counts(text):
    found = re.findall(rb"[^\x20\x09-\x0d]+", text.encode())
    lines = [line for line in text.encode().split(b"\n") if re.search(rb"[^\x20\x09-\x0d]", line)]
    windows = Counter(zip(found, found[1:], found[2:]))
    covered = {k + j for k in range(len(found) - 2) for j in range(3) if windows[tuple(found[k : k + 3])] > 1}
    return (
        len(found),
        sum(len(w.decode()) for w in found),
        sum(c in "#*$%&|<>" for c in text),
        sum(line in lines[:k] for k, line in enumerate(lines)),
        len(covered),
    )


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab é\n\t#|\x0b\x1f ", max_size=60))
def test_text_counts(text):
    assert rules.counts_of(text.encode())[:5] == plain_counts(text)


def test_rules_query(spark, small):
    rows = queries.op5_decision_list(spark, small).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        counts = plain_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert not (r.base_failed and r.kept)


def test_rules_learn_conjunctions_and_emit_expressions(spark):
    rng = np.random.default_rng(0)
    values = {name: rng.random(600) for name in rules.RATES}
    bad = (values["symbols_per_char"] > 0.7) | (
        (values["dup_line_share"] > 0.5) & (values["capital_share"] < 0.3)
    )
    learned = rules.learn(values, bad)
    rows = [tuple(float(values[n][k]) for n in rules.RATES) for k in range(600)]
    frame = spark.createDataFrame(rows, list(rules.RATES)).withColumn("rule", learned.rule_number())
    said = np.array([r.rule is not None for r in frame.collect()])
    assert (said == bad).mean() > 0.95 and str(learned).endswith("keep")
    assert rules.learn(values, np.zeros(600, bool)).rules == ()
    assert rules.learn(values, np.ones(600, bool)).rules == ()


def test_rules_of_odd_tables(spark):
    docs = frame(spark, TEXTS)
    none = rules.fit(docs.limit(0), spark.createDataFrame([], "doc_id bigint, quality int"))
    assert none.rules == ()
    labels = spark.createDataFrame([(0, 1), (0, 0), (None, 1), (3, None), (4, 1)], "doc_id bigint, quality int")
    judged = rules.judge(docs, rules.fit(docs, labels))
    assert judged.count() == len(TEXTS) and judged.filter("text is not null" if "text" in judged.columns else "true").count()
    assert [r.n_words for r in judged.filter("doc_id < 3").collect()] == [0, 0, 0]
    assert rules.judge(docs.limit(0), none).count() == 0


def test_rules_held_out_accuracy(spark, medium):
    docs, labels = (spark.read.parquet(f"{medium}/{t}.parquet") for t in ("documents", "labels"))
    learned = rules.fit(docs, labels.filter("doc_id % 3 <> 0"))
    judged = rules.judge(docs, learned).join(labels.filter("doc_id % 3 = 0"), "doc_id")
    right = judged.filter("(rule is null) = (quality = 1)").count()
    assert right >= 0.9 * judged.count()


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<[/]s\\>INST|a\né", max_size=30))
def test_chat_escaping_is_reversible_and_leaves_no_control_string(text):
    out = chat.escaped(text)
    assert chat.unescaped(out) == text
    assert not any(c in out for c in ("</s>", "<s>", "[INST]", "[/INST]", chat.TURN, chat.TEXT, chat.END))


LAYOUTS = [
    '{"role": "user", "text": "hi"}',
    '{"messages": [{"role": "system", "content": "s"}, {"role": "user", "content": null, "id": 3}]}',
    '{"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}]}]}',
    '{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "r"}], "extra": {"x": [1]}}',
    '{"instruction": "do", "input": "this", "output": "done"}',
    '{"prompt": "p", "response": ""}',
    '{"question": "q", "answer": 4, "system": ""}',
    '{"unknown": 1}',
    "[1]",
    "no json",
    None,
]


def test_chat_layouts(spark):
    rows = spark.createDataFrame(list(enumerate([0] * len(LAYOUTS))), "conv_id bigint, turn bigint")
    records = spark.createDataFrame([(k, 0, x) for k, x in enumerate(LAYOUTS)], "conv_id bigint, turn bigint, record string")
    assert rows.count() == records.count()
    got = {}
    for r in chat.canonical_turns(records).orderBy("key", "position").collect():
        got.setdefault(r.key, []).append((r.layout, r.role, r.text))
    assert got[0] == [("row", "user", "hi")]
    assert got[1] == [("messages", "system", "s"), ("messages", "user", "")]
    assert got[2] == [("messages", "user", "ab")]
    assert got[3] == [("from_value", "user", "q"), ("from_value", "assistant", "r")]
    assert got[4] == [("instruction", "user", "do\n\nthis"), ("instruction", "assistant", "done")]
    assert got[5] == [("prompt_response", "user", "p"), ("prompt_response", "assistant", "")]
    assert got[6] == [("question_answer", "user", "q"), ("question_answer", "assistant", "4")]
    assert all(got[k] == [(None, None, None)] for k in range(7, 11))
    assert chat.format_chats(chat.canonical_turns(records.limit(0))).count() == 0


def digest_of(turns):
    said = "".join(t for r, t in turns if r == "assistant")
    return (
        len(turns),
        hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
        len(said),
        hashlib.sha256(said.encode()).hexdigest(),
    )


def test_chat_long_and_odd_conversations(spark, monkeypatch):
    monkeypatch.setattr(chat, "SEGMENT_CHARS", 500)
    monkeypatch.setattr(chat, "BLOCK_TURNS", 7)
    long = [(1, k, "assistant" if k % 2 else "user", f"</s>[INST] {k} \\<" * (k % 5)) for k in range(100)]
    rows = long + [(None, 0, "user", "x"), (None, None, None, None), (2, 1, "assistant", ""), (2, 1, "assistant", "")]
    turns = spark.createDataFrame(
        [(k, o, 0, r, t, "row", "") for k, o, r, t in rows],
        "key bigint, order bigint, position int, role string, text string, layout string, fingerprint string",
    )
    segments = chat.format_chats(turns)
    assert segments.filter("key = 1").count() >= 15
    got = {r.key: tuple(r)[1:5] for r in chat.digest_chats(segments).collect()}
    assert got[1] == digest_of([(r, t) for _, _, r, t in long])
    assert got[None] == digest_of([("", ""), ("user", "x")])
    assert got[2] == digest_of([("assistant", "")] * 2)


def test_chat_query(spark, small):
    expected = {-7: [("user", queries.CONTROL_TEXT), ("assistant", queries.CONTROL_TEXT)]}
    for r in spark.read.parquet(f"{small}/conversations.parquet").orderBy("conv_id", "turn").collect():
        expected.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    got = {r.conv_id: tuple(r)[1:5] for r in queries.op2_chat_formatting(spark, small).collect()}
    assert got == {k: digest_of(v) for k, v in expected.items()}


def plain_spans(text):
    """Base spans as the contract words them, by backtracking patterns."""
    email = re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)
    out = [(0, *m.span()) for m in email]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        out += [(1, *m.span())] if all(int(p) <= 255 for p in m[0].split(".")) else []
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c in "0123456789"][::-1]
        total = sum(d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(digits))
        out += [(2, *m.span())] if 16 <= len(digits) <= 19 and total % 10 == 0 else []
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        out += [(3, *m.span())] if 8 <= sum(c in "0123456789" for c in m[0]) <= 15 else []
    return out


PIECES = ["a.b@c.de", "@", ".", "1.2.3.4", "255.256.1.1", "4111 1111-1111 1111", "+1 (555) 010-9999", "0", " ", "-", "é", "+", "٣", "00001.2.3.4"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=12).map("".join))
def test_pii_base_spans(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_pii_base_spans_of_long_runs():
    for text in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "+1 " * 60_000, "a@" * 100_000):
        pii.base_spans(text)


def test_bilstm_gradient():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in bilstm.new_parameters(5).items()}
    codes, tags = rng.integers(0, bilstm.CODES, (3, 6)), rng.integers(0, 5, (3, 6))
    _, grad = bilstm.loss_and_gradient(p, codes, tags)
    for name in p:
        at = (codes[0, 0], 1) if name == "embedding" else tuple(rng.integers(0, d) for d in p[name].shape)
        old, sides = p[name][at], []
        for step in (1e-3, -1e-3):
            p[name][at] = old + step
            sides.append(bilstm.loss_and_gradient(p, codes, tags)[0])
        p[name][at] = old
        assert grad[name][at] == pytest.approx((sides[0] - sides[1]) / 2e-3, abs=2e-4)


@pytest.fixture(scope="module")
def pii_model(spark, medium):
    return pii.train(spark.read.parquet(f"{medium}/documents.parquet"))


def test_pii_held_out_spans(spark, pii_model, medium):
    """Spans of texts not trained on, rewritten in a form that the patterns do not know."""
    found = total = 0
    others = spark.read.parquet(medium.replace("sf0.01", "sf0.1") + "/documents.parquet").filter("doc_id > 5000")
    for row in others.filter("text like '%+1 (%'").limit(60).collect():
        for kind, begin, end in pii.base_spans(row.text):
            if kind == 3:
                text = row.text[:begin] + row.text[begin:end].removeprefix("+1 ") + row.text[end:]
                total += 1
                spans = pii.added_spans(text, pii.base_spans(text), pii_model)
                found += any(k == 3 and b <= begin + 1 and e >= end - 4 for k, b, e in spans)
    assert total > 20 and found >= 0.8 * total


@pytest.mark.parametrize("domain", ["example.co.uk", "mail.example-company.co.uk", "mail.example-company-of-our-days.co.uk", "a" * 90 + ".org"])
def test_pii_spans_longer_than_the_overlap_of_windows(monkeypatch, domain):
    """At every offset; in place of the model, windows are tagged as what they show of the span."""
    outside = bilstm.codes_of("|")[0]

    def tagged(model, codes, allowed):
        inside = (codes != outside) & (codes != 0)
        return np.where(inside, np.where(np.roll(inside, 1, 1) & (np.arange(pii.WIDTH) > 0), 2, 1), 0)

    monkeypatch.setattr(bilstm, "best_paths", tagged)
    span = f"maria.lopez (at) {domain}"
    for offset in range(32):
        text = "|" * (64 + offset) + span + "|" * 100
        assert pii.added_spans(text, [], {}) == [(0, 64 + offset, 64 + offset + len(span))]


def test_pii_spans_and_redaction_of_a_table(spark, pii_model):
    texts = [*TEXTS, "mail a.b@c.de or 1.2.3.4, +1 (555) 010-9999.", "clean words only", "12345678"]
    found = pii.find_spans(frame(spark, texts), pii_model)
    for row in found.collect():
        base = [(pii.KINDS.index(s.kind), s.begin, s.end) for s in row.spans if s.base]
        assert base == plain_spans(row.text or "")
        assert all(pii.valid(pii.KINDS.index(s.kind), row.text[s.begin : s.end]) for s in row.spans if not s.base)
    out = {r.doc_id: r.text for r in pii.redact(found).collect()}
    assert out[len(TEXTS)] == "mail [email] or [ip], [phone]."
    assert out[len(TEXTS) + 1] == "clean words only" and out[0] is None and out[1] == ""
    assert pii.train(frame(spark, ["none", None])) is None
    assert pii.find_spans(frame(spark, []), None).count() == 0
    assert pii.find_spans(frame(spark, ["x 1.2.3.4"]), None).first().spans[0].kind == "ip"


def test_pii_query(spark, small):
    got = {r.doc_id: r for r in queries.op8_bilstm_pii(spark, small).collect()}
    for row in spark.read.parquet(f"{small}/documents.parquet").collect():
        base = plain_spans(row.text)
        own = got[row.doc_id]
        assert [own.n_email, own.n_ip, own.n_card, own.n_phone] == [sum(k == j for j, _, _ in base) for k in range(4)]
        joined = ",".join(f"{pii.KINDS[k]}:{b}:{e}" for k, b, e in base)
        assert own.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) <= set(own.spans.split(",")) | {""}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 8), max_size=14), st.lists(st.integers(0, 8), max_size=14))
def test_alignment_is_a_rising_match(left, right):
    pairs = licenses.aligned(left, right)
    assert all(left[a] == right[b] for a, b in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


def test_alignment_of_equal_and_edited_sequences():
    words_ = list(range(30))
    assert len(licenses.aligned(words_, words_)) == 30
    edited = words_[:10] + [99] + words_[11:20] + words_[21:]
    assert len(licenses.aligned(edited, words_)) == 28


def test_licenses_of_a_table(spark):
    mit, nc = licenses.TEMPLATES["MIT-text"], licenses.TEMPLATES["CC-BY-NC-4.0"]
    edited = mit.replace("obtaining a copy", "who obtains one copy")
    texts = [*TEXTS, f"So {mit} and on", f"x {edited}", f"{nc}.\n{nc}. {nc}", "license version public the under " * 300]
    out = {r.doc_id: r.licenses for r in licenses.find_licenses(frame(spark, texts)).collect()}
    at = len(TEXTS)
    assert [(m.license, m.begin, m.coverage) for m in out[at]] == [("MIT-text", 1, 1.0)]
    assert out[at + 1][0].license == "MIT-text" and 0.8 <= out[at + 1][0].coverage < 1
    assert [(m.license, m.begin) for m in out[at + 2]] == [("CC-BY-NC-4.0", 7 * k) for k in range(3)]
    assert all(not out[k] for k in [*range(at), at + 3])
    assert licenses.find_licenses(frame(spark, [])).count() == 0


def test_license_notices_of_other_licenses(spark):
    lines = {
        "Released under the BSD License.": [],
        "It was released under the new license": [],
        "This work is licensed under the GNU General Public License, version 2.": [],
        "This work is licensed under the GNU Lesser General Public License, version 3.": [],
        "Licensed under CC BY-ND 4.0.": ["CC-BY-ND-4.0"],
        "Licensed under CC BY-NC-SA 4.0.": ["CC-BY-NC-SA-4.0"],
        "Licensed under CC BY 3.0.": [],
        "x Released under the MIT License. y": ["MIT"],
    }
    found = licenses.find_licenses(frame(spark, list(lines))).orderBy("doc_id").collect()
    assert [[m.license for m in r.licenses] for r in found] == list(lines.values())


def test_whole_license_texts_are_told_apart(spark):
    """Each text is found as its own license, also with a line put in, and its first sentence is not."""
    long = {k: t for k, t in licenses.TEMPLATES.items() if len(t.split()) > licenses.SHORT}
    gap = " ".join(f"gap{k}" for k in range(250))
    apart = long["BSD-3-Clause"].replace(" 2. ", f" {gap} 2. ", 1)
    reworded = long["BSD-3-Clause"].replace("Neither the name", "The name").replace("nor the names", "and the names")
    opening = [t.split(". ")[0][:150] for k, t in long.items() if k not in ("MPL-2.0", "Apache-2.0-notice")]
    texts = [*(f"So\n{t}\nend" for t in long.values()), apart, reworded, *opening]
    found = licenses.find_licenses(frame(spark, texts)).orderBy("doc_id").collect()
    got = [[m.license for m in r.licenses] for r in found]
    assert got == [*([k] for k in long), ["BSD-3-Clause"], ["BSD-3-Clause"], *([] for _ in opening)]
    assert all(r.licenses[0].coverage == 1 for r in found[: len(long)])


def test_licenses_query(spark, medium):
    """Every license line planted in the documents is found, and nothing else."""
    lines = {
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "Released under the MIT License.": "MIT",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    }
    expected = Counter()
    for row in spark.read.parquet(f"{medium}/documents.parquet").collect():
        for line, name in lines.items():
            if n := row.text.count(line):
                expected[row.doc_id, name] += n
    got = Counter((r.doc_id, r.license) for r in queries.op3_patience_licenses(spark, medium).collect())
    assert expected and got == expected


def test_quality_against_labels(spark, medium):
    judged = queries.op1_weak_label_quality(spark, medium)
    both = judged.join(spark.read.parquet(f"{medium}/labels.parquet"), "doc_id").collect()
    assert sum(r.good == (r.quality == 1) for r in both) >= 0.95 * len(both)
    good = [r for r in both if r.quality == 1]
    assert sum(r.good for r in good) >= 0.99 * len(good)


def test_quality_of_odd_tables(spark):
    docs = frame(spark, TEXTS + TEXTS)
    weights = quality.fit(docs.select("text"))
    rows = quality.classify(docs, weights).collect()
    assert len(rows) == 2 * len(TEXTS)
    assert not any(r.good for r in rows if not (r.text or "").strip())
    scores = {}
    for r in rows:
        assert scores.setdefault(r.text, r.quality_score) == r.quality_score
    empty = docs.limit(0)
    assert quality.classify(empty, quality.fit(empty.select("text"))).count() == 0


def test_posteriors_weigh_overlapping_labellers():
    number = len(quality.labellers())
    all_good, all_bad = sum(3**k for k in range(number)), 0
    mixed = all_good - 3 ** 1 - 3 ** 2  # two labellers say bad
    chance = quality.posteriors(np.array([all_good, all_bad, mixed]), np.array([900.0, 50.0, 50.0]))
    assert chance[0] > 0.95 and chance[1] < 0.05 and chance[2] < 0.5


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab é\n\x0b\x1f", max_size=12), max_size=6))
def test_word_numbers(texts):
    coded = [t.encode() for t in texts]
    numbers, sizes = words.text_numbers(coded)
    flat = [w for t in coded for w in t.split()]
    assert sizes.tolist() == [len(t.split()) for t in coded]
    assert len(set(zip(flat, numbers.tolist()))) == len(set(flat)) == len(set(numbers.tolist()))
    assert len(words.word_tails(coded, 64)) == len(flat)
