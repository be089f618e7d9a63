"""Registered queries of the training-data operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, chat, decontaminate, licenses, lm, merkle, neardup, pii, quality, rules, sql, substrings, warc, whitening
from millrace.llm.arrow import table
from millrace.plans.registry import Query
from millrace.session import scratch_path

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op1_weak_label_quality(spark: SparkSession, root: str) -> DataFrame:
    """Score and verdict of every document, learned from heuristic votes alone."""
    documents = table(spark, root, "documents").select("doc_id", "text")
    judged = quality.classify(documents, quality.fit(documents.select("text")))
    return judged.select("doc_id", F.round("quality_score", 6).alias("quality_score"), "good")


def op2_chat_formatting(spark: SparkSession, root: str) -> DataFrame:
    """All conversations, one record per row, plus conversation -7 in prompt layout."""
    rows = table(spark, root, "conversations")
    record = F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    records = rows.select("conv_id", "turn", F.to_json(record).alias("record"))
    prompt = F.to_json(F.struct(F.lit(CONTROL_TEXT).alias("prompt"), F.lit(CONTROL_TEXT).alias("response")))
    added = spark.range(1).select(F.lit(-7).cast("bigint"), F.lit(0).cast("bigint"), prompt)
    turns = chat.canonical_turns(records.union(added))
    return chat.digest_chats(chat.format_chats(turns)).withColumnRenamed("key", "conv_id")


def op3_patience_licenses(spark: SparkSession, root: str) -> DataFrame:
    """License notices in every document, one row each."""
    documents = table(spark, root, "documents").select("doc_id", "text")
    found = licenses.find_licenses(documents).select("doc_id", F.inline("licenses"))
    return found.withColumns({c: F.round(c, 6) for c in ("coverage", "score")})


def op4_hidden_markov_lm(spark: SparkSession, root: str) -> DataFrame:
    """Base and model score of every document; one fold of seven is held out."""
    return lm.score_texts(table(spark, root, "documents").select("doc_id", "text"))


def op5_decision_list(spark: SparkSession, root: str) -> DataFrame:
    """Statistics, base rule and learned verdict of every document."""
    documents = table(spark, root, "documents").select("doc_id", "text")
    learned = rules.fit(documents, table(spark, root, "labels"))
    judged = rules.judge(documents, learned)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select(
        *columns,
        failed.alias("base_failed"),
        (~failed & F.col("rule").isNull()).alias("kept"),
        "rule",
    )


def op6_byte_bpe(spark: SparkSession, root: str) -> DataFrame:
    """Token ids of every document, and the bytes decoded from them, as digests."""
    documents = table(spark, root, "documents").select("doc_id", "text")
    coded = bpe.round_trip(documents, VOCABULARY, public_tokenizers.PATTERN)
    return coded.select("doc_id", *bpe.digests(coded))


def op7_recompression(spark: SparkSession, root: str) -> DataFrame:
    """Documents without word sequences that occur elsewhere, as counts and a digest."""
    cut = substrings.remove_repeats(table(spark, root, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_bilstm_pii(spark: SparkSession, root: str) -> DataFrame:
    """Spans of personal data in every document."""
    documents = table(spark, root, "documents").select("doc_id", "text")
    found = pii.find_spans(documents, pii.train(documents))
    base = F.filter("spans", lambda x: x["base"])

    def joined(spans):
        parts = F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["begin"], x["end"]))
        return F.array_join(parts, ",")

    def counted(kind: str):
        own = F.filter(base, lambda x: x["kind"] == F.lit(kind))
        return F.size(own).cast("bigint").alias(f"n_{kind}")

    counts = [counted(kind) for kind in pii.KINDS]
    digest = F.sha2(joined(base), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, joined("spans").alias("spans"))


def op9_containment(spark: SparkSession, root: str) -> DataFrame:
    """Benchmark items that documents contain."""
    documents = table(spark, root, "documents")
    return decontaminate.contained_items(documents, table(spark, root, "benchmark"))


def op10_odd_sketch_neardup(spark: SparkSession, root: str) -> DataFrame:
    """Near-duplicate components of all documents by two-word shingles."""
    return neardup.near_duplicates(table(spark, root, "documents"), words=2, percent=80)


def op11_exact_whitening(spark: SparkSession, root: str) -> DataFrame:
    """The first 16 components of every embedding, whitened."""
    embeddings = table(spark, root, "embeddings").select("vec_id", "embedding")
    return whitening.whiten(embeddings, whitening.fit(embeddings))


def op12_warc_archive(spark: SparkSession, root: str) -> DataFrame:
    """Every page written to WARC files and read back.

    Responses are judged by their payload, revisits by their header alone.
    """
    path = scratch_path(spark, "warc")
    warc.archive(table(spark, root, "pages"), path, "page_id", "url", "html")

    def number(urn: str):
        text = F.substring_index(urn, ":", -1)
        return F.when(text != "", text).cast("bigint")

    whole = "record_type string, record_id string, payload binary"
    responses = warc.read(spark, path, whole).filter("record_type = 'response'").select(
        number("record_id").alias("page_id"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        "record_type",
        F.lit(None).cast("bigint").alias("refers_to"),
    )
    headers = "record_type string, record_id string, payload_bytes bigint, payload_digest string, refers_to string"
    revisits = warc.read(spark, path, headers).filter("record_type = 'revisit'").select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        F.substring_index("payload_digest", ":", -1).alias("payload_digest"),
        "record_type",
        number("refers_to").alias("refers_to"),
    )
    return responses.unionByName(revisits)


def op13_merkle_manifest(spark: SparkSession, root: str) -> DataFrame:
    """Proof of every document up to the root of the table, and what a changed length does to it.

    Of documents whose doc_id has a CRC that 7 divides, n_chars is one too many when the leaf
    is compared; a null doc_id has no CRC. A null length stays null.
    """
    documents = table(spark, root, "documents")
    columns = {c: F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")}
    longer = F.col("n_chars").cast("decimal(20,0)") + 1
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    changed = F.when(chosen, merkle.leaf_of(list((columns | {"n_chars": longer}).values())))
    keep = {"doc_id": F.col("doc_id"), "changed": changed}
    proved = merkle.prove_rows(documents, "lang", "doc_id", merkle.leaf_of(list(columns.values())), keep)
    found = proved.withColumn("folded_root", merkle.folded(F.coalesce("changed", "leaf"), F.col("path")))
    return found.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


QUERIES = {
    "op1_weak_label_quality": Query(op1_weak_label_quality),
    "op2_chat_formatting": Query(op2_chat_formatting, sql.chat(CONTROL_TEXT)),
    "op3_patience_licenses": Query(op3_patience_licenses),
    "op4_hidden_markov_lm": Query(op4_hidden_markov_lm),
    "op5_decision_list": Query(op5_decision_list),
    "op6_byte_bpe": Query(op6_byte_bpe),
    "op7_recompression": Query(op7_recompression, sql.repeats(35)),
    "op8_bilstm_pii": Query(op8_bilstm_pii),
    "op9_containment": Query(op9_containment, sql.containment(5, 80)),
    "op10_odd_sketch_neardup": Query(op10_odd_sketch_neardup, sql.near_duplicates(2, 80)),
    "op11_exact_whitening": Query(op11_exact_whitening),
    "op12_warc_archive": Query(op12_warc_archive, sql.archive(100)),
    "op13_merkle_manifest": Query(op13_merkle_manifest, sql.merkle()),
}
