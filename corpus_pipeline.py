"""A corpus made ready for training: five stages over the table ``documents``.

Each stage takes (spark, docs, sf_dir) and returns what the next one gets, written as Parquet
in between. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm import bpe, decontaminate, neardup, pii, quality
from millrace.llm.arrow import SCHEMAS, table
from millrace.session import prepare, stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned on these documents, calls good."""
    docs = docs.select(COLUMNS)
    return quality.classify(docs, quality.fit(docs.select("text"))).filter("good").select(COLUMNS)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest doc_id of each near-duplicate group, by five-word shingles.

    Of rows with one doc_id the first in order of their columns stays; rows without doc_id stay.
    """
    docs = docs.select(COLUMNS)
    judged = neardup.near_duplicates(docs)
    staying = docs.join(judged.filter("kept").select("doc_id").distinct(), "doc_id", "left_semi")
    first = Window.partitionBy("doc_id").orderBy(*COLUMNS[1:])
    one = staying.withColumn("_row", F.row_number().over(first)).filter("_row = 1")
    return one.select(COLUMNS).union(docs.filter("doc_id is null"))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    marked = decontaminate.mark_contained(docs.select(COLUMNS), table(spark, sf_dir, "benchmark"))
    return marked.filter(F.size("contained") == 0).select(COLUMNS)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their kind in place of spans of personal data; n_chars follows."""
    docs = docs.select(COLUMNS)
    found = pii.find_spans(docs, pii.train(docs))
    changed = F.when(F.size("spans") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return pii.redact(found).withColumn("n_chars", changed).select(COLUMNS)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether decoding them gives the text back."""
    coded = bpe.round_trip(docs.select(COLUMNS), VOCABULARY, public_tokenizers.PATTERN)
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return coded.select(
        "doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids", same.alias("decodes")
    )


STAGES = [
    ("quality_classifier", keep_good),
    ("minhash_near_dedup", keep_one_of_each_group),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("pii", redact_personal_data),
    ("byte_bpe", encode_tokens),
]
#: A learned classifier and minima of hashes cannot be stated in SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents`` in ``sf_dir``, each written and read again."""
    prepare(spark)
    docs = spark.read.schema(SCHEMAS["documents"]).parquet(f"{str(sf_dir).rstrip('/')}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
