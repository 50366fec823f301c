"""The corpus pipeline: documents filtered, deduplicated, decontaminated and encoded."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veracast.llm import bpe, decontamination, exact_dedup, simhash, toxicity
from veracast.llm.common import drop_rows, keep_rows, read, row_key, stored


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows predicted to be toxic go; the model is learnt from the labelled ones among the documents."""
    return toxicity.keep_clean(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document stays; rows alike in doc_id and normalised text are one document."""

    def key(text_sha256: Column) -> Column:
        return F.concat_ws(" ", F.col("doc_id").cast("long").cast("string"), text_sha256)  # a null id is left out

    kept = exact_dedup.mark_duplicates(docs).filter("kept").select(key(F.col("text_sha256")))
    return keep_rows(docs, kept, key(F.sha2(exact_dedup.normalised(F.col("text")), 256)))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of texts whose fingerprints (four-word shingles) lie within four bits the document
    with the smallest id stays; a null id loses against every other. Rows that share an id, null or not, are judged each by its own text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row"))
    marked = simhash.near_duplicates(docs.select(row_key().alias("doc_id"), "text"))
    linked = marked.select(F.col("doc_id").alias("row"), "component_id").distinct()
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    return keep_rows(docs, rows.join(linked, "row").groupBy("component_id").agg(least.alias("least")).select("least.row"), row_key())


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, each by its own text."""
    found = decontamination.find_items(docs.select(row_key().alias("doc_id"), "text"), read(spark, sf_dir, "benchmark"))
    return drop_rows(docs, found.select("doc_id"), row_key())


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of tokens, digests of ids and decoded text, a row for each document: repeated and null ids
    stay as they are, a null text is empty."""
    coded = bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact dedup", exact_stage),
    ("simhash near-dedup", near_stage),
    ("benchmark decontamination", benchmark_stage),
    ("bpe", encode_stage),
]

#: No SQL statement can express the learned filter, the fingerprints and the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage on what its predecessor kept; results in between are stored in the shared folder."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
