"""Exact deduplication by a 128-bit content hash, with the bytes compared inside each hash group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import texts

_BLANKS = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """A text without blanks and line breaks; a null text is empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), _BLANKS, "")


def mark_duplicates(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical without blanks and line breaks. The row with the longest
    original text stays, of several the smallest doc_id. A null text is empty, so all empty and null
    texts are one group. Rows that repeat a doc_id count one by one and share its decision. A null
    doc_id loses against every other; a group of null ids alone has a null keep_id and stays.
    An empty table gives an empty result.

    Groups are formed on (hash, bytes): rows meet by the hash, and the aggregate compares the
    normalised bytes themselves, so two texts that collide are two groups. It combines before the
    shuffle, which carries each distinct text once per input partition, however large a group is.
    """
    normal = texts(docs).select("doc_id", F.length("text").alias("points"), normalised(F.col("text")).alias("normal"))
    hashed = normal.withColumn("hash128", F.unhex(F.md5("normal")))
    # The complement of an id falls as the id rises, so one maximum settles length and tie.
    best = F.max(F.struct(F.col("points"), F.bitwise_not(F.col("doc_id")).alias("turned"))).alias("best")
    groups = (
        hashed.groupBy("hash128", "normal")
        .agg(F.count(F.lit(1)).alias("group_size"), best)
        .select("hash128", F.sha2("normal", 256).alias("text_sha256"), "group_size", F.bitwise_not("best.turned").alias("keep_id"))
    )
    rows = hashed.select("doc_id", "hash128", F.sha2("normal", 256).alias("text_sha256"))
    return rows.join(groups, ["hash128", "text_sha256"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )
