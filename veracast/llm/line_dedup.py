"""Removal of boilerplate lines that many sites share. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, texts


def line_rows(docs: DataFrame, site: str = "source") -> DataFrame:
    """One row per line that is not blank: doc_id, hash of the whole text, site, place of the line, 128-bit line hash."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(site).cast("string"), F.lit("")).alias("site"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    lines = own.select("doc_id", F.xxhash64("text").alias("text_hash"), "site", F.posexplode(F.split("text", "\n")).alias("place", "line"))
    trimmed = lines.select("doc_id", "text_hash", "site", "place", F.trim(F.regexp_replace("line", r"[\x09-\x0D]", " ")).alias("line"))
    # Two hashes of 64 bits; the second sees the line behind a constant.
    return trimmed.filter("line != ''").select("doc_id", "text_hash", "site", "place", F.xxhash64("line").alias("line_a"), F.xxhash64(F.lit(1), F.col("line")).alias("line_b"))


def widespread_lines(lines: DataFrame, min_sites: int, precision: int = 12) -> DataFrame:
    """The hashes of lines found on at least `min_sites` distinct sites.

    Each line has a HyperLogLog sketch of its sites, which combines before the shuffle. An estimate of
    half or twice the threshold is beyond the sketch's error and decides; lines in between are counted
    exactly, over their distinct (line, site) rows.
    """
    key = ["line_a", "line_b"]
    spread = lines.groupBy(*key).agg(F.count(F.lit(1)).alias("uses"), F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(precision))).alias("about"))
    # A line used fewer times than the threshold cannot be on that many sites.
    judged = spread.filter((F.col("uses") >= min_sites) & (2 * F.col("about") > min_sites))
    sure = judged.filter(F.col("about") >= 2 * min_sites).select(*key)
    near = judged.filter(F.col("about") < 2 * min_sites).select(*key)
    counted = lines.join(near, key, "left_semi").groupBy(*key).agg(F.count_distinct("site").alias("sites"))
    return sure.unionByName(counted.filter(F.col("sites") >= min_sites).select(*key))


def remove_boilerplate(docs: DataFrame, min_sites: int = 5, site: str = "source") -> DataFrame:
    """doc_id, n_lines, n_removed, kept_text: every whole text without its widespread lines.

    Lines end at a line feed; they are compared without blanks at their ends. Blank lines are never
    removed nor counted. All copies of a widespread line go, on every site, the first one too. A null
    site is a site of its own (the empty one); a null text is empty and stays empty. Rows that share
    a doc_id, null or not, each lose the places of their own text and stay as many rows. An empty
    table gives an empty result.
    """
    lines = stored(line_rows(docs, site), "lines")
    wide = widespread_lines(lines, min_sites)
    gone = lines.join(wide, ["line_a", "line_b"]).groupBy("doc_id", "text_hash").agg(F.collect_set("place").alias("places"))
    counts = texts(docs).select("doc_id", "text", F.xxhash64("text").alias("own_hash"), F.split("text", "\n").alias("all_lines"))
    joined = counts.join(gone.withColumnRenamed("doc_id", "gone_id"), F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("own_hash") == F.col("text_hash")), "left")
    blank = r"^[\x20\x09-\x0D]*$"
    # Only texts that lose lines are taken apart and joined again.
    drop = F.map_from_arrays(F.col("places"), F.transform("places", lambda p: F.lit(True)))
    kept = F.filter("all_lines", lambda line, place: ~F.coalesce(F.element_at(drop, place), F.lit(False)))
    return joined.select(
        "doc_id",
        F.size(F.filter("all_lines", lambda line: ~line.rlike(blank))).cast("long").alias("n_lines"),
        F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col("places").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("kept_text"),
    )
