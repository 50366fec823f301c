"""Rolling activity per creator over an unbounded feed.

The exact form keeps, per micro-batch, the newest events of each creator that the batch brought
and folds the batches when reading. From time to time the closed batches become one, so the stored
rows stay in proportion to the creators. A hot creator never meets in one task. The windowed form is a plain watermarked aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.keyed import last_n
from ..operators.live import FEATURE_EVENTS, window_counts
from .sinks import FOLD_EVERY, replace_closed

ORDER = ("timestamp", "event_id")


def _newest(events: DataFrame) -> DataFrame:
    return last_n(events, ["kol_id"], [F.desc(name) for name in ORDER], FEATURE_EVENTS)


def keep_recent(path: str, fold_every: int = FOLD_EVERY):
    """`foreachBatch` function that stores the batch's newest events per creator and, before every
    `fold_every`-th batch, folds the closed ones."""

    def write(batch_df: DataFrame, batch_id: int) -> None:
        if batch_id and batch_id % fold_every == 0:
            fold_recent(batch_df.sparkSession, path, batch_id)
        rows = _newest(batch_df).drop("recency").withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(path)
        )

    return write


def read_recent_stats(spark: SparkSession, path: str) -> DataFrame:
    """Counts over the newest events of each creator across all batches. A fold that ended half-way
    leaves events twice, with one id."""
    return window_counts(_newest(_once(spark.read.parquet(path))))


def _once(rows: DataFrame) -> DataFrame:
    return rows.drop("batch_id").dropDuplicates(["kol_id", "event_id"])


def fold_recent(spark: SparkSession, path: str, before: int) -> None:
    """One batch in place of all batches lower than `before`."""
    rows = spark.read.parquet(path).where(F.col("batch_id") < before)
    closed = rows.select("batch_id").distinct()
    folded = _newest(_once(rows)).drop("recency").withColumn("batch_id", F.lit(before - 1).cast("bigint"))
    replace_closed(folded, path, ["batch_id"], closed.where(F.col("batch_id") < before - 1))


def windowed_activity(events: DataFrame, window: str = "10 minutes", late: str = "10 minutes") -> DataFrame:
    """Per creator and time window: events, suspicious share, comment sentiment, distinct users
    (approximate, so that the state per window has a fixed size)."""
    comment = F.col("event_type") == "comment"
    counted = (
        events.withWatermark("timestamp", late)
        .groupBy(F.window("timestamp", window).alias("w"), "kol_id")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.count_if("is_suspicious").alias("suspicious_events"),
            F.count_if(comment & F.col("sentiment_score").isNotNull()).alias("comments"),
            F.avg(F.when(comment, F.col("sentiment_score"))).alias("avg_comment_sentiment"),
            F.approx_count_distinct("user_id").alias("users"),
        )
    )
    return counted.select(
        F.col("w.start").alias("window_start"),
        "kol_id",
        "events",
        "suspicious_events",
        (F.col("suspicious_events") / F.col("events")).alias("suspicious_event_ratio"),
        "comments",
        "avg_comment_sentiment",
        "users",
    )


def unique_events(events: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Drop repeated deliveries of the same (kol_id, event_ts) inside the watermark."""
    return events.withWatermark("event_ts", late).dropDuplicatesWithinWatermark(["kol_id", "event_ts"])
