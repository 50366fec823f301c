"""Records of the event topic -> scored rows. The same function takes a batch or a stream."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from ..functions import score as S
from ..functions.numeric import half_up
from ..functions.sentiment import with_unit_sentiment
from ..ml.sentiment import text_scores
from ..plans.scoring import LOW_TRUST_BELOW, SUSPICIOUS_FROM, _score
from ..schemas import SCORED_COLUMNS, STREAM_EVENT


def parse_records(records: DataFrame) -> DataFrame:
    """Payload fields beside the record's own coordinates."""
    payload = F.col("value").cast("string")
    return records.select(
        payload.alias("raw_payload"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.from_json(payload, STREAM_EVENT).alias("event"),
    ).select("event.*", "raw_payload", "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp")


def corrupt_records(records: DataFrame) -> DataFrame:
    """Records whose payload is no JSON. They stay in the scored output too, with defaults; this
    view is for a quarantine folder."""
    return records.where(F.try_parse_json(F.col("value").cast("string")).isNull())


def coalesce_aliases(parsed: DataFrame) -> DataFrame:
    """Alias fields and defaults. Here a zero is a value and does not fall through.
    An unreadable event time falls back to the batch's current time, which the checkpoint keeps,
    so that a batch that runs again gives the same rows."""

    def first(*names: str, default) -> F.Column:
        return F.coalesce(*[F.col(name) for name in names], F.lit(default))

    event_time = F.coalesce("timestamp", "crawled_at").try_cast("timestamp")
    zero = 0
    return parsed.withColumns(
        {
            "kol_id": first("kol_id", "channel_id", "channel", default="unknown"),
            "kol_name": first("kol_name", "channel_title", "channel", default="Unknown KOL"),
            "platform": first("platform", "source", default="youtube"),
            "event_ts": F.coalesce(event_time, F.current_timestamp()),
            "views": first("views", "view_count", default=zero),
            "likes": first("likes", "like_count", default=zero),
            "comments": first("comments", "comment_count", default=zero),
            "shares": first("shares", default=zero),
            "followers": first("followers", "subscriber_count", default=zero),
            "upload_frequency_7d": first("upload_frequency_7d", default=2.0),
            "live_concurrent_viewers": first("live_concurrent_viewers", default=0.0),
            "follower_growth_rate": first("follower_growth_rate", default=0.0),
            "comment_spam_ratio": first("comment_spam_ratio", default=0.0),
            "text": first("text", default=""),
        }
    )


def score_stream(
    records: DataFrame,
    trust_model: PipelineModel | None = None,
    sentiment_model: PipelineModel | None = None,
) -> DataFrame:
    """The 23-column scored row per record.

    The trust score is made without growth and spam, whose part in the anomaly shows in
    `anomaly_score` and `is_suspicious` only.
    """
    base = coalesce_aliases(parse_records(records))
    if sentiment_model is None:
        base = with_unit_sentiment(base, F.col("text"), "_sentiment")
    else:
        base = text_scores(base, "text", "_sentiment", sentiment_model)
        base = base.withColumn("_sentiment", F.when(F.col("text") != "", F.col("_sentiment")).otherwise(0.5))
    engagement = S.weighted_engagement(F.col("likes"), F.col("comments"), F.col("shares"), F.col("views"))
    zero = F.lit(0.0)
    staged = (
        base.withColumn("_engagement", engagement)
        .withColumn(
            "_activity", S.stream_activity_score(F.col("upload_frequency_7d"), F.col("live_concurrent_viewers"))
        )
        .withColumn(
            "_full_anomaly",
            S.stream_anomaly_score(F.col("_engagement"), F.col("follower_growth_rate"), F.col("comment_spam_ratio")),
        )
        .withColumn("_anomaly", S.anomaly_score(F.col("_engagement"), zero, zero))
        .withColumn("_suspicious", F.col("_full_anomaly") >= SUSPICIOUS_FROM)
        .withColumn("_growth", zero)
        .withColumn("_views", F.col("views").cast("double"))
        .withColumn("_likes", F.col("likes").cast("double"))
        .withColumn("_comments", F.col("comments").cast("double"))
        .withColumn("_shares", F.col("shares").cast("double"))
        .withColumn("_followers", F.col("followers").cast("double"))
    )
    scored = _score(staged, trust_model).withColumn("trust_score", half_up(F.col("_score"), 2))
    return (
        scored.withColumn("engagement_rate", F.col("_engagement"))
        .withColumn("sentiment_score", F.col("_sentiment"))
        .withColumn("activity_score", F.col("_activity"))
        .withColumn("anomaly_score", F.col("_full_anomaly"))
        .withColumn("is_suspicious", F.col("_suspicious") | (F.col("trust_score") < LOW_TRUST_BELOW))
        .withColumn("processed_at", F.current_timestamp())
        .withColumn("event_date", F.date_format("event_ts", "yyyy-MM-dd"))
        .select(SCORED_COLUMNS)
    )
