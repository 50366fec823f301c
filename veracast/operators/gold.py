"""Creator scores, profiles, feature subsets, serving events and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import schemas
from ..functions.buckets import split_name
from ..functions.numeric import mean_of_units, safe_int, to_units
from ..functions.score import LABEL_SOURCE
from .keyed import global_rank, present


def _mean(name: str, unit_digits: int, zero_counts_as: float | None = None) -> Column:
    value = F.coalesce(F.col(name), F.lit(0.0))
    if zero_counts_as is not None:
        value = F.coalesce(F.nullif(F.col(name), F.lit(0.0)), F.lit(zero_counts_as))
    return mean_of_units(F.sum(to_units(value, unit_digits)), F.count(F.lit(1)), unit_digits, unit_digits)


def creator_totals(features: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """Per creator: sizes, views, mean rates and suspicious content; one combining aggregate.

    Features that do not have their creators' sizes attached yet get them here, from one row per
    creator (`sizes`) to one row per creator, which spares the join of all content rows.
    """
    totals = _totals(features)
    if sizes is None:
        return totals
    zero = F.lit(0).cast("bigint")
    return totals.join(sizes, ["platform", "creator_id"], "left").select(
        *[name for name in totals.columns if name not in ("follower_count", "content_count")],
        F.coalesce("follower_count", "_followers", zero).alias("follower_count"),
        F.coalesce("content_count", "_contents", zero).alias("content_count"),
    )


def _totals(features: DataFrame) -> DataFrame:
    return (
        features.where(present("creator_id"))
        .groupBy("platform", "creator_id")
        .agg(
            F.min_by("creator_name", "first_seq").alias("creator_name"),
            F.max("follower_count").alias("follower_count"),
            F.max("content_count").alias("content_count"),
            F.count(F.lit(1)).alias("observed_content_count"),
            F.sum("view_count").alias("total_views"),
            _mean("engagement_rate", 6).alias("avg_engagement_rate"),
            _mean("sentiment_score", 2, 50.0).alias("avg_sentiment_score"),
            _mean("activity_score", 2).alias("avg_activity_score"),
            _mean("trust_score", 2).alias("trust_score"),
            F.sum("is_suspicious").alias("suspicious_content_count"),
            F.max("collected_at").alias("collected_at"),
            F.min("first_seq").alias("first_seq"),
        )
    )


def _platform_order() -> Column:
    """YouTube content precedes TikTok content."""
    return F.when(F.col("platform") == "youtube", 0).otherwise(1)


def creator_trust_scores(features: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """The leaderboard: trust, then views, then first appearance."""
    totals = creator_totals(features, sizes).withColumn("label_source", F.lit(LABEL_SOURCE))
    order = [F.desc("trust_score"), F.desc("total_views"), _platform_order(), F.col("first_seq")]
    return global_rank(totals, order).select(schemas.TRUST_SCORE_COLUMNS)


def creator_profiles(features: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """Creator totals without the trust columns; sorted by size when written or shown."""
    return creator_totals(features, sizes).select(schemas.CREATOR_PROFILE_COLUMNS)


def profiles_by_size(profiles: DataFrame) -> DataFrame:
    return profiles.orderBy(F.desc("total_views"), F.desc("follower_count"), "platform", "creator_id")


def seeds_by_size(seeds: DataFrame) -> DataFrame:
    return seeds.orderBy(F.desc(safe_int(F.col("subscriber_count"))), "channel_id")


def engagement_features(features: DataFrame) -> DataFrame:
    return features.select(schemas.ENGAGEMENT_FEATURE_COLUMNS)


def suspicious_engagement(features: DataFrame) -> DataFrame:
    return features.select(schemas.SUSPICIOUS_ENGAGEMENT_COLUMNS)


def suspicious_only(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("is_suspicious").cast("boolean"))


def serving_events(features: DataFrame, deterministic_ids: bool = True) -> DataFrame:
    """Events of content with views. Ids hash the content key, so that a task that runs again
    writes the same rows; random ids are available."""
    key = F.concat_ws("|", "platform", "creator_id", "content_id")
    return features.where(F.col("view_count") > 0).select(
        (F.sha2(key, 256) if deterministic_ids else F.expr("uuid()")).alias("event_id"),
        "platform",
        F.col("creator_id").alias("channel_id"),
        F.col("creator_name").alias("channel_name"),
        F.col("content_id").alias("video_id"),
        F.col("view_count").alias("views"),
        F.col("like_count").alias("likes"),
        F.col("comment_count").alias("comments"),
        F.col("follower_count").alias("subscribers"),
        "engagement_rate",
        "sentiment_score",
        "trust_score",
        "collected_at",
    )


def with_split(rows: DataFrame) -> DataFrame:
    """The split is a function of the creator, so every creator lands in exactly one."""
    return rows.withColumn("split", split_name(F.col("platform"), F.col("creator_id")))


def split_rows(rows: DataFrame) -> dict[str, DataFrame]:
    tagged = with_split(rows)
    return {name: tagged.where(F.col("split") == name).drop("split") for name in ("train", "eval", "analysis_profile")}


def split_leakage(tagged: DataFrame) -> DataFrame:
    """Creators found in more than one split; empty when the split is sound."""
    splits = tagged.groupBy("platform", "creator_id").agg(
        F.min("split").alias("first_split"), F.max("split").alias("last_split")
    )
    return splits.where(F.col("first_split") != F.col("last_split"))
