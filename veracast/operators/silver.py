"""Comment sentiment and the unified per-content feature table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import half_up, mean_of_units, safe_int, to_units
from ..functions.score import LABEL_SOURCE, activity_percent, is_suspicious_rule, per_view, rule_trust
from ..functions.sentiment import (
    MISSING_TEXT_SOURCE,
    NO_COMMENTS_SOURCE,
    RULE_SOURCE,
    content_label,
    with_comment_sentiment,
)
from ..functions.text import hash_pii, repair_mojibake
from ..functions.timeparse import parse_timestamp
from .api_items import add_rule_labels
from .bronze import text_or_empty
from ..session import cut_lineage
from .keyed import attach_per_key, present


def carries_sentiment() -> Column:
    """The raw comment comes with a label and a score."""
    return F.col("comment_sentiment").isNotNull() & F.col("comment_sentiment_score").isNotNull()


def without_source(comments: DataFrame, source: str) -> DataFrame:
    """Raw comments but those whose carried sentiment comes from `source`. A filter on the finished `sentiment_source`
    gives the same rows, but would be pushed below the scoring and score every text several times over."""
    return comments.where(~(carries_sentiment() & F.coalesce(F.col("comment_sentiment_source") == source, F.lit(False))))


def with_sentiment_default(comments: DataFrame) -> DataFrame:
    """Rows that carry a label and a score keep them; others are scored from their text, or count
    as neutral when the text is missing or hashed. Adds `_label`, `_score` and `_source`."""
    carried = carries_sentiment()
    readable = present("comment_text") & ~F.coalesce(F.col("comment_text_is_hashed"), F.lit(False))
    to_score = F.when(readable & ~carried, F.col("comment_text"))
    # Only rows that need it have a text to score; the struct of the others is NULL.
    scored = with_comment_sentiment(comments.withColumn("_carried", carried), to_score)
    found = F.col("s").isNotNull()
    return scored.withColumns(
        {
            "_label": F.when(F.col("_carried"), F.col("comment_sentiment"))
            .when(found, F.col("s.label"))
            .otherwise(F.lit("neutral")),
            "_score": F.when(F.col("_carried"), F.col("comment_sentiment_score").cast("double"))
            .when(found, F.col("s.score"))
            .otherwise(F.lit(50.0)),
            "_source": F.when(F.col("_carried"), F.coalesce("comment_sentiment_source", F.lit(RULE_SOURCE)))
            .when(found, F.col("s.source"))
            .otherwise(F.lit(MISSING_TEXT_SOURCE)),
        }
    ).drop("s", "_carried")


def _falsy_score(score: Column) -> Column:
    """A score of 0 counts as 50."""
    return F.coalesce(F.nullif(score, F.lit(0.0)), F.lit(50.0))


def comment_sentiment_rows(comments: DataFrame, anonymize: bool = True) -> DataFrame:
    """The silver comment table; anonymising hashes texts and authors."""
    scored = with_sentiment_default(comments)
    text = text_or_empty("comment_text")
    name, author = text_or_empty("comment_author_display_name"), text_or_empty("comment_author_channel_id")
    already = F.coalesce(F.col("comment_text_is_hashed"), F.lit(False))
    return scored.select(
        F.coalesce("platform", F.lit("youtube")).alias("platform"),
        text_or_empty("channel_id").alias("creator_id"),
        text_or_empty("video_id").alias("content_id"),
        text_or_empty("comment_id").alias("comment_id"),
        text_or_empty("parent_comment_id").alias("parent_comment_id"),
        F.coalesce("is_reply", F.lit(False)).alias("is_reply"),
        (hash_pii(name) if anonymize else name).alias("comment_author_display_name"),
        (hash_pii(author) if anonymize else author).alias("comment_author_channel_id"),
        (hash_pii(text) if anonymize else repair_mojibake(text)).alias("comment"),
        (F.when(text != "", F.lit(True)).otherwise(already) if anonymize else already).alias("comment_text_is_hashed"),
        safe_int(F.col("comment_like_count")).alias("like_count"),
        F.coalesce(F.nullif("_label", F.lit("")), F.lit("neutral")).alias("sentiment"),
        half_up(_falsy_score(F.col("_score")), 2).alias("sentiment_score"),
        F.coalesce(F.nullif("_source", F.lit("")), F.lit(RULE_SOURCE)).alias("sentiment_source"),
        text_or_empty("comment_published_at").alias("comment_published_at"),
        text_or_empty("collected_at").alias("collected_at"),
    )


def content_sentiment(comments: DataFrame) -> DataFrame:
    """Mean score and label counts per video over all raw comment rows, repeats included."""
    scored = with_sentiment_default(comments.where(present("video_id")))
    label = F.coalesce(F.nullif("_label", F.lit("")), F.lit("neutral"))
    rows = scored.select("video_id", label.alias("_label"), to_units(_falsy_score(F.col("_score")), 6).alias("_units"))
    mean = mean_of_units(F.sum("_units"), F.count(F.lit(1)), 6, 2)
    return (
        rows.groupBy("video_id")
        .agg(
            mean.alias("sentiment_score"),
            F.count_if(F.col("_label") == "positive").alias("positive_comment_count"),
            F.count_if(F.col("_label") == "neutral").alias("neutral_comment_count"),
            F.count_if(F.col("_label") == "negative").alias("negative_comment_count"),
        )
        .withColumn("sentiment_label", content_label(F.col("sentiment_score")))
        .withColumn("sentiment_source", F.lit(RULE_SOURCE))
    )


def with_content_sentiment(videos: DataFrame, comments: DataFrame) -> DataFrame:
    """Videos and comment aggregates both have one row per video; a video without comments is
    neutral 50."""
    joined = videos.join(content_sentiment(comments), "video_id", "left")
    zero = F.lit(0).cast("bigint")
    return joined.select(
        *videos.columns,
        F.coalesce("sentiment_score", F.lit(50.0)).alias("sentiment_score"),
        F.coalesce("sentiment_label", F.lit("neutral")).alias("sentiment_label"),
        F.coalesce("positive_comment_count", zero).alias("positive_comment_count"),
        F.coalesce("neutral_comment_count", zero).alias("neutral_comment_count"),
        F.coalesce("negative_comment_count", zero).alias("negative_comment_count"),
        F.coalesce("sentiment_source", F.lit(NO_COMMENTS_SOURCE)).alias("sentiment_source"),
    )


_CONTENT = [
    "platform", "creator_id", "creator_name", "content_id", "content_title", "publish_time", "follower_count",
    "content_count", "view_count", "like_count", "comment_count", "share_count", "engagement_rate", "likes_per_view",
    "comments_per_view", "shares_per_view", "sentiment_score", "sentiment_label", "positive_comment_count",
    "neutral_comment_count", "negative_comment_count", "activity_score", "trust_score", "is_suspicious",
    "label_source", "collected_at", "first_seq",
]


def youtube_features(videos: DataFrame, comments: DataFrame) -> DataFrame:
    labelled = add_rule_labels(with_content_sentiment(videos, comments), F.col("sentiment_score"))
    return labelled.select(
        "*",
        F.col("channel_id").alias("creator_id"),
        F.col("channel_name").alias("creator_name"),
        F.col("video_id").alias("content_id"),
        F.col("title").alias("content_title"),
        F.col("published_at").alias("publish_time"),
        F.col("subscriber_count").alias("follower_count"),
        F.col("channel_video_count").alias("content_count"),
        F.lit(0).cast("bigint").alias("share_count"),
        F.lit(0.0).alias("shares_per_view"),
    ).select(_CONTENT)


def tiktok_features(videos: DataFrame) -> DataFrame:
    """Shares join the engagement and activity; sentiment is neutral and the rounded activity
    enters the trust score. The creator's sizes are not known here and stay NULL."""
    views, likes = F.col("view_count"), F.col("like_count")
    comments, shares = F.col("comment_count"), F.col("share_count")
    zero = F.lit(0).cast("bigint")
    unknown = F.lit(None).cast("bigint")
    return (
        videos.withColumn("engagement_rate", per_view(likes + comments + shares, views))
        .withColumn("activity_score", half_up(activity_percent(comments + shares), 2))
        .select(
            "*",
            per_view(likes, views).alias("likes_per_view"),
            per_view(comments, views).alias("comments_per_view"),
            per_view(shares, views).alias("shares_per_view"),
            F.lit(50.0).alias("sentiment_score"),
            F.lit("neutral").alias("sentiment_label"),
            zero.alias("positive_comment_count"),
            zero.alias("neutral_comment_count"),
            zero.alias("negative_comment_count"),
            rule_trust(F.col("engagement_rate"), F.lit(50.0), F.col("activity_score")).alias("trust_score"),
            is_suspicious_rule(F.col("engagement_rate"), views, comments).alias("is_suspicious"),
            F.lit(LABEL_SOURCE).alias("label_source"),
            unknown.alias("follower_count"),
            unknown.alias("content_count"),
        )
        .select(_CONTENT)
    )


def content_features(youtube_videos: DataFrame, youtube_comments: DataFrame, tiktok_videos: DataFrame) -> DataFrame:
    """One row per content of either platform, without the columns that come from the creator."""
    return youtube_features(youtube_videos, youtube_comments).unionByName(tiktok_features(tiktok_videos))


def publish_times(youtube_videos: DataFrame, tiktok_videos: DataFrame) -> DataFrame:
    """Creator and publish time of every content: all that the upload frequency needs."""
    youtube = youtube_videos.select(
        "platform", F.col("channel_id").alias("creator_id"), F.col("published_at").alias("publish_time")
    )
    return youtube.unionByName(tiktok_videos.select("platform", "creator_id", "publish_time"))


def upload_frequency(content: DataFrame) -> DataFrame:
    """Uploads per week and creator: n for at most one upload, else n per whole days between the
    first and last one, times seven; 0 without a readable time. `_weight` counts the rows."""
    timed = content.where(present("creator_id")).select("platform", "creator_id", "publish_time").withColumn(
        "_at", F.unix_timestamp(parse_timestamp(F.col("publish_time")))
    )
    per_creator = timed.groupBy("platform", "creator_id").agg(
        F.count(F.lit(1)).alias("_weight"),
        F.count("_at").alias("_uploads"),
        (F.max("_at") - F.min("_at")).alias("_span"),
    )
    days = F.greatest(F.floor(F.col("_span") / F.lit(86400.0)), F.lit(1).cast("bigint"))
    weekly = half_up(F.col("_uploads") / days * F.lit(7.0), 4)
    return per_creator.select(
        "platform",
        "creator_id",
        F.when(F.col("_uploads") <= 1, F.col("_uploads").cast("double")).otherwise(weekly).alias("upload_frequency"),
        "_weight",
    )


def creator_sizes(tiktok_creators: DataFrame) -> DataFrame:
    return tiktok_creators.select(
        "platform",
        "creator_id",
        F.col("follower_count").alias("_followers"),
        F.col("content_count").alias("_contents"),
    )


def unified_features(
    youtube_videos: DataFrame, youtube_comments: DataFrame, tiktok_creators: DataFrame, tiktok_videos: DataFrame
) -> DataFrame:
    """One row per content of either platform: the 28 contract columns and `first_seq`."""
    content = cut_lineage(content_features(youtube_videos, youtube_comments, tiktok_videos))
    return with_creators(content, creator_sizes(tiktok_creators))


def with_creators(content: DataFrame, sizes: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """Content with the columns that come from its creator; all of it, or `rows` of it. `content` is read twice, so it
    should be a stored table.

    What comes from the creator (sizes, upload frequency) is gathered into one row per creator,
    stored, and attached in a single join; creators without sizes count 0.
    """
    keys = ["platform", "creator_id"]
    per_creator = cut_lineage(upload_frequency(content).join(sizes, keys, "left"))
    attached = attach_per_key(
        content if rows is None else rows, per_creator.drop("_weight"), keys, ["content_id"], weights=per_creator.select(*keys, "_weight")
    )
    zero = F.lit(0).cast("bigint")
    return attached.withColumns(
        {
            "follower_count": F.coalesce("follower_count", "_followers", zero),
            "content_count": F.coalesce("content_count", "_contents", zero),
            "upload_frequency": F.coalesce("upload_frequency", F.lit(0.0)),
            "follower_growth_rate": F.lit(None).cast("double"),
        }
    ).drop("_followers", "_contents")
