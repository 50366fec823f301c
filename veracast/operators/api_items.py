"""Nested platform API items flattened into raw rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import first_nonblank, safe_int
from ..functions.sentiment import with_comment_sentiment
from ..functions.score import (
    LABEL_SOURCE,
    activity_percent,
    falsy_to,
    is_suspicious_rule,
    per_view,
    rule_trust,
)
from ..functions.numeric import clamp, half_up
from ..functions.text import extract_hashtags, hash_text
from .keyed import attach_per_key, dedupe_latest


def add_rule_labels(df: DataFrame, sentiment: Column) -> DataFrame:
    """Engagement ratios, suspicion flag and the batch trust score of YouTube-style counts.
    The activity share enters the trust score before it is rounded."""
    views, likes, comments = F.col("view_count"), F.col("like_count"), F.col("comment_count")
    score = falsy_to(sentiment, 50.0)
    return (
        df.withColumn("engagement_rate", per_view(likes + comments, views))
        .withColumn("likes_per_view", per_view(likes, views))
        .withColumn("comments_per_view", per_view(comments, views))
        .withColumn("is_suspicious", is_suspicious_rule(F.col("engagement_rate"), views, comments))
        .withColumn("sentiment_score", half_up(clamp(score, 0.0, 100.0), 2))
        .withColumn("activity_score", half_up(activity_percent(comments), 2))
        .withColumn("trust_score", rule_trust(F.col("engagement_rate"), score, activity_percent(comments)))
        .withColumn("label_source", F.lit(LABEL_SOURCE))
    )


def normalize_channels(items: DataFrame) -> DataFrame:
    return items.select(
        F.lit("youtube").alias("platform"),
        F.col("id").alias("channel_id"),
        F.col("snippet.title").alias("channel_name"),
        safe_int(F.col("statistics.subscriberCount")).alias("subscriber_count"),
        safe_int(F.col("statistics.videoCount")).alias("video_count"),
        safe_int(F.col("statistics.viewCount")).alias("view_count"),
        "collected_at",
    )


def normalize_videos(items: DataFrame, channels: DataFrame, order: str = "collected_at") -> DataFrame:
    """Video items with their channel's sizes; the channel also stands in for missing names.
    The channel of an item is found by the channel id in its snippet; of a channel listed several
    times the last row by `order` (where channels have it) counts, so no video is multiplied."""
    values = F.struct(F.col("channel_name"), F.col("subscriber_count"), F.col("video_count"))
    newest = F.struct(F.col(order), values) if order in channels.columns else values
    last = channels.groupBy(F.col("channel_id").alias("_channel")).agg(
        F.max_by(values, newest).alias("_last")
    )
    lookup = last.select(
        "_channel",
        F.col("_last.channel_name").alias("_channel_name"),
        F.col("_last.subscriber_count").alias("_subscribers"),
        F.col("_last.video_count").alias("_videos"),
    )
    rows = items.withColumn("_channel", F.col("snippet.channelId"))
    base = attach_per_key(rows, lookup, ["_channel"], ["id"]).select(
        F.lit("youtube").alias("platform"),
        F.col("_channel").alias("channel_id"),
        first_nonblank(F.col("snippet.channelTitle"), F.col("_channel_name")).alias("channel_name"),
        F.col("id").alias("video_id"),
        F.col("snippet.title").alias("video_title"),
        F.col("snippet.publishedAt").alias("published_at"),
        safe_int(F.col("statistics.viewCount")).alias("view_count"),
        safe_int(F.col("statistics.likeCount")).alias("like_count"),
        safe_int(F.col("statistics.commentCount")).alias("comment_count"),
        safe_int(F.col("_subscribers")).alias("subscriber_count"),
        safe_int(F.col("_videos")).alias("video_count"),
        "collected_at",
    )
    return add_rule_labels(base, F.lit(50.0))


def flatten_comment_threads(threads: DataFrame, anonymize: bool = False) -> DataFrame:
    """One row for the top-level comment of each thread and one per reply, scored for sentiment."""
    top = F.col("snippet.topLevelComment")
    top_id = top["id"]

    def tagged(comment: Column, is_reply: bool) -> Column:
        return F.struct(
            comment["id"].alias("id"),
            comment["snippet"].alias("snippet"),
            (top_id if is_reply else F.lit("")).alias("parent"),
            F.lit(is_reply).alias("is_reply"),
        )

    replies = F.coalesce(
        F.transform("replies.comments", lambda reply: tagged(reply, True)),
        F.filter(F.array(tagged(top, True)), lambda _: F.lit(False)),
    )
    rows = threads.select(
        "video_id", "channel_id", "collected_at", F.explode(F.concat(F.array(tagged(top, False)), replies)).alias("c")
    )
    snippet = F.col("c.snippet")
    author = snippet["authorChannelId"]
    author_id = F.when(author.startswith("{"), F.get_json_object(author, "$.value")).otherwise(author)
    texts = rows.select(
        "*",
        F.coalesce(first_nonblank(snippet["textOriginal"], snippet["textDisplay"]), F.lit("")).alias("text"),
        author_id.alias("author_id"),
    )
    scored = with_comment_sentiment(texts, F.col("text"))
    return scored.select(
        F.lit("youtube").alias("platform"),
        "channel_id",
        "video_id",
        F.col("c.id").alias("comment_id"),
        F.col("c.parent").alias("parent_comment_id"),
        F.col("c.is_reply").alias("is_reply"),
        F.coalesce(F.col("c.snippet.authorDisplayName"), F.lit("")).alias("comment_author_display_name"),
        F.col("author_id").alias("comment_author_channel_id"),
        (hash_text(F.col("text")) if anonymize else F.col("text")).alias("comment_text"),
        F.lit(anonymize).alias("comment_text_is_hashed"),
        safe_int(F.col("c.snippet.likeCount")).alias("comment_like_count"),
        F.col("s.label").alias("comment_sentiment"),
        F.col("s.score").alias("comment_sentiment_score"),
        F.col("s.source").alias("comment_sentiment_source"),
        F.col("c.snippet.publishedAt").alias("comment_published_at"),
        "collected_at",
    )


def _field(df: DataFrame, struct: str, name: str) -> Column:
    """A field of a struct column, or NULL where the schema has no such field."""
    fields = df.schema[struct].dataType.fieldNames() if struct in df.columns else []
    return F.col(f"{struct}.{name}") if name in fields else F.lit(None).cast("string")


def _first_field(df: DataFrame, struct: str, names: tuple[str, ...], default: Column) -> Column:
    return F.coalesce(*[_field(df, struct, name).cast("string") for name in names], default)


def _first_column(df: DataFrame, names: tuple[str, ...], default: Column) -> Column:
    return F.coalesce(*[F.col(name).cast("string") for name in names if name in df.columns], default)


def normalize_tiktok_creators(items: DataFrame) -> DataFrame:
    """Columns: username, category, collected_at, user STRUCT and stats STRUCT, or both inside
    userInfo; the requested username stands in for missing ids and names."""
    if "userInfo" in items.columns:
        items = items.select("username", "category", "collected_at", "userInfo.*")
    asked = F.col("username")
    zero = F.lit("0")
    return items.select(
        F.lit("tiktok").alias("platform"),
        _first_field(items, "user", ("id", "uid"), asked).alias("creator_id"),
        _first_field(items, "user", ("nickname", "uniqueId"), asked).alias("creator_name"),
        _first_field(items, "user", ("uniqueId", "username"), asked).alias("username"),
        "category",
        safe_int(_first_field(items, "stats", ("followerCount", "followers"), zero)).alias("follower_count"),
        safe_int(_first_field(items, "stats", ("followingCount", "following"), zero)).alias("following_count"),
        safe_int(_first_field(items, "stats", ("videoCount", "videos"), zero)).alias("content_count"),
        "collected_at",
    )


def normalize_tiktok_videos(items: DataFrame) -> DataFrame:
    """Columns: alternative spellings of the raw fields, author STRUCT, stats STRUCT, creator STRUCT
    (the requested creator, which wins over the author), challenges and textExtra arrays."""
    empty, zero = F.lit(""), F.lit("0")

    def owner(creator_field: str, author_fields: tuple[str, ...]) -> Column:
        wanted = F.nullif(_field(items, "creator", creator_field), F.lit(""))
        return F.coalesce(wanted, _first_field(items, "author", author_fields, empty))

    def count(*names: str) -> Column:
        return safe_int(_first_field(items, "stats", names, zero))

    caption = _first_column(items, ("desc", "title"), empty)
    no_challenges = F.lit(None).cast("array<struct<title: string, hashtagName: string, name: string>>")
    no_extras = F.lit(None).cast("array<struct<hashtagName: string, tagName: string>>")
    return items.select(
        F.lit("tiktok").alias("platform"),
        _first_column(items, ("id", "video_id", "aweme_id"), empty).alias("content_id"),
        owner("creator_id", ("id", "uid")).alias("creator_id"),
        owner("creator_name", ("nickname", "uniqueId")).alias("creator_name"),
        owner("username", ("uniqueId", "username")).alias("username"),
        caption.alias("content_title"),
        caption.alias("caption"),
        extract_hashtags(
            F.col("challenges") if "challenges" in items.columns else no_challenges,
            F.col("textExtra") if "textExtra" in items.columns else no_extras,
            caption,
        ).alias("hashtags"),
        _first_column(items, ("createTime", "create_time"), empty).alias("publish_time"),
        count("playCount", "viewCount", "views").alias("view_count"),
        count("diggCount", "likeCount", "likes").alias("like_count"),
        count("commentCount", "comments").alias("comment_count"),
        count("shareCount", "shares").alias("share_count"),
        "collected_at",
    )


def seed_rows(channels: DataFrame, seq: str = "seq") -> DataFrame:
    """Seed list: the latest row per channel with its page address; sort by size when writing."""
    rows = dedupe_latest(channels, "channel_id", seq).drop("first_seq")
    address = F.concat(F.lit("https://www.youtube.com/channel/"), F.col("channel_id"))
    return rows.withColumn("channel_url", address)
