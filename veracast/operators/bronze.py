"""Raw rows -> clean, filtered, deduplicated tables per platform.

Every raw table carries `seq`, its input order. Results keep `first_seq` beside the contract
columns; `schemas` lists the columns that are written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import first_nonblank, safe_int
from ..functions.text import (
    category_mask,
    format_hashtags,
    joined_text,
    repair_mojibake,
    with_category,
)
from ..functions.timeparse import normalize_timestamp
from .keyed import dedupe_latest, present

#: Shown the groups of a deduplication, see `dedupe_latest`.
Watch = Callable[[DataFrame], DataFrame] | None


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def _own(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def latest_seed_keywords(seeds: DataFrame) -> DataFrame:
    """The last non-empty seed keyword per channel."""
    usable = seeds.where(present("channel_id") & present("seed_keyword"))
    return usable.groupBy("channel_id").agg(F.max_by("seed_keyword", "seq").alias("_seed"))


def build_youtube_channels(channels: DataFrame, seeds: DataFrame, watch: Watch = None) -> DataFrame:
    """Both sides of the seed join have one row per channel, so the join has no hot key."""
    latest = dedupe_latest(channels, "channel_id", watch=watch)
    rows = latest.join(latest_seed_keywords(seeds), "channel_id", "left")
    explicit = first_nonblank(F.coalesce(F.col("_seed"), _own(rows, "seed_keyword")), _own(rows, "category"))
    return with_category(rows, explicit, joined_text(F.col("channel_name"))).select(
        F.lit("youtube").alias("platform"),
        "channel_id",
        repair_mojibake(text_or_empty("channel_name")).alias("channel_name"),
        "category",
        safe_int(F.col("subscriber_count")).alias("subscriber_count"),
        safe_int(F.col("video_count")).alias("video_count"),
        safe_int(F.col("view_count")).alias("total_view_count"),
        text_or_empty("collected_at").alias("collected_at"),
        "first_seq",
    )


def build_youtube_videos(videos: DataFrame, watch: Watch = None) -> DataFrame:
    """Rows with an id and a positive view count, filtered before the last row per id is taken."""
    clean = videos.select(
        "video_id",
        F.lit("youtube").alias("platform"),
        text_or_empty("channel_id").alias("channel_id"),
        text_or_empty("channel_name").alias("channel_name"),
        text_or_empty("video_title").alias("title"),
        F.col("published_at"),
        safe_int(F.col("view_count")).alias("view_count"),
        safe_int(F.col("like_count")).alias("like_count"),
        safe_int(F.col("comment_count")).alias("comment_count"),
        safe_int(F.col("subscriber_count")).alias("subscriber_count"),
        safe_int(F.col("video_count")).alias("channel_video_count"),
        text_or_empty("collected_at").alias("collected_at"),
        "seq",
    )
    # Repair and timestamp parsing run on the surviving rows only.
    return dedupe_latest(clean, "video_id", kept=F.col("view_count") > 0, watch=watch).select(
        "platform",
        "channel_id",
        repair_mojibake(F.col("channel_name")).alias("channel_name"),
        "video_id",
        repair_mojibake(F.col("title")).alias("title"),
        normalize_timestamp(F.col("published_at")).alias("published_at"),
        "view_count",
        "like_count",
        "comment_count",
        "subscriber_count",
        "channel_video_count",
        "collected_at",
        "first_seq",
    )


def _tags_text(videos: DataFrame) -> Column:
    hashtags = F.col("hashtags")
    if not dict(videos.dtypes)["hashtags"].startswith("array"):
        return F.coalesce(hashtags, F.lit(""))
    quoted = F.array_join(F.transform(hashtags, lambda tag: F.concat(F.lit("'"), tag, F.lit("'"))), ", ")
    return F.when(hashtags.isNull(), "").otherwise(F.concat(F.lit("["), quoted, F.lit("]")))


def creator_text_masks(videos: DataFrame) -> DataFrame:
    """Per creator: the categories with a keyword in any video text, and the first video's text.

    The texts themselves are never gathered. A keyword cannot begin in one video's text and end
    in the next: each text ends in its tag list, or in a blank ahead of the joining blank. (Tags
    handed in as one text lack that closing mark; there, "street" and "fc" as a video's last tag
    are not joined with the next video's title.)
    """
    text = F.concat_ws(" ", text_or_empty("content_title"), text_or_empty("caption"), _tags_text(videos))
    texts = videos.where(present("creator_id")).select("creator_id", "seq", text.alias("_text"))
    masks = texts.withColumn("_lowered", F.lower("_text")).withColumn("_bits", category_mask(F.col("_lowered")))
    return masks.groupBy("creator_id").agg(
        F.bit_or("_bits").alias("_videos_mask"), F.min_by("_text", "seq").alias("_first_text")
    )


def build_tiktok_creators(creators: DataFrame, videos: DataFrame, watch: Watch = None) -> DataFrame:
    """The id falls back to the username. The category of a creator without one comes from the
    names and all video texts."""
    own_id = present("creator_id")
    keyed = creators.withColumn("_own_id", own_id).withColumn("creator_id", first_nonblank(F.col("creator_id"), F.col("username")))
    latest = dedupe_latest(keyed, "creator_id", watch=watch, own_id=F.col("_own_id"))
    rows = latest.join(creator_text_masks(videos), "creator_id", "left")
    names = joined_text(F.col("creator_name"), F.col("username"), F.col("_first_text"))
    return with_category(rows, F.col("category"), names, F.col("_videos_mask")).select(
        F.lit("tiktok").alias("platform"),
        "creator_id",
        repair_mojibake(text_or_empty("creator_name")).alias("creator_name"),
        text_or_empty("username").alias("username"),
        "category",
        safe_int(F.col("follower_count")).alias("follower_count"),
        safe_int(F.col("following_count")).alias("following_count"),
        safe_int(F.col("content_count")).alias("content_count"),
        text_or_empty("collected_at").alias("collected_at"),
        "first_seq",
    )


def build_tiktok_videos(videos: DataFrame, watch: Watch = None) -> DataFrame:
    is_list = dict(videos.dtypes)["hashtags"].startswith("array")
    clean = videos.select(
        "content_id",
        F.lit("tiktok").alias("platform"),
        text_or_empty("creator_id").alias("creator_id"),
        text_or_empty("creator_name").alias("creator_name"),
        text_or_empty("username").alias("username"),
        text_or_empty("content_title").alias("content_title"),
        "caption",
        "hashtags",
        "publish_time",
        safe_int(F.col("view_count")).alias("view_count"),
        safe_int(F.col("like_count")).alias("like_count"),
        safe_int(F.col("comment_count")).alias("comment_count"),
        safe_int(F.col("share_count")).alias("share_count"),
        text_or_empty("collected_at").alias("collected_at"),
        "seq",
    )
    caption = F.coalesce(first_nonblank(F.col("caption"), F.col("content_title")), F.lit(""))
    return dedupe_latest(clean, "content_id", kept=F.col("view_count") > 0, watch=watch).select(
        "platform",
        "content_id",
        "creator_id",
        repair_mojibake(F.col("creator_name")).alias("creator_name"),
        "username",
        repair_mojibake(F.col("content_title")).alias("content_title"),
        repair_mojibake(caption).alias("caption"),
        format_hashtags(F.col("hashtags"), F.col("caption"), F.col("content_title"), is_list).alias("hashtags"),
        normalize_timestamp(F.col("publish_time")).alias("publish_time"),
        "view_count",
        "like_count",
        "comment_count",
        "share_count",
        "collected_at",
        "first_seq",
    )
