"""Column contracts: raw inputs, tables of each layer, stream payload. Schemas are DDL text."""

from __future__ import annotations

# Field and column names of the contracts. Raw counts may be JSON numbers or numeric
# strings, so they are read as they are; the reader cuts off fractions of numbers.
RAW_YOUTUBE_CHANNELS = (
    "platform string, channel_id string, channel_name string, seed_keyword string, category string, "
    "subscriber_count variant, video_count variant, view_count variant, collected_at string"
)
RAW_YOUTUBE_SEEDS = (
    "seed_keyword string, platform string, channel_id string, channel_name string, subscriber_count variant, "
    "video_count variant, view_count variant, channel_url string, collected_at string"
)
RAW_YOUTUBE_VIDEOS = (
    "platform string, channel_id string, channel_name string, video_id string, video_title string, "
    "published_at string, view_count variant, like_count variant, comment_count variant, subscriber_count variant, "
    "video_count variant, collected_at string"
)
RAW_YOUTUBE_COMMENTS = (
    "platform string, channel_id string, video_id string, comment_id string, parent_comment_id string, "
    "is_reply boolean, comment_author_display_name string, comment_author_channel_id string, comment_text string, "
    "comment_text_is_hashed boolean, comment_like_count variant, comment_sentiment string, "
    "comment_sentiment_score double, comment_sentiment_source string, comment_published_at string, collected_at string"
)
RAW_TIKTOK_CREATORS = (
    "platform string, creator_id string, creator_name string, username string, category string, "
    "follower_count variant, following_count variant, content_count variant, collected_at string"
)
RAW_TIKTOK_VIDEOS = (
    "platform string, content_id string, creator_id string, creator_name string, username string, "
    "content_title string, caption string, hashtags array<string>, publish_time string, view_count variant, "
    "like_count variant, comment_count variant, share_count variant, collected_at string"
)

API_STATISTICS = (
    "struct<viewCount: string, likeCount: string, commentCount: string, subscriberCount: string, videoCount: string>"
)
API_ITEM = (
    "id string, snippet struct<title: string, channelId: string, channelTitle: string, publishedAt: string>, "
    f"statistics {API_STATISTICS}, collected_at string"
)
# authorChannelId is either a text or an object, so it is read as text.
COMMENT_SNIPPET = (
    "struct<textOriginal: string, textDisplay: string, authorDisplayName: string, authorChannelId: string, "
    "likeCount: string, publishedAt: string>"
)
COMMENT_THREAD = (
    "video_id string, channel_id string, collected_at string, "
    f"snippet struct<topLevelComment: struct<id: string, snippet: {COMMENT_SNIPPET}>>, "
    f"replies struct<comments: array<struct<id: string, snippet: {COMMENT_SNIPPET}>>>"
)

YOUTUBE_CHANNEL_COLUMNS = [
    "platform", "channel_id", "channel_name", "category", "subscriber_count", "video_count", "total_view_count",
    "collected_at",
]
YOUTUBE_VIDEO_COLUMNS = [
    "platform", "channel_id", "channel_name", "video_id", "title", "published_at", "view_count", "like_count",
    "comment_count", "subscriber_count", "channel_video_count", "collected_at",
]
TIKTOK_CREATOR_COLUMNS = [
    "platform", "creator_id", "creator_name", "username", "category", "follower_count", "following_count",
    "content_count", "collected_at",
]
TIKTOK_VIDEO_COLUMNS = [
    "platform", "content_id", "creator_id", "creator_name", "username", "content_title", "caption", "hashtags",
    "publish_time", "view_count", "like_count", "comment_count", "share_count", "collected_at",
]
UNIFIED_FEATURE_COLUMNS = [
    "platform", "creator_id", "creator_name", "content_id", "content_title", "publish_time", "follower_count",
    "content_count", "view_count", "like_count", "comment_count", "share_count", "engagement_rate", "likes_per_view",
    "comments_per_view", "shares_per_view", "sentiment_score", "sentiment_label", "positive_comment_count",
    "neutral_comment_count", "negative_comment_count", "upload_frequency", "follower_growth_rate", "activity_score",
    "trust_score", "is_suspicious", "label_source", "collected_at",
]
COMMENT_SENTIMENT_COLUMNS = [
    "platform", "creator_id", "content_id", "comment_id", "parent_comment_id", "is_reply",
    "comment_author_display_name", "comment_author_channel_id", "comment", "comment_text_is_hashed", "like_count",
    "sentiment", "sentiment_score", "sentiment_source", "comment_published_at", "collected_at",
]
ENGAGEMENT_FEATURE_COLUMNS = [
    "platform", "creator_id", "creator_name", "content_id", "view_count", "like_count", "comment_count",
    "share_count", "engagement_rate", "likes_per_view", "comments_per_view", "shares_per_view", "upload_frequency",
    "activity_score", "collected_at",
]
SUSPICIOUS_ENGAGEMENT_COLUMNS = [
    "platform", "creator_id", "creator_name", "content_id", "follower_count", "view_count", "like_count",
    "comment_count", "share_count", "engagement_rate", "likes_per_view", "comments_per_view", "shares_per_view",
    "is_suspicious", "label_source", "collected_at",
]
TRUST_SCORE_COLUMNS = [
    "rank", "platform", "creator_id", "creator_name", "follower_count", "content_count", "observed_content_count",
    "total_views", "avg_engagement_rate", "avg_sentiment_score", "avg_activity_score", "trust_score",
    "suspicious_content_count", "label_source", "collected_at",
]
CREATOR_PROFILE_COLUMNS = [
    "platform", "creator_id", "creator_name", "follower_count", "content_count", "observed_content_count",
    "total_views", "avg_engagement_rate", "avg_sentiment_score", "avg_activity_score", "collected_at",
]

# Counts are LONG: a 32-bit field would turn counts above 2^31 into NULL and then into 0.
STREAM_EVENT = (
    "kol_id string, kol_name string, channel_id string, channel_title string, channel string, platform string, "
    "source string, video_id string, timestamp string, crawled_at string, views bigint, view_count bigint, "
    "likes bigint, like_count bigint, comments bigint, comment_count bigint, shares bigint, followers bigint, "
    "subscriber_count bigint, upload_frequency_7d double, live_concurrent_viewers double, "
    "follower_growth_rate double, comment_spam_ratio double, text string"
)
STREAM_RECORD = ("value binary, topic string, partition int, offset bigint, timestamp timestamp")

SERVING_COLUMNS = [
    "kol_id", "event_ts", "kol_name", "platform", "video_id", "views", "likes", "comments", "shares", "followers",
    "engagement_rate", "sentiment_score", "activity_score", "anomaly_score", "trust_score", "is_suspicious",
    "processed_at",
]
RAW_LAKE_COLUMNS = [
    "raw_payload", "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp", "processed_at", "event_date",
]
SCORED_COLUMNS = RAW_LAKE_COLUMNS[:5] + SERVING_COLUMNS + ["event_date"]

LIVE_EVENT = (
    "struct<event_id: string, live_id: string, kol_id: string, platform: string, event_type: string, "
    "timestamp: string, user_id: string, value: string, sentiment_score: double, is_suspicious: boolean, "
    "metadata: map<string, string>>"
)
LIVE_BUNDLE = (
    "profile struct<kol_id: string, name: string, platform: string, category: string, followers: string, "
    "verified: boolean, reputation_score: double, risk_profile: string, default_mode: string>, "
    "metrics struct<live_id: string, kol_id: string, title: string, started_at: string, timestamp: string, "
    "viewers: string, likes: string, shares: string, comments: string, purchases: string, engagement_rate: double, "
    "sentiment_score: double, bot_probability: double, suspicious_spike: boolean, trust_signal: string>, "
    f"recent_events array<{LIVE_EVENT}>, model_features map<string, string>"
)

TRUST_NUMERIC_FEATURES = [
    "follower_count", "content_count", "view_count", "like_count", "comment_count", "share_count", "engagement_rate",
    "likes_per_view", "comments_per_view", "shares_per_view", "sentiment_score", "positive_comment_count",
    "neutral_comment_count", "negative_comment_count", "upload_frequency", "follower_growth_rate", "activity_score",
    "is_suspicious",
]
TRUST_CATEGORICAL_FEATURES = ["platform"]
