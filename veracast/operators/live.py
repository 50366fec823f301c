"""Live-session metrics over the newest events of each creator, and the stream event of a bundle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import first_nonblank, half_up, safe_int, to_float, to_units
from ..functions.score import live_trust_signal
from .keyed import last_n

METRIC_EVENTS = 180
FEATURE_EVENTS = 260


def live_window_stats(events: DataFrame) -> DataFrame:
    """Counts over the newest 180 and 260 events per creator, from one last-N pass."""
    newest = last_n(events, ["kol_id"], [F.desc("timestamp"), F.desc("event_id")], FEATURE_EVENTS)
    return window_counts(newest)


def window_counts(newest: DataFrame) -> DataFrame:
    metric = F.col("recency") <= METRIC_EVENTS
    comment = F.col("event_type") == "comment"
    scored = comment & F.col("sentiment_score").isNotNull()
    suspicious = F.coalesce(F.col("is_suspicious"), F.lit(False))
    units = to_units(F.col("sentiment_score"), 6)
    return newest.groupBy("kol_id").agg(
        F.count_if(metric).alias("metric_events"),
        F.count_if(metric & suspicious).alias("metric_suspicious"),
        F.count_if(metric & scored).alias("metric_comments"),
        F.coalesce(F.sum(F.when(metric & scored, units)), F.lit(0)).alias("metric_sentiment"),
        F.count(F.lit(1)).alias("feature_events"),
        F.count_if(suspicious).alias("feature_suspicious"),
        F.count_if(comment).alias("feature_comments"),
        F.coalesce(F.sum(F.when(scored, units)), F.lit(0)).alias("feature_sentiment"),
        # At most FEATURE_EVENTS users per creator are in the window; those without an id are one.
        (F.size(F.collect_set("user_id")) + F.max(F.col("user_id").isNull().cast("int"))).alias("feature_users"),
    )


def _mean_units(total: str, count: str) -> Column:
    return F.col(total) / (F.greatest(F.col(count), F.lit(1)) * F.lit(1e6))


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1)).cast("double")


def _measured(stats: DataFrame, sessions: DataFrame) -> DataFrame:
    """Sessions with their window measures; both sides have one row per creator."""
    counted = [name for name in stats.columns if name != "kol_id"]
    joined = sessions.join(stats, "kol_id", "left").fillna(0, subset=counted)
    total = F.col("likes") + F.col("comments") + F.col("shares")
    return (
        joined.withColumn("_sentiment", _mean_units("metric_sentiment", "metric_comments"))
        .withColumn("_engagement", half_up(total / F.greatest("followers", F.lit(1)).cast("double"), 5))
        .withColumn(
            "_risk",
            _share("metric_suspicious", "metric_events") + (F.lit(1.0) - F.col("reputation_score")) * F.lit(0.28),
        )
        .withColumn("_bot", half_up(F.least(F.lit(0.98), F.col("_risk") * F.lit(1.65)), 4))
        .withColumn("_signal", live_trust_signal(F.col("_risk"), F.col("_sentiment")))
    )


def _known(sessions: DataFrame, *names: str) -> list[str]:
    """What a session says about itself beside its totals, as far as it does."""
    return [name for name in names if name in sessions.columns]


def live_metrics(stats: DataFrame, sessions: DataFrame) -> DataFrame:
    return _measured(stats, sessions).select(
        "live_id",
        "kol_id",
        *_known(sessions, "title", "started_at"),
        "viewers",
        "likes",
        "shares",
        "comments",
        "purchases",
        F.col("_engagement").alias("engagement_rate"),
        half_up(F.col("_sentiment"), 4).alias("sentiment_score"),
        F.col("_bot").alias("bot_probability"),
        (F.col("_risk") > 0.28).alias("suspicious_spike"),
        F.col("_signal").alias("trust_signal"),
        "timestamp",
    )


def live_model_features(stats: DataFrame, sessions: DataFrame) -> DataFrame:
    activity = F.col("viewers") / F.lit(8000.0) + F.col("_engagement")
    return _measured(stats, sessions).select(
        "kol_id",
        F.col("name").alias("kol_name"),
        "platform",
        *_known(sessions, "category"),
        "followers",
        "verified",
        F.col("reputation_score").alias("profile_reputation_score"),
        F.col("risk_profile").alias("profile_risk_label"),
        "live_id",
        F.col("viewers").alias("viewer_count"),
        F.col("likes").alias("like_count"),
        F.col("shares").alias("share_count"),
        F.col("comments").alias("comment_count"),
        F.col("purchases").alias("purchase_count"),
        F.col("_engagement").alias("engagement_rate"),
        half_up(F.col("_sentiment"), 4).alias("sentiment_score"),
        F.col("_bot").alias("bot_probability"),
        half_up(_share("feature_suspicious", "feature_events"), 4).alias("suspicious_event_ratio"),
        half_up(_share("feature_users", "feature_events"), 4).alias("unique_user_ratio"),
        half_up(_mean_units("feature_sentiment", "feature_comments"), 4).alias("avg_comment_sentiment"),
        half_up(F.least(F.lit(1.0), activity), 4).alias("activity_score"),
        (F.col("_risk") > 0.28).alias("is_suspicious"),
        F.col("_signal").alias("trust_label"),
        "timestamp",
    )


def bundles_to_events(bundles: DataFrame, now: Column | None = None) -> DataFrame:
    """Nested live bundle -> flat stream event; the text is the last 20 comments."""
    now = F.current_timestamp() if now is None else now

    def feature(name: str) -> Column:
        return F.element_at("model_features", name)

    def text(*values: Column, default: str) -> Column:
        return F.coalesce(first_nonblank(*values), F.lit(default))

    def count(*values: Column) -> Column:
        return F.coalesce(*[F.nullif(safe_int(value), F.lit(0).cast("bigint")) for value in values], F.lit(0))

    comments = F.transform(
        F.filter(
            F.coalesce("recent_events", F.array().cast(bundles.schema["recent_events"].dataType)),
            lambda event: (event["event_type"] == "comment") & event["value"].isNotNull(),
        ),
        lambda event: event["value"],
    )
    kol_id = text(F.col("profile.kol_id"), F.col("metrics.kol_id"), feature("kol_id"), default="unknown")
    name = text(F.col("profile.name"), feature("kol_name"), default="Unknown KOL")
    views = count(F.col("metrics.viewers"), feature("viewer_count"))
    activity = F.coalesce(F.nullif(to_float(feature("activity_score")), F.lit(0.0)), F.lit(0.3))
    tail = F.slice(comments, F.greatest(F.size(comments) - F.lit(19), F.lit(1)), F.lit(20))
    return bundles.select(
        F.concat(
            F.lit("sim_"), F.coalesce("metrics.live_id", F.lit("live")), F.lit("_"), F.unix_millis(now).cast("string")
        ).alias("event_id"),
        kol_id.alias("kol_id"),
        name.alias("kol_name"),
        kol_id.alias("channel_id"),
        name.alias("channel_title"),
        text(F.col("profile.platform"), feature("platform"), default="youtube").alias("platform"),
        F.lit("simulator").alias("source"),
        text(F.col("metrics.live_id"), feature("live_id"), default="").alias("video_id"),
        F.coalesce(first_nonblank(F.col("metrics.timestamp"), feature("timestamp")), now.cast("string")).alias(
            "timestamp"
        ),
        views.alias("views"),
        count(F.col("metrics.likes"), feature("like_count")).alias("likes"),
        count(F.col("metrics.comments"), feature("comment_count")).alias("comments"),
        count(F.col("metrics.shares"), feature("share_count")).alias("shares"),
        count(F.col("profile.followers"), feature("followers")).alias("followers"),
        half_up(activity * F.lit(7.0), 4).alias("upload_frequency_7d"),
        views.cast("double").alias("live_concurrent_viewers"),
        to_float(feature("bot_probability")).alias("follower_growth_rate"),
        to_float(feature("suspicious_event_ratio")).alias("comment_spam_ratio"),
        F.array_join(tail, " ").alias("text"),
    )
