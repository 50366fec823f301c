"""Scoring of flat events: features, trust prediction and the scored row.

The same expressions serve batches and streams. A trained model is optional; without one, or
where it gives nothing, the rule score stands.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import score as S
from ..functions.numeric import clamp, first_nonblank, first_truthy_number, half_up, to_float
from ..functions.sentiment import with_unit_sentiment
from ..ml.sentiment import text_scores
from ..schemas import TRUST_CATEGORICAL_FEATURES, TRUST_NUMERIC_FEATURES

SUSPICIOUS_FROM = 0.55
LOW_TRUST_BELOW = 45.0


def optional(df: DataFrame, name: str) -> Column:
    """A column, or NULL where the input lacks it."""
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def _flag(value: Column, default: Column) -> Column:
    number = F.coalesce(value.try_cast("double"), F.when(default, 1.0).otherwise(0.0))
    return number != 0.0


def _counts(df: DataFrame) -> dict[str, Column]:
    def pick(*names: str) -> Column:
        return first_truthy_number(*[optional(df, name) for name in names])

    return {
        "_views": pick("views", "view_count"),
        "_likes": pick("likes", "like_count"),
        "_comments": pick("comments", "comment_count"),
        "_shares": pick("shares", "share_count"),
        "_followers": pick("followers", "follower_count", "subscriber_count"),
        "_growth": to_float(optional(df, "follower_growth_rate")),
        "_spam": to_float(optional(df, "comment_spam_ratio")),
        "_live": to_float(optional(df, "live_concurrent_viewers")),
    }


def _with_text_score(df: DataFrame, sentiment_model: PipelineModel | None) -> DataFrame:
    """`_text_score`: sentiment of the text, NULL where there is none."""
    text = first_nonblank(optional(df, "text"), optional(df, "comment"))
    staged = df.withColumn("_text", text)
    if sentiment_model is not None:
        staged = text_scores(staged, "_text", "_text_score", sentiment_model)
    else:
        staged = with_unit_sentiment(staged, F.col("_text"), "_text_score")
    return staged.withColumn("_text_score", F.when(F.col("_text").isNotNull(), F.col("_text_score")))


def _percent(score: Column) -> Column:
    return F.when(score <= 1.0, score * F.lit(100.0)).otherwise(score)


def trust_features(staged: DataFrame) -> dict[str, Column]:
    """The feature vector of the trust model, from staged `_` columns."""
    views = F.col("_views")

    def ratio(count: str) -> Column:
        return F.when(views > 0, F.col(count) / F.nullif(views, F.lit(0.0))).otherwise(F.lit(0.0))

    def number(*names: str) -> Column:
        return first_truthy_number(*[optional(staged, name) for name in names])

    uploads = F.coalesce(
        F.nullif(to_float(optional(staged, "upload_frequency")), F.lit(0.0)),
        to_float(optional(staged, "upload_frequency_7d"), 2.0),
    )
    return {
        "platform": F.coalesce(
            first_nonblank(optional(staged, "platform"), optional(staged, "source")), F.lit("youtube")
        ),
        "follower_count": F.col("_followers"),
        "content_count": number("content_count", "channel_video_count", "video_count"),
        "view_count": views,
        "like_count": F.col("_likes"),
        "comment_count": F.col("_comments"),
        "share_count": F.col("_shares"),
        "engagement_rate": F.col("_engagement"),
        "likes_per_view": ratio("_likes"),
        "comments_per_view": ratio("_comments"),
        "shares_per_view": ratio("_shares"),
        "sentiment_score": _percent(F.col("_sentiment")),
        "positive_comment_count": to_float(optional(staged, "positive_comment_count")),
        "neutral_comment_count": to_float(optional(staged, "neutral_comment_count")),
        "negative_comment_count": to_float(optional(staged, "negative_comment_count")),
        "upload_frequency": uploads,
        "follower_growth_rate": F.col("_growth"),
        "activity_score": _percent(F.col("_activity")),
        "is_suspicious": F.col("_suspicious").cast("double"),
    }


def _score(staged: DataFrame, trust_model: PipelineModel | None) -> DataFrame:
    """Adds `_score` and `_source` to staged rows."""
    rule = S.stream_trust(F.col("_anomaly"), F.col("_sentiment"), F.col("_activity"))
    if trust_model is None:
        return staged.withColumn("_score", rule).withColumn("_source", F.lit("rule_fallback"))
    wanted = trust_features(staged)
    names = TRUST_NUMERIC_FEATURES + TRUST_CATEGORICAL_FEATURES
    packed = staged.select(
        F.struct(*[F.col(f"`{name}`") for name in staged.columns]).alias("_in"),
        rule.alias("_rule"),
        *[wanted[name].alias(name) for name in names],
    )
    predicted = clamp(F.nanvl(F.col("prediction"), F.lit(None).cast("double")), 0.0, 100.0)
    known = F.col("prediction").isNotNull() & ~F.isnan("prediction")
    return trust_model.transform(packed).select(
        "_in.*",
        F.when(known, predicted).otherwise(F.col("_rule")).alias("_score"),
        F.when(known, "trained_model").otherwise("rule_fallback").alias("_source"),
    )


def _predicted() -> dict[str, Column]:
    return {
        "trust_score": half_up(F.col("_score"), 2),
        "trust_label": S.trust_label(F.col("_score")),
        "trust_source": F.col("_source"),
        "engagement_rate": half_up(F.col("_engagement"), 6),
        "sentiment_score": half_up(F.col("_sentiment"), 6),
        "activity_score": half_up(F.col("_activity"), 6),
        "anomaly_score": half_up(F.col("_anomaly"), 6),
        "is_suspicious": F.col("_suspicious") | (F.col("_score") < LOW_TRUST_BELOW),
    }


def predict_trust(
    events: DataFrame,
    prefix: str = "pred_",
    trust_model: PipelineModel | None = None,
    sentiment_model: PipelineModel | None = None,
) -> DataFrame:
    """The input columns and eight prediction columns."""
    staged = _with_text_score(events, sentiment_model).withColumns(_counts(events))
    uploads = F.coalesce(
        F.nullif(to_float(optional(events, "upload_frequency_7d")), F.lit(0.0)),
        to_float(optional(events, "upload_frequency"), 2.0),
    )
    engagement = S.weighted_engagement(F.col("_likes"), F.col("_comments"), F.col("_shares"), F.col("_views"))
    staged = (
        staged.withColumn("_engagement", to_float(optional(events, "engagement_rate"), engagement))
        .withColumn(
            "_sentiment", F.coalesce("_text_score", S.normalize_unit_score(optional(events, "sentiment_score"), 0.5))
        )
        .withColumn(
            "_activity",
            S.normalize_unit_score(optional(events, "activity_score"), S.activity_score(uploads, F.col("_live"))),
        )
        .withColumn("_anomaly", S.anomaly_score(F.col("_engagement"), F.col("_growth"), F.col("_spam")))
        .withColumn("_suspicious", _flag(optional(events, "is_suspicious"), F.col("_anomaly") >= SUSPICIOUS_FROM))
    )
    scored = _score(staged, trust_model)
    return scored.select(*events.columns, *[column.alias(prefix + name) for name, column in _predicted().items()])


def score_events(
    events: DataFrame,
    trust_model: PipelineModel | None = None,
    sentiment_model: PipelineModel | None = None,
) -> DataFrame:
    """The 18-column scored row of each event. Engagement and activity are always recomputed; the
    sentiment of events without text is taken as it comes and passed on as a percentage."""
    return _scored_rows(events, trust_model, sentiment_model)


def _scored_rows(
    events: DataFrame, trust_model: PipelineModel | None = None, sentiment_model: PipelineModel | None = None, *more: str
) -> DataFrame:
    """The scored rows, with columns of the events in `more` beside them."""
    staged = _with_text_score(events, sentiment_model).withColumns(_counts(events))
    uploads = to_float(optional(events, "upload_frequency_7d"), 2.0)
    own = F.coalesce(F.col("_text_score"), to_float(optional(events, "sentiment_score"), 0.5))
    engagement = S.weighted_engagement(F.col("_likes"), F.col("_comments"), F.col("_shares"), F.col("_views"))
    staged = (
        staged.withColumn("_engagement", engagement)
        .withColumn("_own_sentiment", own)
        .withColumn(
            "_sentiment",
            F.coalesce(F.col("_text_score"), S.normalize_unit_score(F.col("_own_sentiment") * F.lit(100.0))),
        )
        .withColumn("_own_activity", S.activity_score(uploads, F.col("_live")))
        .withColumn("_activity", S.normalize_unit_score(F.col("_own_activity") * F.lit(100.0)))
        .withColumn("_anomaly", S.anomaly_score(F.col("_engagement"), F.col("_growth"), F.col("_spam")))
        .withColumn("_suspicious", F.col("_anomaly") >= SUSPICIOUS_FROM)
    )
    predicted = _predicted()

    def text(*names: str, default: str) -> Column:
        return F.coalesce(first_nonblank(*[optional(events, name) for name in names]), F.lit(default))

    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")
    stamp = F.coalesce(first_nonblank(optional(events, "timestamp"), optional(events, "crawled_at")), now)
    return _score(staged, trust_model).select(
        text("kol_id", "channel_id", "channel", default="unknown").alias("kol_id"),
        text("kol_name", "channel_title", "channel", default="Unknown KOL").alias("kol_name"),
        text("platform", "source", default="youtube").alias("platform"),
        text("video_id", default="").alias("video_id"),
        stamp.alias("timestamp"),
        F.col("_views").cast("bigint").alias("views"),
        F.col("_likes").cast("bigint").alias("likes"),
        F.col("_comments").cast("bigint").alias("comments"),
        F.col("_shares").cast("bigint").alias("shares"),
        F.col("_followers").cast("bigint").alias("followers"),
        predicted["engagement_rate"].alias("engagement_rate"),
        half_up(F.col("_own_sentiment"), 6).alias("sentiment_score"),
        half_up(F.col("_own_activity"), 6).alias("activity_score"),
        predicted["anomaly_score"].alias("anomaly_score"),
        predicted["trust_score"].alias("trust_score"),
        predicted["trust_label"].alias("trust_label"),
        predicted["trust_source"].alias("trust_source"),
        predicted["is_suspicious"].alias("is_suspicious"),
        *more,
    )


def features_to_events(features: DataFrame) -> DataFrame:
    """Unified feature rows in the shape of events; the title serves as text."""
    return features.select(*event_columns())


def event_columns() -> list[Column | str]:
    return [
        F.col("creator_id").alias("kol_id"),
        F.col("creator_name").alias("kol_name"),
        "platform",
        F.col("content_id").alias("video_id"),
        first_nonblank(F.col("publish_time"), F.col("collected_at")).alias("timestamp"),
        F.col("view_count").alias("views"),
        F.col("like_count").alias("likes"),
        F.col("comment_count").alias("comments"),
        F.col("share_count").alias("shares"),
        F.col("follower_count").alias("followers"),
        "content_count",
        "engagement_rate",
        "sentiment_score",
        "positive_comment_count",
        "neutral_comment_count",
        "negative_comment_count",
        F.col("upload_frequency").alias("upload_frequency_7d"),
        "follower_growth_rate",
        "activity_score",
        "is_suspicious",
        F.col("content_title").alias("text"),
    ]


def scores_from_events(events: DataFrame) -> DataFrame:
    """Processed events in the shape of scored rows, in one pass; events without a trust score are scored."""
    if "trust_score" not in events.columns:
        return score_events(events)
    has_score = optional(events, "trust_score").isNotNull()
    score = to_float(optional(events, "trust_score"))

    def text(*names: str, default: str) -> Column:
        return F.coalesce(first_nonblank(*[optional(events, name) for name in names]), F.lit(default))

    def count(*names: str) -> Column:
        return first_truthy_number(*[optional(events, name) for name in names]).cast("bigint")

    def number(*names: str, default: float = 0.0) -> Column:
        known = [F.nullif(to_float(optional(events, name)), F.lit(0.0)) for name in names]
        return F.coalesce(*known, to_float(optional(events, names[-1]), default))

    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")
    stamp = first_nonblank(*[optional(events, name) for name in ("timestamp", "collected_at", "crawled_at")])
    label = first_nonblank(optional(events, "trust_label"), optional(events, "risk_profile"))
    carried = F.struct(
        text("kol_id", "channel_id", "creator_id", "channel", default="unknown").alias("kol_id"),
        text("kol_name", "channel_name", "channel_title", "creator_name", default="Unknown KOL").alias("kol_name"),
        text("platform", "source", default="youtube").alias("platform"),
        text("video_id", "content_id", default="").alias("video_id"),
        F.coalesce(stamp, now).alias("timestamp"),
        count("views", "view_count").alias("views"),
        count("likes", "like_count").alias("likes"),
        count("comments", "comment_count").alias("comments"),
        count("shares", "share_count").alias("shares"),
        count("followers", "follower_count", "subscribers", "subscriber_count").alias("followers"),
        number("engagement_rate", "avg_engagement_rate").alias("engagement_rate"),
        number("sentiment_score", "avg_sentiment_score", default=0.5).alias("sentiment_score"),
        number("activity_score", "avg_activity_score").alias("activity_score"),
        number("anomaly_score").alias("anomaly_score"),
        half_up(score, 2).alias("trust_score"),
        F.coalesce(label, S.trust_label(score)).alias("trust_label"),
        text("trust_source", "label_source", default="processed_dataset").alias("trust_source"),
        (number("is_suspicious", "suspicious_content_count") != 0.0).alias("is_suspicious"),
    )
    scored = _scored_rows(events.withColumn("_known", F.when(has_score, carried)), None, None, "_known")
    known = F.col("_known").isNotNull()
    names = [name for name in scored.columns if name != "_known"]
    return scored.select(*[F.when(known, F.col(f"_known.{name}")).otherwise(F.col(name)).alias(name) for name in names])


def scores_from_leaderboard(trust_scores: DataFrame) -> DataFrame:
    """Leaderboard rows in the shape of scored rows."""
    score = to_float(F.col("trust_score"))
    zero = F.lit(0).cast("bigint")
    return trust_scores.select(
        F.coalesce(first_nonblank(F.col("creator_id")), F.lit("unknown")).alias("kol_id"),
        F.coalesce(first_nonblank(F.col("creator_name"), F.col("creator_id")), F.lit("Unknown KOL")).alias("kol_name"),
        F.coalesce(first_nonblank(F.col("platform")), F.lit("unknown")).alias("platform"),
        F.lit("").alias("video_id"),
        F.col("collected_at").alias("timestamp"),
        to_float(F.col("total_views")).cast("bigint").alias("views"),
        zero.alias("likes"),
        zero.alias("comments"),
        zero.alias("shares"),
        to_float(F.col("follower_count")).cast("bigint").alias("followers"),
        to_float(F.col("avg_engagement_rate")).alias("engagement_rate"),
        to_float(F.col("avg_sentiment_score"), 0.5).alias("sentiment_score"),
        to_float(F.col("avg_activity_score")).alias("activity_score"),
        F.lit(0.0).alias("anomaly_score"),
        half_up(score, 2).alias("trust_score"),
        S.trust_label(score).alias("trust_label"),
        F.coalesce(first_nonblank(F.col("label_source")), F.lit("processed_dataset")).alias("trust_source"),
        (to_float(F.col("suspicious_content_count")) > 0).alias("is_suspicious"),
    )
