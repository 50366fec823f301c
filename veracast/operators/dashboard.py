"""Per-creator live summary and the figures shown over it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.numeric import half_up, to_units
from ..functions.score import dashboard_label, dashboard_risk, falsy_to, trust_label

def live_summary(scores: DataFrame) -> DataFrame:
    """One row per creator from all its scored rows: measures of the latest one (the largest video id
    of several), event and suspicious counts, risk and the trust figure derived from it."""
    values = ["kol_name", "platform", "followers", "views", "comments", "anomaly_score", "sentiment_score",
              "trust_score", "is_suspicious", "event_ts"]
    latest = scores.groupBy("kol_id").agg(
        F.max_by(F.struct(*values), F.struct("event_ts", "video_id")).alias("_row"),
        F.count(F.lit(1)).alias("events"),
        F.count_if("is_suspicious").alias("suspicious_events"),
    )
    bot = F.coalesce("_row.anomaly_score", F.lit(0.0))
    sentiment = falsy_to(F.col("_row.sentiment_score"), 0.5)
    risk = dashboard_risk(bot, bot, sentiment, F.lit(0.5))
    return latest.select(
        "kol_id",
        F.col("_row.kol_name").alias("name"),
        F.col("_row.platform").alias("platform"),
        F.coalesce("_row.followers", F.lit(0)).alias("followers"),
        F.coalesce("_row.views", F.lit(0)).alias("viewers"),
        F.coalesce("_row.comments", F.lit(0)).alias("comments"),
        "events",
        "suspicious_events",
        half_up((F.lit(1.0) - risk) * F.lit(100.0), 1).alias("trust_score"),
        half_up(risk, 4).alias("risk_score"),
        trust_label(F.col("_row.trust_score")).alias("trust_signal"),
        dashboard_label(risk).alias("risk_label"),
        sentiment.alias("sentiment_score"),
        bot.alias("bot_probability"),
        bot.alias("suspicious_event_ratio"),
        F.coalesce("_row.is_suspicious", F.lit(False)).alias("suspicious_spike"),
        F.col("_row.event_ts").alias("timestamp"),
    )


def overview_kpis(summary: DataFrame) -> DataFrame:
    mean_trust = F.sum(to_units(F.col("trust_score"), 1)) / (F.greatest(F.count(F.lit(1)), F.lit(1)) * F.lit(10.0))
    return summary.agg(
        F.count(F.lit(1)).alias("creators"),
        F.coalesce(F.sum("events"), F.lit(0)).alias("events"),
        F.coalesce(F.sum("comments"), F.lit(0)).alias("comments"),
        F.coalesce(half_up(mean_trust, 4), F.lit(0.0)).alias("mean_trust"),
    )


def trust_distribution(summary: DataFrame) -> DataFrame:
    score = F.col("trust_score")
    return summary.agg(
        F.count_if(score >= 70).alias("high"),
        F.count_if((score < 70) & (score >= 45)).alias("watch"),
        F.count_if(score < 45).alias("risky"),
    )


def sentiment_distribution(rows: DataFrame) -> DataFrame:
    score = F.col("sentiment_score")
    positive, negative = F.count_if(score > 0.6), F.count_if(score < 0.4)
    return rows.agg(
        positive.alias("positive"),
        (F.count(score) - positive - negative).alias("neutral"),
        negative.alias("negative"),
    )


def event_type_mix(events: DataFrame) -> DataFrame:
    kind = F.coalesce("event_type", F.lit("unknown"))
    return events.groupBy(kind.alias("event_type")).agg(F.count(F.lit(1)).alias("events"))


def anomaly_totals(summary: DataFrame) -> DataFrame:
    """Three totals, each the larger of an estimate and the count of suspicious events."""
    shown = F.greatest("events", F.lit(1))

    def estimate(name: str):
        total = F.sum(to_units(F.coalesce(name, F.lit(0.0)), 6) * shown)
        return F.coalesce(F.call_function("div", total, F.lit(1_000_000)), F.lit(0))

    def half(name: str):
        return F.call_function("div", F.col(name), F.lit(2))

    totals = summary.agg(
        estimate("bot_probability").alias("_bots"),
        estimate("suspicious_event_ratio").alias("_engagement"),
        F.coalesce(F.sum("suspicious_events"), F.lit(0)).alias("_suspicious"),
    )
    return totals.select(
        F.greatest("_bots", "_suspicious").alias("fake_followers"),
        F.greatest(F.col("_engagement"), half("_suspicious")).alias("fake_engagement"),
        F.greatest(F.col("_suspicious"), half("_engagement")).alias("bot_comments"),
    )


def latest_tick(events: DataFrame, time_col: str = "timestamp") -> DataFrame:
    return events.agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if("is_suspicious").alias("suspicious_events"),
        F.max(time_col).alias("latest_tick"),
    )


def ranking_table(summary: DataFrame, limit: int = 5) -> DataFrame:
    """The best creators by trust; `limit` rows, numbered."""
    return _numbered(summary, "trust_score", limit).select("rank", "kol_id", "name", "trust_score", "risk_score")


def sentiment_top(summary: DataFrame, limit: int = 10) -> DataFrame:
    return _numbered(summary, "sentiment_score", limit).select("rank", "kol_id", "name", "sentiment_score")


def _numbered(summary: DataFrame, score: str, limit: int) -> DataFrame:
    top = summary.orderBy(F.desc(score), "kol_id").limit(limit)
    # Only the `limit` rows of the report are numbered.
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(score), "kol_id")))


def comment_events(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") == "comment")
