"""Engagement, activity, anomaly and trust formulas.

Two families live here and never mix: the batch rule (0-100, from engagement, sentiment and
activity) and the stream rule (anomaly-based).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .numeric import clamp, half_up, to_float

LABEL_SOURCE = "rule_generated_not_ground_truth"


def per_view(count: Column, views: Column) -> Column:
    return half_up(count / F.greatest(views, F.lit(1)).cast("double"), 6)


# --- batch rule ---------------------------------------------------------------------------


def is_suspicious_rule(engagement: Column, views: Column, comments: Column) -> Column:
    return F.when((engagement > 0.30) | ((views > 100_000) & (comments < 5)), 1).otherwise(0)


def activity_percent(interactions: Column) -> Column:
    """Share of a thousand interactions, as 0-100."""
    return F.least(interactions / F.lit(1000.0) * F.lit(100.0), F.lit(100.0))


def rule_trust(engagement: Column, sentiment: Column, activity: Column) -> Column:
    reach = F.least(engagement / F.lit(0.10), F.lit(1.0)) * F.lit(100.0)
    weighted = F.lit(0.5) * reach + F.lit(0.3) * sentiment + F.lit(0.2) * activity
    return half_up(clamp(weighted, 0.0, 100.0), 2)


def falsy_to(value: Column, default: float) -> Column:
    """Zero and missing both become the default."""
    return F.coalesce(F.nullif(value.cast("double"), F.lit(0.0)), F.lit(default))


# --- stream rule --------------------------------------------------------------------------


def weighted_engagement(likes: Column, comments: Column, shares: Column, views: Column) -> Column:
    weighted = likes + comments * F.lit(2.0) + shares * F.lit(3.0)
    return F.when(views > 0, clamp(weighted / F.nullif(views, F.lit(0).cast("double")))).otherwise(F.lit(0.0))


def activity_score(upload_frequency: Column, live_viewers: Column) -> Column:
    uploads = clamp(upload_frequency / F.lit(7.0))
    live = clamp(F.log10(live_viewers + F.lit(1.0)) / F.lit(5.0))
    return clamp(uploads * F.lit(0.75) + live * F.lit(0.25))


def stream_activity_score(upload_frequency: Column, live_viewers: Column) -> Column:
    """Only the total is clamped, as the stream has it."""
    uploads = upload_frequency / F.lit(7.0) * F.lit(0.75)
    return clamp(uploads + F.log10(live_viewers + F.lit(1.0)) / F.lit(5.0) * F.lit(0.25))


def anomaly_score(engagement: Column, growth: Column, spam: Column) -> Column:
    return clamp(
        clamp((growth - F.lit(0.15)) / F.lit(0.85)) * F.lit(0.35)
        + clamp((engagement - F.lit(0.25)) / F.lit(0.75)) * F.lit(0.25)
        + clamp(spam) * F.lit(0.40)
    )


def stream_anomaly_score(engagement: Column, growth: Column, spam: Column) -> Column:
    """Growth has no upper bound of its own in the stream."""
    zero = F.lit(0.0)
    return F.least(
        F.lit(1.0),
        F.greatest(zero, (growth - F.lit(0.15)) / F.lit(0.85)) * F.lit(0.35)
        + F.greatest(zero, (engagement - F.lit(0.25)) / F.lit(0.75)) * F.lit(0.25)
        + clamp(spam) * F.lit(0.40),
    )


def stream_trust(anomaly: Column, sentiment: Column, activity: Column) -> Column:
    return clamp(
        F.lit(0.50) * (F.lit(1.0) - anomaly) + F.lit(0.25) * sentiment + F.lit(0.25) * activity
    ) * F.lit(100.0)


def normalize_unit_score(value: Column, default: float | Column = 0.5) -> Column:
    """Scores above 1 are percentages."""
    score = to_float(value, default)
    return clamp(F.when(score > 1.0, score / F.lit(100.0)).otherwise(score))


def trust_label(score: Column) -> Column:
    return F.when(score >= 70, "high_trust").when(score >= 45, "medium_trust").otherwise("low_trust")


def risk_profile(score: Column) -> Column:
    return F.when(score >= 70, "trusted").when(score >= 45, "watch").otherwise("risky")


# --- dashboard and live signals -----------------------------------------------------------


def dashboard_risk(bot: Column, suspicious: Column, sentiment: Column, reputation: Column) -> Column:
    return clamp(
        bot * F.lit(0.4)
        + suspicious * F.lit(0.3)
        + (F.lit(1.0) - sentiment) * F.lit(0.2)
        + (F.lit(1.0) - reputation) * F.lit(0.1)
    )


def dashboard_label(risk: Column) -> Column:
    return F.when(risk >= 0.65, "risky").when(risk >= 0.38, "watch").otherwise("trusted")


def live_trust_signal(adjusted_risk: Column, sentiment: Column) -> Column:
    return (
        F.when((adjusted_risk > 0.35) | (sentiment < -0.18), "risky")
        .when((adjusted_risk > 0.18) | (sentiment < 0.05), "watch")
        .otherwise("trusted")
    )
