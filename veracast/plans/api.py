"""Read queries over scored rows, features and leaderboards.

`scores` has the serving columns: one row per creator and event time. Limits are the callers'
report sizes; what they cut is always taken from the fully ranked or time-ordered rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import half_up
from ..functions.score import falsy_to, risk_profile, trust_label
from ..functions.timeparse import parse_timestamp
from ..operators.keyed import first_non_empty, last_n, latest_per_key
from ..schemas import SERVING_COLUMNS
from .scoring import event_columns, features_to_events, score_events, scores_from_events, scores_from_leaderboard


def _labelled(scores: DataFrame) -> DataFrame:
    return scores.withColumn("trust_label", trust_label(F.col("trust_score"))).withColumn(
        "trust_source", F.lit("spark_streaming")
    )


def latest_per_creator(scores: DataFrame) -> DataFrame:
    """The newest scored row per creator; video id breaks ties of time."""
    return latest_per_key(scores, ["kol_id"], [F.col("event_ts"), F.col("video_id")])


def latest_scores(scores: DataFrame, limit: int = 50) -> DataFrame:
    newest = _labelled(latest_per_creator(scores))
    return newest.orderBy(F.desc("trust_score"), F.desc("event_ts"), "kol_id").limit(limit)


def top_creators(scores: DataFrame, limit: int = 10) -> DataFrame:
    return latest_scores(scores, limit)


def available_scores(scores: DataFrame, leaderboard: DataFrame, events: DataFrame | Callable[[], DataFrame]) -> DataFrame:
    """The first source that has rows: the scored store, else the leaderboard, else processed events, which
    a function may plan when they are needed. All read queries of this module take the result."""
    names = [name for name in SERVING_COLUMNS if name != "processed_at"]

    def served(rows: DataFrame) -> DataFrame:
        return rows.withColumn("event_ts", parse_timestamp(F.col("timestamp"))).select(*names)

    def from_events() -> DataFrame:
        return served(scores_from_events(events() if callable(events) else events))

    return first_non_empty(scores.select(*names), served(scores_from_leaderboard(leaderboard)), from_events)


def creator_directory(scores: DataFrame) -> DataFrame:
    """All creators with reputation and risk; `directory_by_reputation` sorts them."""
    return latest_per_creator(scores).select(*_directory_columns())


def _directory_columns() -> list[Column | str]:
    """Directory columns of a creator's latest scored row."""
    score = F.coalesce("trust_score", F.lit(0.0))
    return [
        "kol_id",
        F.coalesce(F.nullif("kol_name", F.lit("")), F.col("kol_id")).alias("name"),
        F.coalesce(F.nullif("platform", F.lit("")), F.lit("unknown")).alias("platform"),
        F.coalesce("followers", F.lit(0)).alias("followers"),
        (score >= 70).alias("verified"),
        half_up(score / F.lit(100.0), 4).alias("reputation_score"),
        risk_profile(score).alias("risk_profile"),
        F.lit("normal").alias("default_mode"),
    ]


def directory_by_reputation(directory: DataFrame) -> DataFrame:
    return directory.orderBy(F.desc("reputation_score"), "kol_id")


def directory_from_top(top: DataFrame) -> DataFrame:
    """Ranking rows in the shape of directory rows."""
    return top.select(
        "kol_id",
        F.coalesce("kol_name", "kol_id").alias("name"),
        "platform",
        "followers",
        F.col("trust_label").alias("risk_profile"),
        (F.col("trust_score") / F.lit(100.0)).alias("reputation_score"),
    )


def of_creator(scores: DataFrame, kol_id: str) -> DataFrame:
    return scores.where(F.col("kol_id") == kol_id)


def newest_of_creator(scores: DataFrame, kol_id: str, limit: int) -> DataFrame:
    """The newest `limit` rows of one creator: a filter pushed to the files and a top-N."""
    return of_creator(scores, kol_id).orderBy(F.desc("event_ts"), "video_id").limit(limit)


def timeseries(scores: DataFrame, kol_id: str, limit: int = 100) -> DataFrame:
    return newest_of_creator(scores, kol_id, limit).orderBy("event_ts", F.desc("video_id"))


def all_timeseries(scores: DataFrame, limit: int = 24) -> DataFrame:
    """The newest `limit` rows of every creator."""
    return last_n(scores, ["kol_id"], [F.desc("event_ts"), F.col("video_id")], limit)


def _known(spark_df: DataFrame, kol_id: str, found: DataFrame) -> DataFrame:
    """One row for the asked creator, found or not."""
    asked = spark_df.sparkSession.range(1).select(F.lit(kol_id).alias("kol_id"))
    return asked.join(F.broadcast(found.limit(1)), "kol_id", "left")


def profile(scores: DataFrame, kol_id: str) -> DataFrame:
    row = _known(scores, kol_id, creator_directory(of_creator(scores, kol_id)))
    return row.select(
        "kol_id",
        F.coalesce("name", "kol_id").alias("name"),
        F.coalesce("platform", F.lit("unknown")).alias("platform"),
        F.coalesce("followers", F.lit(0)).alias("followers"),
        F.coalesce("verified", F.lit(False)).alias("verified"),
        F.coalesce("reputation_score", F.lit(0.0)).alias("reputation_score"),
        F.coalesce("risk_profile", F.lit("unknown")).alias("risk_profile"),
        F.coalesce("default_mode", F.lit("normal")).alias("default_mode"),
    )


def _zero(name: str) -> Column:
    return F.coalesce(name, F.lit(0))


def metrics_of(latest: DataFrame) -> DataFrame:
    """Metric rows of latest scored rows."""
    return latest.select(*_metric_columns())


def _metric_columns() -> list[Column | str]:
    return [
        F.concat(F.lit("spark_"), "kol_id").alias("live_id"),
        "kol_id",
        F.concat(F.lit("Realtime trust evaluation for "), F.coalesce("kol_name", "kol_id")).alias("title"),
        F.col("event_ts").alias("started_at"),
        F.col("event_ts").alias("timestamp"),
        _zero("views").alias("viewers"),
        _zero("likes").alias("likes"),
        _zero("shares").alias("shares"),
        _zero("comments").alias("comments"),
        F.lit(0).cast("bigint").alias("purchases"),
        F.coalesce("engagement_rate", F.lit(0.0)).alias("engagement_rate"),
        falsy_to(F.col("sentiment_score"), 0.5).alias("sentiment_score"),
        F.coalesce("anomaly_score", F.lit(0.0)).alias("bot_probability"),
        F.coalesce("is_suspicious", F.lit(False)).alias("suspicious_spike"),
        trust_label(F.coalesce("trust_score", F.lit(0.0))).alias("trust_signal"),
    ]


def metrics(scores: DataFrame, kol_id: str) -> DataFrame:
    return metrics_of(newest_of_creator(scores, kol_id, 1))


def features_of(latest: DataFrame) -> DataFrame:
    """Feature rows of latest scored rows."""
    return latest.select(*_feature_columns())


def _feature_columns() -> list[Column | str]:
    anomaly = F.coalesce("anomaly_score", F.lit(0.0))
    return [
        "kol_id",
        "kol_name",
        "platform",
        _zero("views").alias("viewer_count"),
        _zero("likes").alias("like_count"),
        _zero("shares").alias("share_count"),
        _zero("comments").alias("comment_count"),
        _zero("followers").alias("followers"),
        F.coalesce("engagement_rate", F.lit(0.0)).alias("engagement_rate"),
        falsy_to(F.col("sentiment_score"), 0.5).alias("sentiment_score"),
        anomaly.alias("bot_probability"),
        anomaly.alias("suspicious_event_ratio"),
        F.coalesce("activity_score", F.lit(0.0)).alias("activity_score"),
        F.coalesce("is_suspicious", F.lit(False)).alias("is_suspicious"),
        F.coalesce("trust_score", F.lit(0.0)).alias("trust_score"),
        trust_label(F.coalesce("trust_score", F.lit(0.0))).alias("trust_label"),
        F.col("event_ts").alias("timestamp"),
        F.lit("spark_streaming").alias("trust_source"),
    ]


def features(scores: DataFrame, kol_id: str) -> DataFrame:
    return features_of(newest_of_creator(scores, kol_id, 1))


def audit_events(scores: DataFrame) -> DataFrame:
    """Scored rows in the shape of events."""
    return scores.select(*_audit_columns())


def _audit_columns() -> list[Column | str]:
    stamp = F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return [
        F.concat_ws("_", F.lit("spark"), "kol_id", stamp).alias("event_id"),
        "kol_id",
        "kol_name",
        "platform",
        F.lit("trust_score").alias("event_type"),
        F.col("event_ts").alias("timestamp"),
        F.lit("spark_streaming").alias("user_id"),
        F.col("trust_score").alias("value"),
        "sentiment_score",
        F.coalesce("is_suspicious", F.lit(False)).alias("is_suspicious"),
        "views",
        "likes",
        "comments",
        "shares",
        "followers",
        "engagement_rate",
        "anomaly_score",
        F.lit("spark_streaming").alias("trust_source"),
    ]


def events(scores: DataFrame, kol_id: str, limit: int = 100) -> DataFrame:
    return audit_events(newest_of_creator(scores, kol_id, limit)).orderBy("timestamp")


def bundle(scores: DataFrame, kol_id: str, limit: int = 100) -> DataFrame:
    """One nested row for one creator: profile, metrics, at most `limit` recent events, features."""
    recent = newest_of_creator(scores, kol_id, limit)
    rows = audit_events(recent)
    listed = rows.groupBy("kol_id").agg(
        F.sort_array(F.collect_list(F.struct("timestamp", *[c for c in rows.columns if c != "timestamp"]))).alias(
            "recent_events"
        )
    )
    latest = newest_of_creator(scores, kol_id, 1)
    base = profile(scores, kol_id).select("kol_id", F.struct("*").alias("profile"))
    return (
        base.join(F.broadcast(metrics_of(latest).select("kol_id", F.struct("*").alias("metrics"))), "kol_id", "left")
        .join(F.broadcast(listed), "kol_id", "left")
        .join(
            F.broadcast(features_of(latest).select("kol_id", F.struct("*").alias("model_features"))), "kol_id", "left"
        )
    )


def all_bundles(scores: DataFrame, limit: int = 100) -> DataFrame:
    """The bundle of every creator, events listed per creator up to `limit`: one last-N and one
    aggregate, which also finds the latest row that profile, metrics and features come from."""
    recent = all_timeseries(scores, limit)
    names = audit_events(scores).columns
    event = recent.withColumn("_event", F.struct(*_audit_columns()))
    fields = F.struct("_event.timestamp", *[f"_event.{name}" for name in names if name not in ("timestamp", "kol_id")])
    per_creator = event.groupBy("kol_id").agg(
        F.sort_array(F.collect_list(fields)).alias("recent_events"),
        F.min_by(F.struct(*[name for name in scores.columns if name != "kol_id"]), "recency").alias("_latest"),
    )
    return per_creator.select("kol_id", "recent_events", "_latest.*").select(
        "kol_id",
        F.struct(*_directory_columns()).alias("profile"),
        F.struct(*_metric_columns()).alias("metrics"),
        "recent_events",
        F.struct(*_feature_columns()).alias("model_features"),
    )


def alerts(scores: DataFrame, limit: int = 20) -> DataFrame:
    """The first `limit` suspicious rows. They sort before all others, and what is not suspicious goes after the limit:
    a filter ahead of it would be pushed below the scoring, where every use of a field parses the record anew."""
    suspicious = F.coalesce("is_suspicious", F.lit(False))
    first = _labelled(scores).orderBy(F.desc(suspicious), F.desc("anomaly_score"), F.desc("event_ts"), "kol_id", "video_id").limit(limit)
    return first.where(suspicious)


def in_input_order(rows: DataFrame) -> list[Column]:
    return [F.when(F.col("platform") == "youtube", 0).otherwise(1), F.col("first_seq")]


def export_features(unified: DataFrame, limit: int = 500) -> DataFrame:
    return unified.orderBy(*in_input_order(unified)).limit(limit)


def export_events(unified: DataFrame, limit: int = 500) -> DataFrame:
    return features_to_events(export_features(unified, limit))


def export_bundle(
    unified: DataFrame, trust_scores: DataFrame, limit: int = 500, stats: DataFrame | None = None, manifest: Sequence[str] = ()
) -> DataFrame:
    """One row with lists of at most `limit` features, leaderboard rows and events, the names of the
    tables in the manifest, and the build statistics if they are given. Features and events come
    from one pass."""
    chosen = export_features(unified, limit)
    names = [name for name in chosen.columns if name != "first_seq"]
    leaders = trust_scores.orderBy("rank").limit(limit)
    parts = [
        chosen.select(F.struct(*names).alias("features"), F.struct(*event_columns()).alias("events")),
        leaders.select(F.struct("*").alias("trust_scores")),
    ]
    lists = ["features", "trust_scores", "events"]
    if stats is not None:
        # One row per figure of the build.
        parts.append(stats.select(F.struct("*").alias("stats")))
        lists.append("stats")
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    # collect_list skips the NULLs of the other parts; every list has at most `limit` entries.
    row = stacked.agg(*[F.collect_list(name).alias(name) for name in lists])
    return row.withColumn("manifest", F.array(*map(F.lit, manifest)).cast("array<string>"))


def evaluate(unified: DataFrame, limit: int = 500, trust_model: PipelineModel | None = None) -> DataFrame:
    """Scored rows of the first `limit` features; `batch_rescore` takes all."""
    return score_events(export_events(unified, limit), trust_model)


def batch_rescore(unified: DataFrame, trust_model: PipelineModel | None = None) -> DataFrame:
    return score_events(features_to_events(unified), trust_model)
