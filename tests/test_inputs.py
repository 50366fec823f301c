"""Inputs that were once read wrongly, and totals that were once cut."""

import json

from pyspark.sql import functions as F

from veracast import schemas
from veracast.functions.numeric import safe_int
from veracast.operators import api_items, dashboard
from veracast.plans import api
from veracast.sources import readers


def test_totals_count_every_event(spark):
    scores = spark.range(600).select(
        F.lit("k").alias("kol_id"), F.lit("N").alias("kol_name"), F.lit("youtube").alias("platform"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("video_id"),
        *[F.col("id").alias(name) for name in ("followers", "views", "comments")], F.lit(0.9).alias("anomaly_score"), F.lit(0.5).alias("sentiment_score"),
        F.lit(10.0).alias("trust_score"), F.lit(True).alias("is_suspicious"), F.timestamp_seconds("id").alias("event_ts"),
    )
    summary = dashboard.live_summary(scores)
    row = summary.first()
    assert (row["events"], row["suspicious_events"], row["viewers"]) == (600, 600, 599)
    assert dashboard.overview_kpis(summary).first()["events"] == 600
    assert dashboard.anomaly_totals(summary).first()["bot_comments"] == 600


def test_csv_fields_with_line_breaks(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text('\ufefftext,n\n"x\ny",1\n"say ""hi"", ok",2\nlast,\n', encoding="utf-8")
    assert [tuple(row) for row in readers.read_csv(spark, str(path)).collect()] == [("x\ny", "1"), ('say "hi", ok', "2"), ("last", None)]
    assert [tuple(row) for row in readers.read_csv(spark, str(path), limit=2).collect()] == [("x\ny", "1"), ('say "hi", ok', "2")]


def test_json_counts(spark, tmp_path):
    given = [1200.0, 1200, "1200", " 7 ", "1.5", 1.9, 3_000_000_000, None, "n/a", True]
    expected = [1200, 1200, 1200, 7, 0, 1, 3_000_000_000, 0, 0, 1]
    path = tmp_path / "v.jsonl"
    path.write_text("\n".join(json.dumps({"video_id": f"{k:02}", "view_count": value}) for k, value in enumerate(given)))
    rows = readers.read_jsonl(spark, str(path), schemas.RAW_YOUTUBE_VIDEOS, ordered=True)
    assert [row["n"] for row in rows.orderBy("video_id").select(safe_int(F.col("view_count")).alias("n")).collect()] == expected
    missing = readers.read_jsonl(spark, str(tmp_path / "none.jsonl"), schemas.RAW_YOUTUBE_VIDEOS, ordered=True)
    assert missing.count() == 0 and dict(missing.dtypes)["view_count"] == "string"


def test_repeated_channels_do_not_multiply_videos(spark):
    items = spark.createDataFrame(
        [("v1", ("t", "UC1", None, "2024-01-01"), ("10", "1", "2", None, None), "2024")],
        "id string, snippet struct<title: string, channelId: string, channelTitle: string, publishedAt: string>, "
        f"statistics {schemas.API_STATISTICS}, collected_at string",
    )
    channels = spark.createDataFrame(
        [("UC1", "old", 1, 1, "2024-01-01"), ("UC1", "new", 5, 2, "2024-02-01"), ("UC2", "other", 9, 9, "2024-03-01")],
        "channel_id string, channel_name string, subscriber_count long, video_count long, collected_at string",
    )
    rows = api_items.normalize_videos(items, channels).collect()
    assert [(r["video_id"], r["channel_name"], r["subscriber_count"]) for r in rows] == [("v1", "new", 5)]


def test_scores_fall_back(spark):
    schema = ", ".join(f"{name} {kind}" for name, kind in {
        "kol_id": "string", "event_ts": "timestamp", "kol_name": "string", "platform": "string", "video_id": "string", "views": "long", "likes": "long",
        "comments": "long", "shares": "long", "followers": "long", "engagement_rate": "double", "sentiment_score": "double", "activity_score": "double",
        "anomaly_score": "double", "trust_score": "double", "is_suspicious": "boolean"}.items())
    none = spark.createDataFrame([], schema)
    leaders = spark.createDataFrame(
        [("a", "A", "youtube", 9, 5, 0.1, 50.0, 1.0, 71.0, "rule", 0, "2024-01-01T00:00:00Z")],
        "creator_id string, creator_name string, platform string, follower_count long, total_views long, avg_engagement_rate double, avg_sentiment_score double, "
        "avg_activity_score double, trust_score double, label_source string, suspicious_content_count long, collected_at string",
    )
    events = spark.createDataFrame([("b", 10, 55.0, "2024-01-01T00:00:00Z")], "channel_id string, views long, trust_score double, collected_at string")
    first = api.available_scores(none, leaders, events)
    assert [(r["kol_id"], r["trust_score"]) for r in api.latest_scores(first).collect()] == [("a", 71.0)]
    last = api.available_scores(none, leaders.limit(0), events)
    assert [(r["kol_id"], r["verified"]) for r in api.creator_directory(last).collect()] == [("b", False)]
