import json

from pyspark.sql import functions as F

from veracast import schemas
from veracast.operators import api_items, quality
from veracast.plans import api, build, scoring
from veracast.sources import readers, writers

VIDEOS = [
    {"channel_id": "UC1", "channel_name": "One", "video_id": "a", "video_title": "old", "published_at": "2024-01-01T00:00:00Z",
     "view_count": 1000, "like_count": 40, "comment_count": 10, "subscriber_count": 5, "video_count": 2, "collected_at": "2024-02-01"},
    {"channel_id": "UC1", "channel_name": "One", "video_id": "b", "video_title": "Tiáº¿ng", "published_at": "2024-01-15",
     "view_count": "200000", "like_count": 0, "comment_count": 4, "collected_at": "2024-02-02"},
    {"channel_id": "UC1", "channel_name": "One", "video_id": "a", "video_title": "new", "published_at": "1704067200",
     "view_count": 2000, "like_count": 80, "comment_count": 20, "collected_at": "2024-02-03"},
    {"channel_id": "UC2", "video_id": "zero", "view_count": 0},
    {"channel_id": "UC2", "video_id": "", "view_count": 9},
    {"channel_id": "UC2", "video_id": "text", "view_count": "many"},
]
COMMENTS = [
    {"channel_id": "UC1", "video_id": "a", "comment_id": "c1", "comment_text": "rất hay", "comment_author_display_name": "An"},
    {"channel_id": "UC1", "video_id": "a", "comment_id": "c1", "comment_text": "không hay"},
    {"channel_id": "UC1", "video_id": "a", "comment_id": "c3", "comment_text": "x", "comment_sentiment": "negative",
     "comment_sentiment_score": 0.0},
]
CREATORS = [{"creator_id": None, "username": "minh", "creator_name": "Minh", "follower_count": 3000000000, "content_count": 7}]
TIKTOK = [
    {"content_id": "t1", "creator_id": "minh", "content_title": "my street food", "publish_time": "1704067200000",
     "view_count": 1000, "like_count": 40, "comment_count": 10, "share_count": 50},
    {"content_id": "t2", "creator_id": "gone", "caption": "#Vui", "view_count": 10, "like_count": 9},
]
CHANNELS = [{"channel_id": "UC1", "channel_name": "One", "subscriber_count": 5}, {"channel_id": "UC1", "channel_name": "One Two"}]
SEEDS = [{"channel_id": "UC1", "seed_keyword": "Music"}, {"channel_id": "UC1", "seed_keyword": ""}]


def write_raw(folder):
    tables = {"youtube_videos": VIDEOS, "youtube_comments": COMMENTS, "tiktok_creators": CREATORS, "tiktok_videos": TIKTOK,
              "youtube_channels": CHANNELS, "youtube_channel_seeds": SEEDS}
    for name, rows in tables.items():
        (folder / f"{name}.jsonl").write_text("\n\n".join(json.dumps(row, ensure_ascii=False) for row in rows) + "\n", "utf-8")


def test_build_and_validate(spark, tmp_path):
    write_raw(tmp_path)
    out = str(tmp_path / "out")
    stats = {(row["section"], row["metric"]): row["value"] for row in build.build_dataset(spark, build.read_raw(spark, str(tmp_path)), out).collect()}
    assert stats["quality", "duplicate_youtube_videos_removed"] == 1
    assert stats["quality", "removed_zero_view_youtube_videos"] == 2
    assert stats["unified", "feature_rows"] == 4 and stats["comments", "sentiment_rows"] == 3

    features = {row["content_id"]: row for row in spark.read.parquet(f"{out}/silver/unified/features").collect()}
    a = features["a"]
    assert (a["content_title"], a["view_count"], a["publish_time"]) == ("new", 2000, "2024-01-01T00:00:00Z")
    # (90 + 30 + 50 for the falsy 0) / 3
    assert (a["sentiment_score"], a["positive_comment_count"], a["negative_comment_count"]) == (56.67, 1, 2)
    assert a["upload_frequency"] == 1.0 and features["b"]["content_title"] == "Tiếng"
    assert (features["t1"]["trust_score"], features["t1"]["follower_count"], features["t1"]["upload_frequency"]) == (66.2, 3000000000, 1.0)
    assert (features["t2"]["follower_count"], features["t2"]["upload_frequency"]) == (0, 0.0)

    creators = spark.read.parquet(f"{out}/bronze/tiktok/creators").first()
    assert (creators["creator_id"], creators["category"]) == ("minh", "food")
    channel = spark.read.parquet(f"{out}/bronze/youtube/channels").first()
    assert (channel["channel_name"], channel["category"]) == ("One Two", "music")
    comments = spark.read.parquet(f"{out}/silver/comments/sentiment").collect()
    assert all(row["comment_text_is_hashed"] and len(row["comment"]) == 64 for row in comments)
    ranks = spark.read.parquet(f"{out}/gold/features/trust_scores").orderBy("rank").collect()
    assert [row["rank"] for row in ranks] == [1, 2, 3] and ranks[0]["trust_score"] >= ranks[1]["trust_score"]
    assert spark.read.parquet(f"{out}/silver/unified/splits").select("split", "platform", "creator_id").distinct().count() == 3

    report = {row["table_name"]: row["status"] for row in build.validate_dataset(spark, out).collect()}
    assert report == {"influencer_features": "ok", "comments_sentiment": "ok", "trust_scores": "ok", "serving_events": "ok"}
    writers.publish_dataset(spark, out, str(tmp_path / "copy"), build.MANIFEST)
    assert spark.read.json(str(tmp_path / "copy/serving/events")).count() == 4
    document = json.loads(next((tmp_path / "out/dataset_stats").glob("part-*.json")).read_text())
    assert document["stats"]["unified"]["feature_rows"] == 4


def test_readers(spark, tmp_path):
    assert readers.read_jsonl(spark, str(tmp_path / "none.jsonl"), "a string", ordered=True).count() == 0
    (tmp_path / "bad.jsonl").write_text('{"a": "x"}\n{oops\n')
    kept = readers.read_jsonl(spark, str(tmp_path / "bad.jsonl"), "a string", quarantine=True).collect()
    assert [row["_corrupt_record"] for row in kept] == [None, "{oops"]
    (tmp_path / "t.csv").write_text("﻿a,b\n1,\n2,x\n", "utf-8")
    rows = readers.read_csv(spark, str(tmp_path / "t.csv")).collect()
    assert [tuple(row) for row in rows] == [("1", None), ("2", "x")] and rows[0].asDict().keys() == {"a", "b"}
    for name, body in {"l.json": '[{"a": "1"}, {"a": "2"}]', "r.json": '{"records": [{"a": "1"}, {"a": "2"}]}', "o.json": '{"a": "1"}'}.items():
        (tmp_path / name).write_text(body)
        got = [row["a"] for row in readers.read_json_records(spark, str(tmp_path / name), "a string").collect()]
        assert got == (["1"] if name == "o.json" else ["1", "2"])
    (tmp_path / "s.txt").write_text("# list\n@b\n\n a \n@b\n")
    seeds = readers.read_seed_list(spark, str(tmp_path / "s.txt"), strip="@").orderBy("seq").collect()
    assert [row["value"] for row in seeds] == ["b", "a"]


def test_threads(spark, tmp_path):
    thread = {
        "video_id": "v", "channel_id": "UC", "collected_at": "now",
        "snippet": {"topLevelComment": {"id": "c", "snippet": {"textDisplay": "good", "authorChannelId": {"value": "A"}, "likeCount": 3}}},
        "replies": {"comments": [{"id": "r", "snippet": {"textOriginal": "bad", "authorChannelId": "B"}}]},
    }
    alone = {"video_id": "v", "snippet": {"topLevelComment": {"id": "d", "snippet": {}}}}
    (tmp_path / "t.jsonl").write_text(json.dumps(thread) + "\n" + json.dumps(alone))
    items = readers.read_jsonl(spark, str(tmp_path / "t.jsonl"), schemas.COMMENT_THREAD)
    rows = {row["comment_id"]: row for row in api_items.flatten_comment_threads(items).collect()}
    assert {key: (row["parent_comment_id"], row["is_reply"], row["comment_author_channel_id"], row["comment_sentiment"]) for key, row in rows.items()} == {
        "c": ("", False, "A", "positive"), "r": ("c", True, "B", "negative"), "d": ("", False, None, "neutral")}


def test_api_items(spark):
    items = spark.createDataFrame(
        [("v1", ("T", "UC1", "", "2024-01-01"), ("1000", "40", "10"), "now"), ("v2", ("T", "UC9", "Nine", None), (None, "x", None), "now")],
        "id string, snippet struct<title: string, channelId: string, channelTitle: string, publishedAt: string>, "
        "statistics struct<viewCount: string, likeCount: string, commentCount: string>, collected_at string",
    )
    channels = spark.createDataFrame([("UC1", "One", 7, 3)], "channel_id string, channel_name string, subscriber_count bigint, video_count bigint")
    rows = {row["video_id"]: row for row in api_items.normalize_videos(items, channels).collect()}
    assert (rows["v1"]["channel_name"], rows["v1"]["subscriber_count"], rows["v1"]["trust_score"]) == ("One", 7, 40.2)
    assert (rows["v2"]["channel_name"], rows["v2"]["subscriber_count"], rows["v2"]["like_count"]) == ("Nine", 0, 0)
    clips = spark.createDataFrame(
        [("7", "hi #Đẹp #b", ("u", "Nick"), ("5", "2"), [("#b", None, None)], "now")],
        "aweme_id string, desc string, author struct<uid: string, nickname: string>, stats struct<playCount: string, diggCount: string>, "
        "challenges array<struct<title: string, hashtagName: string, name: string>>, collected_at string",
    )
    clip = api_items.normalize_tiktok_videos(clips).first()
    assert (clip["content_id"], clip["creator_id"], clip["view_count"], clip["share_count"], clip["hashtags"]) == ("7", "u", 5, 0, ["b", "Đẹp"])


def test_scoring(spark):
    empty = spark.createDataFrame([("x",)], "video_id string")
    row = scoring.score_events(empty).first()
    assert (row["trust_score"], row["kol_id"], row["is_suspicious"], row["trust_label"]) == (67.86, "unknown", False, "medium_trust")
    events = spark.createDataFrame([("a", 0, 100, 50.0), ("b", 10, 0, None)], "kol_id string, views int, view_count int, trust_score double")
    rows = {row["kol_id"]: row for row in scoring.scores_from_events(events).collect()}
    assert (rows["a"]["views"], rows["a"]["trust_label"], rows["b"]["trust_source"]) == (100, "medium_trust", "rule_fallback")


def test_profile_of_unknown_creator(spark):
    scores = spark.createDataFrame(
        [("a", "A", "youtube", 5, 80.0, "e", 1.0)], "kol_id string, kol_name string, platform string, followers int, trust_score double, video_id string, n double"
    ).withColumn("event_ts", F.lit("2024-01-01").cast("timestamp"))
    assert api.profile(scores, "a").first()["verified"] is True
    assert api.profile(scores, "none").first()["risk_profile"] == "unknown"


def test_quality_finds_faults(spark):
    rows = spark.createDataFrame([("youtube", "5"), ("myspace", "-1"), (None, "x")], "platform string, view_count string")
    rules = (quality.Rule("platform", "string", allowed=quality.PLATFORMS), quality.Rule("view_count", "bigint", low=0), quality.Rule("gone", "string"))
    report = {row["column_name"]: (row["null_rows"], row["type_rows"], row["broken_rows"], row["status"]) for row in quality.check_schema(rows, rules, "t").collect()}
    assert report == {"platform": (1, 0, 1, "failed"), "view_count": (0, 1, 1, "failed"), "gone": (3, 0, 0, "failed")}
    lines = spark.createDataFrame([(1, "{"), (2, '{"event_id": 1}'), (3, " ")], "line int, value string")
    bad = quality.check_json_events(lines).collect()
    assert bad[0]["error"] and bad[1]["missing"].startswith("collected_at,engagement_rate") and len(bad) == 2
