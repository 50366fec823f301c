import json

from pyspark.sql import functions as F

from veracast import schemas
from veracast.operators import live
from veracast.streaming import recent, sinks
from veracast.streaming.scoring import corrupt_records, score_stream


def records(spark, payloads, start=0):
    rows = [(json.dumps(p) if isinstance(p, dict) else p, "t", 0, start + n, None) for n, p in enumerate(payloads)]
    table = spark.createDataFrame(rows, "value string, topic string, partition int, offset bigint, timestamp timestamp")
    return table.withColumn("value", F.col("value").cast("binary"))


PAYLOADS = [
    {"kol_id": "a", "timestamp": "2024-01-01T00:00:00", "views": 100, "likes": 1},
    {"channel_id": "a", "timestamp": "2024-01-01T00:00:00", "views": 200, "likes": 1},
    {"kol_id": "b", "crawled_at": "2024-01-02T00:00:00", "view_count": 3000000000, "comment_spam_ratio": 1.0, "follower_growth_rate": 2.0},
    "{broken",
]
COMPARED = ["kol_id", "video_id", "views", "likes", "engagement_rate", "activity_score", "anomaly_score", "trust_score", "is_suspicious"]


def test_scored_rows(spark):
    rows = score_stream(records(spark, PAYLOADS)).orderBy("kafka_offset").collect()
    assert [row["kol_id"] for row in rows] == ["a", "a", "b", "unknown"]
    assert rows[2]["views"] == 3000000000 and rows[2]["is_suspicious"]
    assert (rows[3]["trust_score"], rows[3]["is_suspicious"]) == (67.86, False)
    assert rows[0].asDict().keys() == set(schemas.SCORED_COLUMNS)
    assert corrupt_records(records(spark, PAYLOADS)).count() == 1


def test_stream_equals_batch_and_replays(spark, tmp_path):
    topic = str(tmp_path / "topic")
    records(spark, PAYLOADS[:3]).coalesce(1).write.parquet(topic)
    paths = sinks.LakePaths(*[str(tmp_path / name) for name in ("raw", "processed", "serving", "keyed")])
    stream = score_stream(spark.readStream.schema(schemas.STREAM_RECORD).parquet(topic))
    sinks.start_scoring(stream, paths, str(tmp_path / "c"), available_now=True).awaitTermination()
    batch = score_stream(records(spark, PAYLOADS[:3]))
    streamed = spark.read.parquet(paths.processed)
    assert sorted(map(str, streamed.select(COMPARED).collect())) == sorted(map(str, batch.select(COMPARED).collect()))
    assert {row["event_date"].isoformat() for row in spark.read.json(paths.raw).select("event_date").distinct().collect()} == {"2024-01-01", "2024-01-02"}

    # A second run reads only what is new; its write of an existing key wins.
    records(spark, [{"kol_id": "a", "timestamp": "2024-01-01T00:00:00", "views": 7}], start=3).coalesce(1).write.mode("append").parquet(topic)
    sinks.start_scoring(stream, paths, str(tmp_path / "c"), available_now=True).awaitTermination()
    keyed = {row["kol_id"]: row["views"] for row in sinks.read_keyed(spark, paths.keyed).collect()}
    assert keyed == {"a": 7, "b": 3000000000}
    assert spark.read.parquet(paths.processed).count() == 4
    # The same batch once more replaces its own rows.
    sinks.write_batch(paths)(score_stream(records(spark, PAYLOADS[:3])), 0)
    assert spark.read.parquet(paths.processed).count() == 4
    assert sinks.read_keyed(spark, paths.keyed, since="2024-01-02").count() == 1


def test_recent_events_over_batches(spark, tmp_path):
    feed = spark.range(600).select(
        F.col("id").alias("event_id"), F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("kol_id"),
        F.when(F.col("id") % 2 == 0, "comment").otherwise("like").alias("event_type"), F.col("id").alias("timestamp"),
        (F.col("id") % 50).cast("string").alias("user_id"), (F.col("id") % 7 == 0).alias("is_suspicious"),
        F.when(F.col("id") % 5 > 0, F.lit(0.5)).alias("sentiment_score"),
    )
    path = str(tmp_path / "recent")
    for number, low in enumerate((0, 200, 400)):
        recent.keep_recent(path)(feed.where(F.col("event_id").between(low, low + 199)), number)
    recent.keep_recent(path)(feed.where(F.col("event_id").between(400, 599)), 2)
    expected = sorted(map(str, live.live_window_stats(feed).collect()))
    assert sorted(map(str, recent.read_recent_stats(spark, path).collect())) == expected
    # Folding leaves one batch and the same figures, also with a fold that ended before it cleared up.
    recent.fold_recent(spark, path, 3)
    assert [row["batch_id"] for row in spark.read.parquet(path).select("batch_id").distinct().collect()] == [2]
    assert sorted(map(str, recent.read_recent_stats(spark, path).collect())) == expected
    recent.keep_recent(path)(feed.where(F.col("event_id").between(0, 199)), 0)
    assert sorted(map(str, recent.read_recent_stats(spark, path).collect())) == expected


def test_many_batches_stay_few_files(spark, tmp_path):
    """Twelve batches over the same keys, one of them run again, folded every fourth."""
    folder = {}
    for name, fold_every in (("folded", 4), ("plain", 1000)):
        paths = sinks.LakePaths(*[str(tmp_path / f"{name}-{part}") for part in ("raw", "processed", "serving", "keyed")])
        write = sinks.write_batch(paths, fold_every)
        for number in range(12):
            day = 1 + number % 2
            rows = [{"kol_id": f"k{k}", "timestamp": f"2024-01-0{day}T00:00:00", "views": 10 * number + k} for k in range(5)]
            batch = score_stream(records(spark, rows, start=100 * number)).cache()
            for _ in range(2 if number == 8 else 1):
                write(batch, number)
        folder[name] = paths.keyed
    views = {
        name: sorted((r["kol_id"], str(r["event_ts"]), r["views"]) for r in sinks.read_keyed(spark, path).collect()) for name, path in folder.items()
    }
    assert views["folded"] == views["plain"] and len(views["plain"]) == 10
    parts = spark.read.parquet(folder["folded"]).select("event_date", "batch_id").distinct().collect()
    assert len(parts) <= 6 and {row["batch_id"] for row in parts} == {7, 8, 9, 10, 11}
    assert len(list((tmp_path / "folded-keyed").rglob("part-*.parquet"))) <= 6


def test_windowed_stream(spark, tmp_path):
    feed = spark.createDataFrame(
        [("k", "comment", "2024-01-01 00:01:00", "u", 0.5, True), ("k", "like", "2024-01-01 00:02:00", "u", None, False)],
        "kol_id string, event_type string, timestamp string, user_id string, sentiment_score double, is_suspicious boolean",
    ).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    feed.write.parquet(str(tmp_path / "feed"))
    stream = recent.windowed_activity(spark.readStream.schema(feed.schema).parquet(str(tmp_path / "feed")))
    run = stream.writeStream.format("memory").queryName("windows").outputMode("complete").option(
        "checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    run.awaitTermination()
    row = spark.table("windows").first()
    assert (row["events"], row["suspicious_event_ratio"], row["avg_comment_sentiment"], row["users"]) == (2, 0.5, 0.5, 1)


def test_bundle_event(spark):
    events = [(str(n), "comment" if n % 2 else "view") for n in range(60)]
    bundle = json.dumps({
        "profile": {"kol_id": "k", "name": "N", "followers": 9}, "metrics": {"viewers": 0, "likes": 4, "live_id": "L"},
        "recent_events": [{"event_type": kind, "value": value} for value, kind in events],
        "model_features": {"viewer_count": "12", "bot_probability": "0.5"},
    })
    rows = spark.createDataFrame([(bundle,)], "v string").select(F.from_json("v", schemas.LIVE_BUNDLE).alias("b")).select("b.*")
    row = live.bundles_to_events(rows).first()
    assert (row["views"], row["likes"], row["comments"], row["followers"], row["upload_frequency_7d"]) == (12, 4, 0, 9, 2.1)
    assert row["text"] == " ".join(str(n) for n in range(21, 60, 2)) and row["platform"] == "youtube"
