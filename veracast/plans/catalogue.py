"""The registered queries: each runs an operator or job over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..functions import score as S
from ..functions.buckets import hash_bucket, identity_profile
from ..functions.numeric import half_up, safe_int, to_float
from ..functions.sentiment import unit_label, with_unit_sentiment
from ..functions.text import category_of_mask, extract_hashtags, hash_pii, has_mojibake, repair_mojibake
from ..functions.timeparse import iso_utc, normalize_timestamp, parse_timestamp
from ..ml import formula, store
from ..ml import sentiment as sentiment_ml
from ..ml import trust as trust_ml
from ..operators import api_items, bronze, dashboard, gold, keyed, live, quality, silver, stats
from ..session import cut_lineage, scratch_path
from ..sources import given, readers, splits, topic, writers
from ..streaming import compaction, recent, sinks
from ..streaming.scoring import score_stream
from . import api, scoring
from .build import Tables, build_dataset

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


# --- batch layers -------------------------------------------------------------------------


def _tables(spark: SparkSession, sf_dir: str, anonymize: bool = True) -> Tables:
    return Tables(given.raw_tables(spark, sf_dir), anonymize)


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tables(spark, sf_dir).features


@query
def creator_trust_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leaderboard(spark, sf_dir)


def _leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tables(spark, sf_dir).leaderboard


@query
def youtube_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tables(spark, sf_dir).youtube_channels.select(schemas.YOUTUBE_CHANNEL_COLUMNS)


@query
def youtube_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tables(spark, sf_dir).youtube_videos.select(schemas.YOUTUBE_VIDEO_COLUMNS)


@query
def tiktok_creators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tables(spark, sf_dir).tiktok_creators.select(schemas.TIKTOK_CREATOR_COLUMNS)


@query
def tiktok_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tables(spark, sf_dir).tiktok_videos.select(schemas.TIKTOK_VIDEO_COLUMNS)


@query
def unified_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir).select(schemas.UNIFIED_FEATURE_COLUMNS)


@query
def content_engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.engagement_features(_features(spark, sf_dir))


@query
def suspicious_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.suspicious_only(gold.suspicious_engagement(_features(spark, sf_dir)))


@query
def upload_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _tables(spark, sf_dir)
    return silver.upload_frequency(silver.publish_times(tables.youtube_videos, tables.tiktok_videos)).drop("_weight")


@query
def creator_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _tables(spark, sf_dir)
    chosen = gold.split_rows(tables.content)["analysis_profile"]
    return gold.profiles_by_size(gold.creator_profiles(chosen, tables.sizes))


@query
def serving_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.serving_events(_features(spark, sf_dir))


@query
def dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    videos = given.youtube_videos(spark, sf_dir).select("video_id", "view_count", "collected_at", "seq")
    return keyed.dedupe_latest(videos, "video_id")


@query
def duplicate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = given.raw_tables(spark, sf_dir)
    keys = {"youtube_channels": "channel_id", "youtube_videos": "video_id", "tiktok_creators": "creator_id",
            "tiktok_videos": "content_id"}
    parts = [
        keyed.count_duplicates(raw[name], key).select(F.lit(name).alias("table_name"), "duplicate_rows")
        for name, key in keys.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query
def removed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = given.raw_tables(spark, sf_dir)
    return keyed.removed_ids(raw["youtube_videos"], bronze.build_youtube_videos(raw["youtube_videos"]), "video_id")


@query
def creator_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    platform = F.when(F.col("c_custkey") % 2 == 0, "youtube").otherwise("tiktok")
    creators = given.table(spark, sf_dir, "customer").select(
        platform.alias("platform"), F.concat(F.lit("UC"), F.col("c_custkey").cast("string")).alias("creator_id")
    )
    return gold.with_split(creators).withColumn("bucket5", hash_bucket(F.col("creator_id"), 5))


@query
def split_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _tables(spark, sf_dir)
    return stats.split_counts(tables.content, "rows").unionByName(
        stats.split_counts(tables.comments, "comment_rows")
    )


@query
def split_leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.split_leakage(gold.with_split(_tables(spark, sf_dir).content))


@query
def split_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored split folders read back one by one: creators of each two splits, and of both."""
    path = scratch_path(spark, "splits")
    gold.with_split(_tables(spark, sf_dir).content).write.partitionBy("split").parquet(path)
    names = ("train", "eval", "analysis_profile")
    creators = {name: spark.read.parquet(f"{path}/split={name}").select("platform", "creator_id").distinct() for name in names}
    rows = []
    for left, right in (("train", "eval"), ("train", "analysis_profile"), ("eval", "analysis_profile")):
        both = creators[left].withColumn("side", F.lit(1)).unionByName(creators[right].withColumn("side", F.lit(2)))
        per_creator = both.groupBy("platform", "creator_id").agg(F.sum("side").alias("sides"))
        rows.append(
            per_creator.agg(
                F.count_if(F.col("sides") != 2).alias("left_creators"),
                F.count_if(F.col("sides") != 1).alias("right_creators"),
                F.count_if(F.col("sides") == 3).alias("shared_creators"),
            ).select(F.lit(left).alias("left_split"), F.lit(right).alias("right_split"), "*")
        )
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query
def seed_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    channels = given.youtube_channels(spark, sf_dir).withColumn("seed_keyword", F.lit("review"))
    return gold.seeds_by_size(api_items.seed_rows(channels)).drop("seq")


# --- comments and text --------------------------------------------------------------------


@query
def comment_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.comment_sentiment_rows(given.youtube_comments(spark, sf_dir), anonymize=False)


@query
def comment_sentiment_anonymous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.comment_sentiment_rows(given.youtube_comments(spark, sf_dir), anonymize=True)


@query
def content_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.content_sentiment(given.youtube_comments(spark, sf_dir))


@query
def comment_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return api_items.flatten_comment_threads(given.comment_threads(spark, sf_dir))


@query
def lexicon_sentiment_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = given.comment_lines(spark, sf_dir)
    scored = with_unit_sentiment(lines, F.col("text"), "score")
    return scored.select("doc_id", "line", half_up(F.col("score"), 6).alias("score"), unit_label(F.col("score")).alias("label"))


@query
def pii_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = given.table(spark, sf_dir, "conversations")
    return turns.select("conv_id", "turn", hash_pii(F.col("text")).alias("text_hash"), hash_pii(F.col("role")).alias("role_hash"))


@query
def mojibake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accents of the documents are broken the way a wrong code page breaks them, then repaired;
    texts that also hold a character outside that code page stay broken."""
    broken = given.table(spark, sf_dir, "documents").select("doc_id", given.broken_letters(F.col("text")).alias("broken"))
    return broken.select(
        "doc_id", has_mojibake(F.col("broken")).alias("marked"), repair_mojibake(F.col("broken")).alias("repaired")
    )


@query
def hashtags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags of every comment line: the marks after words of the documents serve as hash signs."""
    lines = given.comment_lines(spark, sf_dir).withColumn("caption", F.replace("text", F.lit(" de"), F.lit(" #de")))
    challenges = F.array(F.struct(F.concat(F.lit("#"), "source").alias("title"), F.lit("x").alias("hashtagName"), F.lit("x").alias("name")))
    extras = F.array(
        F.struct(F.col("lang").alias("hashtagName"), F.lit("x").alias("tagName")),
        F.struct(F.lit("").alias("hashtagName"), F.lit("x").alias("tagName")),
    )
    return lines.select("doc_id", "line", F.array_join(extract_hashtags(challenges, extras, F.col("caption")), ",").alias("tags"))


@query
def category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category of every document source from all its texts, without gathering them."""
    documents = given.table(spark, sf_dir, "documents").select(
        F.col("source").alias("creator_id"),
        F.col("doc_id").alias("seq"),
        F.col("text").alias("content_title"),
        F.lit(None).cast("string").alias("caption"),
        F.lit(None).cast("array<string>").alias("hashtags"),
    )
    masks = bronze.creator_text_masks(documents)
    mask = F.col("_videos_mask")
    return masks.select("creator_id", mask.alias("mask"), category_of_mask(mask).alias("category"))


@query
def timestamp_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event time in one of five spellings, one of them unreadable."""
    kind, ts = F.col("event_type"), F.col("ts")
    seconds = F.unix_date(ts.cast("date")).cast("bigint") * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    spelled = (
        F.when(kind == "view", seconds.cast("string"))
        .when(kind == "click", (seconds * 1000 + 999).cast("string"))
        .when(kind == "error", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'+07:00'"))
        .when(kind == "signup", F.date_format(ts, "yyyy-MM-dd HH:mm:ss'Z'"))
        .otherwise(F.concat(F.lit("at "), F.date_format(ts, "HH:mm")))
    )
    rows = given.table(spark, sf_dir, "events").select("event_id", spelled.alias("given"))
    return rows.select("event_id", normalize_timestamp(F.col("given")).alias("iso"), iso_utc(parse_timestamp(F.col("given"))).alias("typed"))


@query
def safe_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event values as text, some of them not numbers."""
    value, kind = F.col("value"), F.col("event_type")
    text = (
        F.when(kind == "view", F.floor(value).cast("string"))
        .when(kind == "click", F.concat(F.lit(" "), F.floor(value).cast("string"), F.lit(" ")))
        .when(kind == "error", F.concat(F.floor(value).cast("string"), F.lit(".5")))
        .when(kind == "signup", "NaN")
    )
    rows = given.table(spark, sf_dir, "events").select("event_id", text.alias("text"), "value")
    return rows.select(
        "event_id",
        safe_int(F.col("text")).alias("whole"),
        safe_int(F.col("value")).alias("cut"),
        to_float(F.col("text"), 0.25).alias("number"),
        S.normalize_unit_score(F.col("text")).alias("unit"),
    )


# --- scoring ------------------------------------------------------------------------------


def _score_view(scored: DataFrame, *more: str) -> DataFrame:
    """Scored rows with rates rounded for comparison and the event time as text."""
    return scored.select(
        "kol_id",
        "kol_name",
        "platform",
        "video_id",
        F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_time"),
        "views",
        "likes",
        "comments",
        "shares",
        "followers",
        *[half_up(F.col(name), 6).alias(name) for name in _RATES],
        "trust_score",
        "is_suspicious",
        *more,
    )


_RATES = ("engagement_rate", "sentiment_score", "activity_score", "anomaly_score")


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored rows of the whole feed, rates rounded as they are when stored."""
    scored = score_stream(given.stream_records(spark, sf_dir))
    return scored.withColumns({name: half_up(F.col(name), 6) for name in _RATES})


@query
def stream_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _score_view(score_stream(given.stream_records(spark, sf_dir)))


#: Records in a file of the topic: what a task of a batch reads does not grow with the input, the number of files does.
TOPIC_FILE_ROWS = 25_000


def _run_stream(spark: SparkSession, records: DataFrame, files_per_batch: int, compact_every: int | None = None) -> sinks.LakePaths:
    """Write the records where a file stream finds them and run the scoring job to the end."""
    root = scratch_path(spark, "stream")
    records.write.parquet(f"{root}/topic")
    paths = sinks.LakePaths(f"{root}/raw", f"{root}/processed", f"{root}/serving", f"{root}/keyed")
    scored = score_stream(topic.file_source(spark, f"{root}/topic", files_per_batch))
    sinks.start_scoring(scored, paths, f"{root}/checkpoint", available_now=True, compact_every=compact_every).awaitTermination()
    return paths


def _run_batches(spark: SparkSession, records: DataFrame, batches: int, least_files: int, compact_every: int | None = None) -> sinks.LakePaths:
    """The streamed run in so many batches of whole offset ranges, each in `least_files` files or as many as its records fill."""
    files = max(least_files, -(-records.count() // (batches * TOPIC_FILE_ROWS)))
    return _run_stream(spark, records.repartitionByRange(batches * files, "offset"), files, compact_every)


@query
def stream_scores_available_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = _run_batches(spark, given.stream_records(spark, sf_dir), 2, least_files=2)
    return _score_view(spark.read.parquet(paths.processed))


@query
def stream_lake_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per event date in the three lake tables after a streamed run."""
    paths = _run_stream(spark, given.stream_records(spark, sf_dir), 1000)
    counted = [
        spark.read.format(fmt).load(path).groupBy(F.col("event_date").cast("string").alias("event_date")).agg(
            F.count(F.lit(1)).alias("lake_rows")
        ).select(F.lit(name).alias("lake"), "event_date", "lake_rows")
        for name, fmt, path in (
            ("raw", "json", paths.raw), ("processed", "parquet", paths.processed), ("serving", "parquet", paths.serving)
        )
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@query
def stream_lake_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per event date after six batches, packed before every second one."""
    paths = _run_batches(spark, given.stream_records(spark, sf_dir), 6, least_files=1, compact_every=2)
    counted = [
        compaction.read_lake(spark, path, fmt).groupBy(F.col("event_date").cast("string").alias("event_date")).agg(F.count(F.lit(1)).alias("lake_rows"))
        .select(F.lit(name).alias("lake"), "event_date", "lake_rows")
        for name, fmt, path in (("raw", "json", paths.raw), ("processed", "parquet", paths.processed), ("serving", "parquet", paths.serving))
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@query
def stream_upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times cut to the day, so that keys repeat: the last record of a key stays."""
    payloads = given.stream_payloads(spark, sf_dir)
    day = F.date_format("ts", "yyyy-MM-dd")
    fields = [name for name in payloads.columns if name not in ("event_id", "ts")]
    cut = payloads.withColumn("timestamp", day).withColumn("crawled_at", day)
    records = cut.select(
        F.to_json(F.struct(*fields)).cast("binary").alias("value"),
        F.lit("events").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )
    paths = _run_stream(spark, records, 1000)
    return _score_view(sinks.read_keyed(spark, paths.keyed))


@query
def score_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = given.stream_payloads(spark, sf_dir).drop("ts", "event_id")
    return scoring.score_events(events)


@query
def predict_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = given.stream_payloads(spark, sf_dir).drop("ts", "event_id")
    predicted = scoring.predict_trust(events)
    return predicted.select("video_id", *[name for name in predicted.columns if name.startswith("pred_")])


@query
def batch_rescore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return api.batch_rescore(_features(spark, sf_dir))


@query
def scores_from_serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.scores_from_events(gold.serving_events(_features(spark, sf_dir)))


@query
def bundle_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live bundles of all sessions, made by the live operators, as stream events."""
    feed, sessions = given.live_events(spark, sf_dir), given.live_sessions(spark, sf_dir)
    newest = keyed.last_n(feed, ["kol_id"], [F.desc("timestamp"), F.desc("event_id")], live.FEATURE_EVENTS)
    window_stats = live.window_counts(newest)
    # The bundle lists the newest 80 events of a creator.
    listed = newest.where(F.col("recency") <= 80).groupBy("kol_id").agg(
        F.sort_array(F.collect_list(F.struct(-F.col("recency"), "event_id", "event_type", "value"))).alias("_events")
    )
    features = live.live_model_features(window_stats, sessions).drop("timestamp")
    metrics = live.live_metrics(window_stats, sessions).drop("timestamp")
    as_map = F.create_map(
        *[part for name in features.columns if name != "kol_id" for part in (F.lit(name), F.col(name).cast("string"))]
    )
    bundles = (
        metrics.join(listed, "kol_id").join(features.select("kol_id", as_map.alias("model_features")), "kol_id")
        .join(sessions.select("kol_id", "name", "platform", "followers"), "kol_id")
        .select(
            F.struct("kol_id", "name", "platform", F.col("followers").cast("string").alias("followers")).alias("profile"),
            F.struct(
                "live_id", "kol_id", F.lit("2024-01-31T00:00:00Z").alias("timestamp"),
                *[F.col(name).cast("string").alias(name) for name in ("viewers", "likes", "comments", "shares")],
            ).alias("metrics"),
            F.transform("_events", lambda e: F.struct(e["event_type"].alias("event_type"), e["value"].alias("value"))).alias(
                "recent_events"
            ),
            "model_features",
        )
    )
    return live.bundles_to_events(bundles).drop("event_id")


# --- read queries -------------------------------------------------------------------------


@query
def latest_per_creator(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _score_view(api.latest_per_creator(_scores(spark, sf_dir)))


@query
def latest_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _score_view(api.latest_scores(_scores(spark, sf_dir), 50), "trust_label", "trust_source")


@query
def top_creators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _score_view(api.top_creators(_scores(spark, sf_dir), 10), "trust_label")


@query
def creator_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return api.directory_by_reputation(api.creator_directory(_scores(spark, sf_dir)))


@query
def directory_from_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The creators while the scored store is still empty."""
    nothing = _scores(spark, sf_dir).where(F.lit(False))
    tables = _tables(spark, sf_dir)
    scores = api.available_scores(nothing, tables.leaderboard, lambda: gold.serving_events(tables.features))
    return api.directory_by_reputation(api.creator_directory(scores))


@query
def directory_from_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return api.directory_from_top(api.top_creators(_scores(spark, sf_dir), 100))


@query
def timeseries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _score_view(api.all_timeseries(_scores(spark, sf_dir), 24), "recency")


@query
def timeseries_of_creator(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _score_view(api.timeseries(_scores(spark, sf_dir), "k7", 100))


@query
def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _score_view(api.alerts(_scores(spark, sf_dir), 20))


@query
def audit_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = api.audit_events(_scores(spark, sf_dir))
    return rows.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query
def creator_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = api.metrics_of(api.latest_per_creator(_scores(spark, sf_dir)))
    stamp = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return rows.withColumn("timestamp", stamp).drop("started_at")


@query
def creator_feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = api.features_of(api.latest_per_creator(_scores(spark, sf_dir)))
    return rows.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query
def creator_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bundles of all creators, read back through their nested fields."""
    bundles = api.all_bundles(_scores(spark, sf_dir), 100)
    events = F.col("recent_events")
    return bundles.select(
        "kol_id",
        "profile.name",
        "profile.reputation_score",
        "metrics.viewers",
        "metrics.trust_signal",
        F.size(events).alias("recent_rows"),
        F.element_at(events, 1)["event_id"].alias("oldest_event"),
        F.element_at(events, -1)["event_id"].alias("newest_event"),
        F.col("model_features.bot_probability").alias("bot_probability"),
    )


@query
def creator_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = api.bundle(_scores(spark, sf_dir), "k7", 100)
    return row.select("kol_id", "profile.verified", "metrics.likes", F.size("recent_events").alias("recent_rows"), "model_features.trust_score")


def _first_features(spark: SparkSession, sf_dir: str, limit: int) -> DataFrame:
    """Features of the first content rows: ranked among all rows, and then joined with their creators, of whom all
    content counts."""
    tables = _tables(spark, sf_dir)
    return silver.with_creators(tables.stored_content, tables.sizes, api.export_features(tables.stored_content, limit))


@query
def export_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return api.export_features(_first_features(spark, sf_dir, 500), 500).select(schemas.UNIFIED_FEATURE_COLUMNS)


@query
def export_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _tables(spark, sf_dir)
    whole = api.export_bundle(tables.features, tables.leaderboard, 500)
    sizes = [F.size(name).alias(f"{name}_rows") for name in ("features", "trust_scores", "events")]

    def total(part: str, field: str):
        return F.aggregate(F.col(part), F.lit(0).cast("bigint"), lambda sums, row: sums + row[field]).alias(f"{part}_{field}")

    sums = [total("features", "view_count"), total("trust_scores", "total_views"), total("events", "likes")]
    return whole.select(*sizes, *sums)


@query
def evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return api.evaluate(_first_features(spark, sf_dir, 500), 500)


# --- live feed and dashboard --------------------------------------------------------------


def _stamp_text(df: DataFrame) -> DataFrame:
    moments = [name for name in ("started_at", "timestamp") if name in df.columns]
    return df.withColumns({name: F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS") for name in moments})


@query
def live_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    window_stats = live.live_window_stats(given.live_events(spark, sf_dir))
    return _stamp_text(live.live_metrics(window_stats, given.live_sessions(spark, sf_dir)))


@query
def live_model_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    window_stats = live.live_window_stats(given.live_events(spark, sf_dir))
    return _stamp_text(live.live_model_features(window_stats, given.live_sessions(spark, sf_dir)))


@query
def last_n_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = given.live_events(spark, sf_dir)
    newest = keyed.last_n(feed, ["kol_id"], [F.desc("timestamp"), F.desc("event_id")], 20)
    return newest.select("kol_id", "event_id", "event_type", "recency")


@query
def stream_recent_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live window counts from a streamed run in several micro-batches."""
    root = scratch_path(spark, "recent")
    feed = given.live_events(spark, sf_dir)
    feed.repartitionByRange(4, "event_id").write.parquet(f"{root}/feed")
    stream = spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/feed")
    (
        stream.writeStream.foreachBatch(recent.keep_recent(f"{root}/recent"))
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return recent.read_recent_stats(spark, f"{root}/recent")


@query
def windowed_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = given.live_events(spark, sf_dir).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    rows = recent.windowed_activity(feed, "1 day")
    return rows.select(
        F.date_format("window_start", "yyyy-MM-dd").alias("day"), "kol_id", "events", "suspicious_events", "comments",
        half_up(F.col("suspicious_event_ratio"), 6).alias("suspicious_event_ratio"),
        half_up(F.col("avg_comment_sentiment"), 4).alias("avg_comment_sentiment"),
    )


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.live_summary(_scores(spark, sf_dir))


@query
def live_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamp_text(_summary(spark, sf_dir))


@query
def overview_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.overview_kpis(_summary(spark, sf_dir))


@query
def trust_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.trust_distribution(_summary(spark, sf_dir))


@query
def sentiment_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.sentiment_distribution(given.live_events(spark, sf_dir))


@query
def event_type_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.event_type_mix(given.live_events(spark, sf_dir))


@query
def anomaly_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.anomaly_totals(_summary(spark, sf_dir))


@query
def latest_tick(spark: SparkSession, sf_dir: str) -> DataFrame:
    tick = dashboard.latest_tick(given.live_events(spark, sf_dir))
    return tick.withColumn("latest_tick", F.date_format("latest_tick", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query
def ranking_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.ranking_table(_summary(spark, sf_dir))


@query
def sentiment_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.sentiment_top(_summary(spark, sf_dir))


@query
def comment_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.comment_events(given.live_events(spark, sf_dir)).drop("timestamp")


@query
def identity_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.concat(F.lit("k"), F.col("c_custkey").cast("string"))
    return given.table(spark, sf_dir, "customer").select(key.alias("kol_id"), identity_profile(key).alias("p")).select("kol_id", "p.*")


# --- sources and API items ------------------------------------------------------------------


@query
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents, line breaks and all, written as CSV and read back."""
    path = f"{scratch_path(spark, 'csv')}"
    options = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    given.table(spark, sf_dir, "documents").select(F.col("doc_id"), "lang", "text").write.options(**options).csv(path)
    rows = readers.read_csv(spark, path)
    return rows.select(safe_int(F.col("doc_id")).alias("doc_id"), "lang", F.length("text").alias("letters"), F.md5("text").alias("digest"))


@query
def json_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Video rows written as JSON lines with counts as numbers with fractions or as texts, and read back."""
    path = f"{scratch_path(spark, 'jsonl')}"
    price = F.col("o_totalprice")
    given.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("video_id"),
        price.alias("view_count"),
        F.floor(price).cast("string").alias("like_count"),
        price.cast("string").alias("comment_count"),
        F.lit(given.COLLECTED_AT).alias("collected_at"),
    ).write.json(path)
    rows = readers.read_jsonl(spark, path, schemas.RAW_YOUTUBE_VIDEOS, ordered=True)
    return rows.select("video_id", *[safe_int(F.col(name)).alias(name) for name in ("view_count", "like_count", "comment_count")])


@query
def table_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers written as a table and as JSON lines with broken letters repaired, published below another folder, and read there."""
    root, target = scratch_path(spark, "written"), scratch_path(spark, "published")
    name = given.broken_letters(F.concat(F.lit("Café "), "s_name"))
    rows = given.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), name.alias("name"), F.col("s_nationkey").alias("nation"))
    writers.write_table(rows, f"{root}/rows", ["key", "name", "missing"], partition_by=["nation"])
    writers.write_jsonl(rows, f"{root}/lines")
    writers.publish_dataset(spark, root, target, {"rows": "parquet", "lines": "json"})
    table = spark.read.parquet(f"{target}/rows").select(F.lit("rows").alias("form"), "key", "name", "nation", F.col("missing").isNull().alias("bare"))
    lines = readers.read_jsonl(spark, f"{target}/lines", "key long, name string, nation long")
    return table.unionByName(lines.select(F.lit("lines").alias("form"), "*", F.lit(True).alias("bare")))


@query
def seed_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as lines of a seed list, with comments, blanks, and names that come again."""
    path = scratch_path(spark, "seeds")
    key = F.col("c_custkey")
    line = F.when(key % 10 == 0, F.concat(F.lit("# "), key.cast("string"))).when(key % 10 == 1, F.lit("  "))
    name = F.concat(F.lit(" @creator"), (key % 700).cast("string"), F.lit(" "))
    given.table(spark, sf_dir, "customer").select(F.coalesce(line, name).alias("value")).write.text(path)
    return readers.read_seed_list(spark, path, strip="@").select("value")


@query
def json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as JSON documents: one array, one object with `records` or one single object a file, by the file's number."""
    path = scratch_path(spark, "records")
    rows = given.table(spark, sf_dir, "part").select((F.col("p_partkey") / 200).cast("long").alias("file"), F.struct(F.col("p_partkey").alias("key"), F.col("p_name").alias("name")).alias("r"))
    # A file holds 200 parts at most.
    files = rows.groupBy("file").agg(F.sort_array(F.collect_list("r")).alias("records"))
    several = F.when(F.col("file") % 3 == 0, F.to_json("records")).otherwise(F.to_json(F.struct("records")))
    value = F.when(F.col("file") % 3 == 2, F.to_json(F.element_at("records", 1))).otherwise(several)
    files.select("file", value.alias("value")).write.partitionBy("file").text(path)
    return readers.read_json_records(spark, path, "key long, name string")


@query
def api_short_video_creators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return api_items.normalize_tiktok_creators(given.short_creator_items(spark, sf_dir))


@query
def api_short_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = api_items.normalize_tiktok_videos(given.short_video_items(spark, sf_dir))
    return rows.withColumn("hashtags", F.array_join("hashtags", ","))


@query
def json_bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as JSON lines, one file for each remainder of the key; urgent ones are cut short, others have a text for a date."""
    path = scratch_path(spark, "lines")
    whole = F.to_json(F.struct("o_orderkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("day")))
    line = F.when(F.col("o_orderpriority") == "1-URGENT", F.substring(whole, 1, 20)).when(F.col("o_orderpriority") == "5-LOW", F.lit('{"day": "soon"}')).otherwise(whole)
    rows = given.table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 16).alias("part"), "o_orderkey", line.alias("value"))
    rows.repartition("part").sortWithinPartitions("part", "o_orderkey").select("part", "value").write.partitionBy("part").text(path)
    found = splits.bad_json_lines(spark, path, "o_orderkey long, o_orderstatus string, day date")
    return found.select(F.regexp_extract("file", "part=(\\d+)", 1).cast("long").alias("part"), "line", "error", "value")


@query
def api_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return api_items.normalize_channels(given.channel_items(spark, sf_dir))


@query
def api_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as video items; channels of one market segment are listed twice, the later row counts."""
    channels = api_items.normalize_channels(given.channel_items(spark, sf_dir))
    rows = api_items.normalize_videos(given.video_items(spark, sf_dir), channels)
    return rows.select("video_id", "channel_id", "channel_name", "view_count", "subscriber_count", "video_count", "trust_score", "is_suspicious")


# --- quality and statistics ---------------------------------------------------------------


def _feature_report(tables: Tables) -> DataFrame:
    return quality.check_schema(tables.features, quality.INFLUENCER_RULES, "influencer_features")


def _trust_report(tables: Tables) -> DataFrame:
    return quality.check_schema(tables.leaderboard, quality.TRUST_SCORE_RULES, "trust_scores")


@query
def quality_influencer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feature_report(_tables(spark, sf_dir))


@query
def quality_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_schema(_tables(spark, sf_dir).comments, quality.COMMENT_RULES, "comments_sentiment")


@query
def quality_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trust_report(_tables(spark, sf_dir))


@query
def quality_raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules that the given orders break in places."""
    rules = (
        quality.Rule("o_orderstatus", "string", allowed=("F", "O")),
        quality.Rule("o_totalprice", "double", low=50_000, high=400_000),
        quality.Rule("o_orderpriority", "bigint"),
        quality.Rule("o_custkey", "bigint", low=0),
        quality.Rule("o_missing", "string"),
    )
    return quality.check_schema(given.table(spark, sf_dir, "orders"), rules, "orders")


def _event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event rows as JSON lines: errors lack the platform, signups are cut short."""
    kind = F.col("event_type")
    fields = F.struct(
        "event_id",
        F.when(kind != "error", "youtube").alias("platform"),
        F.col("value").alias("engagement_rate"),
        F.lit(50.0).alias("sentiment_score"),
        F.when(kind != "click", F.lit(1.0)).alias("trust_score"),
        F.lit(given.COLLECTED_AT).alias("collected_at"),
    )
    whole = F.to_json(fields)
    line = F.when(kind == "signup", F.substring(whole, 1, 12)).otherwise(whole)
    return given.table(spark, sf_dir, "events").select(F.col("event_id").alias("line"), line.alias("value"))


@query
def quality_events_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_json_events(_event_lines(spark, sf_dir))


@query
def quality_events_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.json_events_report(_event_lines(spark, sf_dir))


@query
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The leaderboard comes from the content that the features have stored.
    tables = _tables(spark, sf_dir)
    return quality.quality_report(
        _feature_report(tables),
        quality_comments(spark, sf_dir),
        _trust_report(tables),
        quality_raw_orders(spark, sf_dir),
        quality.json_events_report(_event_lines(spark, sf_dir)),
        quality.missing_report(spark, "live_bundles"),
    )


@query
def dataset_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole build, measured while it writes its tables."""
    return build_dataset(spark, given.raw_tables(spark, sf_dir), scratch_path(spark, "dataset"))


# --- models -------------------------------------------------------------------------------


@query
def train_eval_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    splits = gold.split_rows(_features(spark, sf_dir))
    model = trust_ml.train_trust(splits["train"])
    return trust_ml.evaluate_trust(model, splits["eval"])


#: Given formulas take the place of a fit, so that every score is known beforehand.
TRUST_FORMULA = (
    "10 + least(follower_count / 100000D, 10D) + 20 * likes_per_view + 5 * comments_per_view + 5 * shares_per_view"
    " + 0.3D * sentiment_score + 0.2D * activity_score + 2 * upload_frequency - 20 * is_suspicious + if(platform = 'youtube', 5, 0)"
)
SENTIMENT_FORMULA = {
    "positive": "(1 + regexp_count(plain, 'la|th')) / CAST(3 + regexp_count(plain, 'la|th|e') AS DOUBLE)",
    "neutral": "1 / CAST(3 + regexp_count(plain, 'la|th|e') AS DOUBLE)",
    "negative": "(1 + regexp_count(plain, 'la|th|e') - regexp_count(plain, 'la|th')) / CAST(3 + regexp_count(plain, 'la|th|e') AS DOUBLE)",
}


def _stored_model(spark: SparkSession, model: PipelineModel, kind: str) -> PipelineModel:
    """The model after a way through its folder."""
    path = scratch_path(spark, f"model-{kind}")
    store.save_model(model, path, kind, "none", spark.createDataFrame([], "measure string, value double"))
    return store.load_model(spark, path)[0]


@query
def predict_trust_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = given.stream_payloads(spark, sf_dir).drop("ts", "event_id")
    predicted = scoring.predict_trust(events, trust_model=_stored_model(spark, formula.trust_formula(TRUST_FORMULA), "trust"))
    return predicted.select("video_id", *[name for name in predicted.columns if name.startswith("pred_")])


@query
def predict_sentiment_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = given.comment_lines(spark, sf_dir).select("doc_id", "line", F.col("text").alias("comment"))
    model = _stored_model(spark, formula.sentiment_formula(SENTIMENT_FORMULA), "sentiment")
    return sentiment_ml.predict_sentiment(lines, model=model).drop("comment")


@query
def trust_training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the trust model learns from; rows whose target is no number go."""
    target = F.when(F.col("is_suspicious") == 0, F.col("trust_score").cast("string")).when(F.col("platform") == "tiktok", F.lit("n/a"))
    return trust_ml.prepare(_features(spark, sf_dir).withColumn("trust_score", target)).drop("follower_growth_rate")


@query
def sentiment_training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the sentiment model learns from, by creator: hashed and empty comments are refused."""
    rows = _labelled_comments(spark, sf_dir).groupBy("platform", "creator_id", "label_name")
    return rows.agg(F.count(F.lit(1)).alias("texts"), F.sum(F.length("text")).alias("letters"))


def _labelled_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    comments = silver.without_source(given.youtube_comments(spark, sf_dir), "imported")
    return sentiment_ml.labelled_texts(silver.comment_sentiment_rows(comments, anonymize=False))


@query
def train_eval_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Stored once for both sides, so that every comment is scored once.
    train, test = sentiment_ml.stratified_split(cut_lineage(_labelled_comments(spark, sf_dir)))
    model = sentiment_ml.train_sentiment(train)
    return sentiment_ml.classification_report(sentiment_ml.predict_labels(test, model))


@query
def predict_sentiment_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = given.comment_lines(spark, sf_dir).select("doc_id", "line", F.col("text").alias("comment"))
    return sentiment_ml.predict_sentiment(lines).drop("comment")


@query
def manual_label_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentiment_ml.classification_report(_manual_pairs(spark, sf_dir), "human", "predicted")


def _manual_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Human labels against the rule sentiment of the same documents."""
    sentiment = silver.content_sentiment(given.youtube_comments(spark, sf_dir))
    human = given.table(spark, sf_dir, "labels").select(
        F.concat(F.lit("v"), F.col("doc_id").cast("string")).alias("video_id"),
        F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive").otherwise("neutral").alias("human"),
    )
    return human.join(sentiment.select("video_id", F.col("sentiment_label").alias("predicted")), "video_id")


@query
def manual_label_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentiment_ml.report_summary(_manual_pairs(spark, sf_dir), "human", "predicted")
