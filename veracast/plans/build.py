"""The batch build: raw tables -> bronze, silver, gold and serving tables, statistics, manifest."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..operators import bronze, gold, quality, silver, stats
from ..session import cut_lineage
from ..sources import readers, writers


class Tables:
    """Bronze and silver tables of raw inputs; each is planned when first asked for."""

    def __init__(self, raw: Mapping[str, DataFrame], anonymize: bool = True) -> None:
        self.raw = raw
        self.anonymize = anonymize

    @cached_property
    def youtube_channels(self) -> DataFrame:
        return bronze.build_youtube_channels(self.raw["youtube_channels"], self.raw["youtube_channel_seeds"])

    @cached_property
    def youtube_videos(self) -> DataFrame:
        return bronze.build_youtube_videos(self.raw["youtube_videos"])

    @cached_property
    def tiktok_creators(self) -> DataFrame:
        return bronze.build_tiktok_creators(self.raw["tiktok_creators"], self.raw["tiktok_videos"])

    @cached_property
    def tiktok_videos(self) -> DataFrame:
        return bronze.build_tiktok_videos(self.raw["tiktok_videos"])

    @cached_property
    def comments(self) -> DataFrame:
        return silver.comment_sentiment_rows(self.raw["youtube_comments"], self.anonymize)

    @cached_property
    def content(self) -> DataFrame:
        """Content features without creator columns; with `sizes` enough for creator totals."""
        return silver.content_features(self.youtube_videos, self.raw["youtube_comments"], self.tiktok_videos)

    @cached_property
    def sizes(self) -> DataFrame:
        return silver.creator_sizes(self.tiktok_creators)

    @cached_property
    def stored_content(self) -> DataFrame:
        """The content features for those that read them more than once."""
        return cut_lineage(self.content)

    @cached_property
    def features(self) -> DataFrame:
        return silver.with_creators(self.stored_content, self.sizes)

    @cached_property
    def leaderboard(self) -> DataFrame:
        """Creator trust scores; from the stored content if that is there already."""
        return gold.creator_trust_scores(self.__dict__.get("stored_content", self.content), self.sizes)


RAW_FILES = {
    "youtube_channels": schemas.RAW_YOUTUBE_CHANNELS,
    "youtube_channel_seeds": schemas.RAW_YOUTUBE_SEEDS,
    "youtube_videos": schemas.RAW_YOUTUBE_VIDEOS,
    "youtube_comments": schemas.RAW_YOUTUBE_COMMENTS,
    "tiktok_creators": schemas.RAW_TIKTOK_CREATORS,
    "tiktok_videos": schemas.RAW_TIKTOK_VIDEOS,
}

# Relative path -> format of every table the build writes.
MANIFEST = {
    "bronze/youtube/channels": "parquet",
    "bronze/youtube/videos": "parquet",
    "bronze/tiktok/creators": "parquet",
    "bronze/tiktok/videos": "parquet",
    "silver/comments/sentiment": "parquet",
    "silver/comments/splits": "parquet",
    "silver/unified/features": "parquet",
    "silver/unified/splits": "parquet",
    "silver/profiles/creators": "parquet",
    "gold/features/engagement": "parquet",
    "gold/features/suspicious": "parquet",
    "gold/features/trust_scores": "parquet",
    "serving/events": "json",
}


class RawInputs(dict[str, DataFrame]):
    """Raw tables by name, with the files they come from (path -> schema)."""

    files: Mapping[str, str] = {}


def read_raw(spark: SparkSession, root: str) -> RawInputs:
    paths = {name: f"{root.rstrip('/')}/{name}.jsonl" for name in RAW_FILES}
    raw = RawInputs((name, readers.read_jsonl(spark, paths[name], schema, ordered=True)) for name, schema in RAW_FILES.items())
    raw.files = {paths[name]: schema for name, schema in RAW_FILES.items()}
    return raw


def build_dataset(spark: SparkSession, raw: Mapping[str, DataFrame], out: str, anonymize: bool = True) -> DataFrame:
    """Write all tables below `out` and return the statistics rows.

    Each layer is read back from its written files by the next one, so nothing is computed twice
    and nothing has to stay in memory. A bad line of a raw file ends the build with its file and number.
    """
    with readers.naming_bad_lines(spark, getattr(raw, "files", {})):
        return _build(spark, raw, out.rstrip("/"), anonymize)


def _build(spark: SparkSession, raw: Mapping[str, DataFrame], out: str, anonymize: bool) -> DataFrame:
    seen = stats.BuildFigures()
    keep = "first_seq"
    comments = seen.watch(raw["youtube_comments"], {("raw", "youtube_comments"): F.count(F.lit(1))})
    bronze_tables = [
        ("youtube", "channels", schemas.YOUTUBE_CHANNEL_COLUMNS, bronze.build_youtube_channels(raw["youtube_channels"], raw["youtube_channel_seeds"], seen.raw("youtube_channels"))),
        ("youtube", "videos", [*schemas.YOUTUBE_VIDEO_COLUMNS, keep], bronze.build_youtube_videos(raw["youtube_videos"], seen.raw("youtube_videos", True))),
        ("tiktok", "creators", schemas.TIKTOK_CREATOR_COLUMNS, bronze.build_tiktok_creators(raw["tiktok_creators"], raw["tiktok_videos"], seen.raw("tiktok_creators"))),
        ("tiktok", "videos", [*schemas.TIKTOK_VIDEO_COLUMNS, keep], bronze.build_tiktok_videos(raw["tiktok_videos"], seen.raw("tiktok_videos", True))),
    ]
    writes = [
        partial(writers.write_table, rows, f"{out}/bronze/{platform}/{name}", columns, watch=seen.output("clean", f"{platform}_{name}"))
        for platform, name, columns, rows in bronze_tables
    ]
    of_comments = seen.output("comments", "sentiment_rows", more=seen.splits("comment_rows"))
    rows = silver.comment_sentiment_rows(comments, anonymize)
    writes.append(partial(writers.write_table, rows, f"{out}/silver/comments/sentiment", schemas.COMMENT_SENTIMENT_COLUMNS, watch=of_comments))
    writers.together(spark, *writes)

    def written(relative: str) -> DataFrame:
        return spark.read.format(MANIFEST[relative]).load(f"{out}/{relative}")

    features = silver.unified_features(
        written("bronze/youtube/videos"),
        raw["youtube_comments"],
        written("bronze/tiktok/creators"),
        written("bronze/tiktok/videos"),
    )
    of_features = {
        ("unified", "youtube_rows"): F.count_if(F.col("platform") == "youtube"),
        ("unified", "tiktok_rows"): F.count_if(F.col("platform") == "tiktok"),
        ("unified", "suspicious_rows"): F.count_if(F.col("is_suspicious") == 1),
    }
    writers.write_table(
        features,
        f"{out}/silver/unified/features",
        [*schemas.UNIFIED_FEATURE_COLUMNS, keep],
        watch=seen.output("unified", "feature_rows", more={**of_features, **seen.splits("rows")}),
    )

    features = written("silver/unified/features")
    comments = written("silver/comments/sentiment")
    events = {("sample", "zero_view_rows"): F.count_if(F.col("views") <= 0)}
    profiles = gold.creator_profiles(gold.split_rows(features)["analysis_profile"])
    table, counted = partial(partial, writers.write_table), partial(seen.output, marked=False)
    writers.together(
        spark,
        table(gold.with_split(features), f"{out}/silver/unified/splits", schemas.UNIFIED_FEATURE_COLUMNS, partition_by=["split"]),
        table(gold.with_split(comments), f"{out}/silver/comments/splits", schemas.COMMENT_SENTIMENT_COLUMNS, partition_by=["split"]),
        table(gold.profiles_by_size(profiles), f"{out}/silver/profiles/creators", schemas.CREATOR_PROFILE_COLUMNS, watch=counted("splits", "profile_creators")),
        table(gold.engagement_features(features), f"{out}/gold/features/engagement", schemas.ENGAGEMENT_FEATURE_COLUMNS, watch=counted("features", "engagement_rows")),
        table(gold.suspicious_engagement(features), f"{out}/gold/features/suspicious", schemas.SUSPICIOUS_ENGAGEMENT_COLUMNS, watch=counted("features", "suspicious_rows")),
        table(gold.creator_trust_scores(features), f"{out}/gold/features/trust_scores", schemas.TRUST_SCORE_COLUMNS, watch=counted("features", "trust_score_rows")),
        partial(writers.write_jsonl, gold.serving_events(features), f"{out}/serving/events", watch=seen.output("sample", "serving_events", more=events)),
    )

    figures = seen.rows(spark)
    writers.write_stats(figures, f"{out}/dataset_stats", label_notice="Rule-generated labels are not ground truth.")
    writers.write_manifest(spark, MANIFEST, f"{out}/manifest")
    return figures


def validate_dataset(spark: SparkSession, out: str) -> DataFrame:
    """The quality gate over a built dataset; always gives a report, also of tables that are not there."""
    out = out.rstrip("/")
    checked = [
        ("silver/unified/features", quality.INFLUENCER_RULES, "influencer_features"),
        ("silver/comments/sentiment", quality.COMMENT_RULES, "comments_sentiment"),
        ("gold/features/trust_scores", quality.TRUST_SCORE_RULES, "trust_scores"),
    ]
    reports = []
    for relative, rules, name in checked:
        table = readers.if_there(lambda: spark.read.parquet(f"{out}/{relative}"))
        reports.append(quality.missing_report(spark, name) if table is None else quality.check_schema(table, rules, name))
    lines = readers.if_there(lambda: spark.read.text(f"{out}/serving/events"))
    reports.append(quality.missing_report(spark, "serving_events") if lines is None else quality.json_events_report(lines))
    return quality.quality_report(*reports)
