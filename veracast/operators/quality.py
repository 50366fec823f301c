"""Data-quality rules: one aggregate per table, one report row per rule."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class Rule:
    """What a column must be: its type, whether it may be NULL, allowed values or bounds."""

    column: str
    type: str
    nullable: bool = False
    allowed: Sequence | None = None
    low: float | None = None
    high: float | None = None

    def check(self) -> str:
        if self.allowed is not None:
            return "isin"
        if self.low is not None and self.high is not None:
            return "in_range"
        return "at_least" if self.low is not None else "type"

    def holds(self, value: Column) -> Column:
        if self.allowed is not None:
            return value.isin(list(self.allowed))
        held = F.lit(True)
        if self.low is not None:
            held = held & (value >= self.low)
        if self.high is not None:
            held = held & (value <= self.high)
        return held


PLATFORMS = ("youtube", "tiktok")


def _count(column: str) -> Rule:
    return Rule(column, "bigint", low=0)


def _percent(column: str) -> Rule:
    return Rule(column, "double", low=0, high=100)


INFLUENCER_RULES = (
    Rule("platform", "string", allowed=PLATFORMS),
    Rule("creator_id", "string"),
    Rule("creator_name", "string", nullable=True),
    Rule("content_id", "string"),
    _count("view_count"),
    _count("like_count"),
    _count("comment_count"),
    _count("share_count"),
    Rule("engagement_rate", "double", low=0),
    _percent("sentiment_score"),
    _percent("activity_score"),
    _percent("trust_score"),
    Rule("is_suspicious", "bigint", allowed=(0, 1)),
    Rule("label_source", "string"),
)
COMMENT_RULES = (
    Rule("platform", "string", allowed=("youtube",)),
    Rule("creator_id", "string"),
    Rule("content_id", "string"),
    Rule("comment_id", "string"),
    Rule("is_reply", "boolean"),
    Rule("comment_text_is_hashed", "boolean"),
    _count("like_count"),
    Rule("sentiment", "string", allowed=("positive", "neutral", "negative")),
    _percent("sentiment_score"),
    Rule("sentiment_source", "string"),
)
TRUST_SCORE_RULES = (
    Rule("rank", "bigint", low=1),
    Rule("platform", "string", allowed=PLATFORMS),
    Rule("creator_id", "string"),
    Rule("creator_name", "string", nullable=True),
    _count("follower_count"),
    _count("observed_content_count"),
    Rule("avg_engagement_rate", "double", low=0),
    _percent("avg_sentiment_score"),
    _percent("avg_activity_score"),
    _percent("trust_score"),
    _count("suspicious_content_count"),
    Rule("label_source", "string"),
)
EVENT_KEYS = ("collected_at", "engagement_rate", "event_id", "platform", "sentiment_score", "trust_score")


def check_schema(df: DataFrame, rules: Sequence[Rule], name: str) -> DataFrame:
    """A report row per rule: rows read, NULLs where none may be, values of the wrong type, values
    that break the rule. Extra columns are allowed; a missing column fails all rows."""
    empty = F.lit(0).cast("bigint")
    report = []
    for rule in rules:
        if rule.column not in df.columns:
            nulls, untyped, broken, known = F.count(F.lit(1)), empty, empty, False
        else:
            raw = F.col(rule.column)
            value = raw.try_cast(rule.type)
            missing = raw.isNull() | (raw.cast("string") == "")
            nulls = empty if rule.nullable else F.count_if(missing)
            untyped = F.count_if(~missing & value.isNull())
            broken = F.count_if(value.isNotNull() & ~missing & ~rule.holds(value))
            known = True
        report.append(
            F.struct(
                F.lit(rule.column).alias("column_name"),
                F.lit(rule.check()).alias("rule"),
                F.lit(known).alias("present"),
                nulls.alias("null_rows"),
                untyped.alias("type_rows"),
                broken.alias("broken_rows"),
            )
        )
    counted = df.agg(F.count(F.lit(1)).alias("row_count"), F.array(*report).alias("_report"))
    failed = F.col("null_rows") + F.col("type_rows") + F.col("broken_rows")
    return (
        counted.select("row_count", F.explode("_report").alias("_r"))
        .select(F.lit(name).alias("table_name"), "_r.*", "row_count")
        .withColumn("status", F.when(F.col("present") & (failed == 0), "ok").otherwise("failed"))
    )


def check_json_events(lines: DataFrame, value: str = "value", order: str = "line", keys: Sequence[str] = EVENT_KEYS, shown: int = 20) -> DataFrame:
    """The first `shown` bad lines with their number, the missing keys and the error."""
    bad = judged_json_events(lines, value, keys).where(~F.col("ok"))
    return bad.orderBy(order).limit(shown).select(F.col(order).alias("line"), "error", "missing")


def judged_json_events(lines: DataFrame, value: str = "value", keys: Sequence[str] = EVENT_KEYS) -> DataFrame:
    """Non-blank lines with `ok`, the parse `error` and the `missing` keys in name order."""
    wanted = F.array(*[F.lit(key) for key in sorted(keys)])
    parsed = F.try_parse_json(value).isNotNull()
    found = F.coalesce(F.json_object_keys(value), F.array().cast("array<string>"))
    judged = lines.where(F.trim(F.col(value)) != "").withColumn(
        "error", F.when(~parsed, "invalid JSON")
    )
    missing = F.when(F.col("error").isNull(), F.array_join(F.array_except(wanted, found), ","))
    return judged.withColumn("missing", missing).withColumn(
        "ok", F.col("error").isNull() & (F.col("missing") == "")
    )


def json_events_report(lines: DataFrame, name: str = "serving_events", value: str = "value") -> DataFrame:
    """One report row for the event lines."""
    counts = judged_json_events(lines, value).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(~F.col("ok")).alias("broken_rows")
    )
    zero = F.lit(0).cast("bigint")
    return counts.select(
        F.lit(name).alias("table_name"),
        F.lit("json").alias("column_name"),
        F.lit("required_keys").alias("rule"),
        F.lit(True).alias("present"),
        zero.alias("null_rows"),
        zero.alias("type_rows"),
        "broken_rows",
        "row_count",
        F.when(F.col("broken_rows") == 0, "ok").otherwise("failed").alias("status"),
    )


def missing_report(spark: SparkSession, name: str) -> DataFrame:
    """The report row of a table that is not there."""
    return spark.range(1).select(
        F.lit(name).alias("table_name"),
        F.lit("").alias("column_name"),
        F.lit("exists").alias("rule"),
        F.lit(False).alias("present"),
        *[F.lit(0).cast("bigint").alias(name) for name in ("null_rows", "type_rows", "broken_rows", "row_count")],
        F.lit("missing").alias("status"),
    )


def quality_report(*reports: DataFrame) -> DataFrame:
    """Status, rows and failed rules per table; a table that is not there is `missing`."""
    rows = reports[0]
    for report in reports[1:]:
        rows = rows.unionByName(report)
    return rows.groupBy("table_name").agg(
        F.max("row_count").alias("row_count"),
        F.count_if(F.col("status") != "ok").alias("failed_rules"),
        F.when(F.count_if(F.col("status") == "missing") > 0, "missing")
        .when(F.count_if(F.col("status") != "ok") == 0, "ok")
        .otherwise("failed")
        .alias("status"),
    )


def overall_status(report: DataFrame) -> DataFrame:
    return report.agg(
        F.when(F.count_if(F.col("status") != "ok") == 0, "ok").otherwise("failed").alias("status"),
        F.count(F.lit(1)).alias("checks"),
    )
