"""Row counts per layer, removed and repeated rows: the build statistics."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..functions.buckets import split_name
from ..functions.text import has_mojibake
from .gold import with_split

SPLITS = ("train", "eval", "analysis_profile")
_MARKED = "possible_mojibake_output_rows"


def count_possible_mojibake(df: DataFrame) -> DataFrame:
    """Rows with a marker in any text column."""
    texts = [name for name, kind in df.dtypes if kind == "string"]
    joined = df.select(F.concat_ws("\n", *texts).alias("_text"))
    return joined.agg(F.count_if(has_mojibake(F.col("_text"))).alias("rows_with_mojibake"))


def _long(df: DataFrame, section: str, names: dict[str, str]) -> DataFrame:
    """Turn the columns of a one-row frame into (section, metric, value) rows."""
    pairs = [
        F.struct(F.lit(metric).alias("metric"), F.col(column).cast("bigint").alias("value"))
        for column, metric in names.items()
    ]
    return df.select(F.explode(F.array(*pairs)).alias("_p")).select(F.lit(section).alias("section"), "_p.*")


def split_counts(rows: DataFrame, suffix: str) -> DataFrame:
    counts = with_split(rows).agg(
        F.count_if(F.col("split") == "train").alias("train"),
        F.count_if(F.col("split") == "eval").alias("eval"),
        F.count_if(F.col("split") == "analysis_profile").alias("analysis_profile"),
    )
    names = {name: f"{name}_{suffix}" for name in ("train", "eval", "analysis_profile")}
    return _long(counts, "splits", names)


class BuildFigures:
    """The build statistics, measured on rows as they pass on their way into the build's tables.

    Every `watch` hangs one observation into a plan: its sums are ready when the write that runs the
    plan has ended, and no table is read for them. `rows` must come after all watched writes.
    """

    def __init__(self) -> None:
        self._seen: list[tuple[Observation, list[tuple[str, str]]]] = []

    def watch(self, df: DataFrame, figures: Mapping[tuple[str, str], Column]) -> DataFrame:
        """`figures`: (section, metric) -> aggregate over the rows of `df`."""
        seen = Observation()
        self._seen.append((seen, list(figures)))
        return df.observe(seen, *[F.coalesce(value, F.lit(0)).cast("bigint").alias(f"m{k}") for k, value in enumerate(figures.values())])

    def raw(self, table: str, with_views: bool = False) -> Callable[[DataFrame], DataFrame]:
        """For the groups of `dedupe_latest`: raw rows, repeats and (for content) ids removed for lack of views."""
        figures = {
            ("raw", table): F.sum("_rows"),
            ("quality", f"duplicate_{table}_removed"): F.sum(F.greatest(F.col("_own") - 1, F.lit(0))),
        }
        if with_views:
            figures["quality", f"removed_zero_view_{table}"] = F.count_if((F.col("_own") > 0) & (F.col("_kept") == 0))
        return lambda groups: self.watch(groups, figures)

    def output(self, section: str, metric: str, marked: bool = True, more: Mapping[tuple[str, str], Column] | None = None) -> Callable[[DataFrame], DataFrame]:
        """For rows that are written: their number, those with a marker of a wrong decoding, and `more`."""

        def seen(rows: DataFrame) -> DataFrame:
            figures = {(section, metric): F.count(F.lit(1)), **(more or {})}
            texts = [name for name, kind in rows.dtypes if kind == "string"]
            if marked:
                figures["quality", _MARKED] = F.count_if(has_mojibake(F.concat_ws("\n", *texts)))
            return self.watch(rows, figures)

        return seen

    @staticmethod
    def splits(suffix: str) -> dict[tuple[str, str], Column]:
        split = split_name(F.col("platform"), F.col("creator_id"))
        return {("splits", f"{name}_{suffix}"): F.count_if(split == name) for name in SPLITS}

    def rows(self, spark: SparkSession) -> DataFrame:
        """(section, metric, value): a fixed list of a few dozen numbers; a metric of several tables is their sum."""
        totals: dict[tuple[str, str], int] = {}
        for seen, names in self._seen:
            for k, name in enumerate(names):
                totals[name] = totals.get(name, 0) + seen.get[f"m{k}"]
        return spark.createDataFrame([(*name, value) for name, value in totals.items()], "section string, metric string, value bigint")
