"""Table, JSON, statistics and publishing writers."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import has_mojibake, repair_mojibake


def cleaned(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The contract columns with every text repaired; a column the input lacks is NULL.

    One look at all texts of a row tells whether any of them needs repair, and only then are they repaired. A repair
    of its own in every column made the method for a wide table larger than the JVM compiles (8,000 bytes)."""
    kinds = dict(df.dtypes)
    chosen = list(columns or df.columns)
    texts = [name for name in chosen if kinds.get(name) == "string"]
    if texts:
        marked = has_mojibake(F.concat_ws("\n", *texts))
        df = df.withColumn("_repaired", F.when(marked, F.transform(F.array(*texts), lambda text: repair_mojibake(text))))
    repaired = F.col("_repaired")

    def clean(name: str) -> Column:
        if name not in kinds:
            return F.lit(None).cast("string").alias(name)
        if kinds[name] != "string":
            return F.col(name)
        return F.when(repaired.isNull(), F.col(name)).otherwise(repaired[texts.index(name)]).alias(name)

    return df.select([clean(name) for name in chosen])


Watch = Callable[[DataFrame], DataFrame]


def write_table(
    df: DataFrame, path: str, columns: Sequence[str], fmt: str = "parquet", partition_by: Sequence[str] = (), watch: Watch | None = None
) -> None:
    """`watch` may measure the rows as they are written."""
    rows = cleaned(df, [*columns, *[name for name in partition_by if name not in columns]])
    writer = (watch(rows) if watch else rows).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True).option("nullValue", "")
    writer.format(fmt).save(path)


def write_jsonl(df: DataFrame, path: str, append: bool = False, watch: Watch | None = None) -> None:
    """Compact JSON lines; NULL fields are written, so that every row has every key."""
    rows = cleaned(df)
    (watch(rows) if watch else rows).write.mode("append" if append else "overwrite").option("ignoreNullFields", False).json(path)


def together(spark: SparkSession, *writes: Callable[[], None]) -> None:
    """Writes that do not depend on each other, at the same time: the tasks of one fill the cores that the last
    tasks of another leave idle. The first error is raised when all have ended."""
    with ThreadPoolExecutor(max_workers=len(writes)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(write)) for write in writes]:
            done.result()


def write_stats(stats: DataFrame, path: str, **notes: str) -> None:
    """(section, metric, value) rows as one JSON document, a map per section."""
    per_section = stats.groupBy("section").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("metric", "value")))).alias("metrics")
    )
    # The statistics are a fixed list of a few dozen numbers.
    document = per_section.agg(F.map_from_entries(F.collect_list(F.struct("section", "metrics"))).alias("stats"))
    extra = [F.lit(value).alias(name) for name, value in notes.items()]
    document.select(*extra, F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("built_at"), "stats").coalesce(
        1
    ).write.mode("overwrite").json(path)


def write_manifest(spark: SparkSession, tables: dict[str, str], path: str) -> None:
    """The list of published tables and their formats."""
    rows = spark.createDataFrame(sorted(tables.items()), "table string, format string")
    rows.coalesce(1).write.mode("overwrite").json(path)


def publish_dataset(spark: SparkSession, root: str, target: str, tables: dict[str, str]) -> None:
    """Write every manifest table below another prefix (an object store or a runtime copy)."""
    for relative, fmt in tables.items():
        source = f"{root.rstrip('/')}/{relative}"
        if fmt == "json":
            # JSON lines are copied as text, field order and all.
            spark.read.text(source).write.mode("overwrite").text(f"{target.rstrip('/')}/{relative}")
        else:
            spark.read.format(fmt).load(source).write.mode("overwrite").format(fmt).save(f"{target.rstrip('/')}/{relative}")
