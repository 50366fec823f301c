"""Micro-batch sinks. Every batch owns the partitions (event_date, batch_id) it writes, so that a
batch that runs again replaces its own output instead of adding to it. The keyed table is folded from time
to time: closed batches become one, so that neither its files nor the cost of a read grow with the
number of batches."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..schemas import RAW_LAKE_COLUMNS, SERVING_COLUMNS
from .compaction import compact_lake


#: Batches between two folds of the keyed table.
FOLD_EVERY = 50


@dataclass(frozen=True)
class LakePaths:
    raw: str
    processed: str
    serving: str
    keyed: str | None = None


def _replace_batch(rows: DataFrame, path: str, fmt: str) -> None:
    # Rows of a date meet in a few tasks, as many as their volume asks for, and make as many files.
    (
        rows.hint("rebalance", "event_date").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date", "batch_id")
        .format(fmt)
        .save(path)
    )


def raw_lake_sink(batch: DataFrame, path: str) -> None:
    _replace_batch(batch.select(*RAW_LAKE_COLUMNS, "batch_id"), path, "json")


def processed_lake_sink(batch: DataFrame, path: str) -> None:
    _replace_batch(batch.drop("raw_payload"), path, "parquet")


def serving_lake_sink(batch: DataFrame, path: str) -> None:
    _replace_batch(batch.select(*SERVING_COLUMNS, "event_date", "batch_id"), path, "parquet")


def latest_by_key(rows: DataFrame) -> DataFrame:
    """One row per (kol_id, event_ts): the last one written."""
    keys = ["kol_id", "event_ts"]
    order = [name for name in ("batch_id", "kafka_partition", "kafka_offset") if name in rows.columns]
    others = [name for name in rows.columns if name not in keys]
    return (
        rows.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("_row")).select(*keys, "_row.*")
    )


def serving_upsert(batch: DataFrame, path: str) -> None:
    """Upsert on (kol_id, event_ts): the batch writes its last row per key, and reading keeps the
    row of the newest batch. No stored file is rewritten, so a lost task or driver loses nothing."""
    rows = latest_by_key(batch).select(*SERVING_COLUMNS, "kafka_partition", "kafka_offset", "event_date", "batch_id")
    _replace_batch(rows, path, "parquet")


def connector_upsert(batch: DataFrame, fmt: str, options: dict[str, str]) -> None:
    """The same upsert through a store's own connector, which must overwrite on its key."""
    latest_by_key(batch).select(SERVING_COLUMNS).write.format(fmt).mode("append").options(**options).save()


def read_keyed(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """The keyed table: last write per key. `since` prunes event dates before anything is read."""
    rows = spark.read.parquet(path)
    if since is not None:
        rows = rows.where(F.col("event_date") >= F.lit(since).cast("date"))
    return latest_by_key(rows).select(*SERVING_COLUMNS)


def replace_closed(folded: DataFrame, path: str, keys: list[str], closed: DataFrame) -> None:
    """Write `folded` rows into the partitions they name and remove the `closed` partitions (one row of
    partition values each). The rows are stored beside the table first. If the job ends in between,
    old and folded rows are both there, which readers resolve, and the next fold goes on."""
    spark = folded.sparkSession
    folded.write.mode("overwrite").parquet(f"{path}_folding")
    rows = spark.read.schema(folded.schema).parquet(f"{path}_folding")
    doomed = closed.collect()  # partition names, a bounded number of batches for each date
    rows.hint("rebalance", *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for row in doomed:
        files.delete(hadoop("/".join([path, *(f"{key}={row[key]}" for key in keys)])), True)
    files.delete(hadoop(f"{path}_folding"), True)


def fold_keyed(spark: SparkSession, path: str, before: int) -> None:
    """One batch in place of all batches lower than `before`, for the dates that more than one of them
    wrote. Only closed batches take part: a batch that may still run again has a higher number."""
    rows = spark.read.parquet(path).where(F.col("batch_id") < before)
    parts = rows.select("event_date", "batch_id").distinct()
    dates = parts.groupBy("event_date").agg(F.count(F.lit(1)).alias("batches")).where("batches > 1").select("event_date")
    if dates.isEmpty():
        return
    folded = latest_by_key(rows.join(F.broadcast(dates), "event_date", "left_semi")).withColumn("batch_id", F.lit(before - 1).cast("bigint"))
    closed = parts.where(F.col("batch_id") < before - 1).join(F.broadcast(dates), "event_date", "left_semi")
    replace_closed(folded, path, ["event_date", "batch_id"], closed)


def write_batch(paths: LakePaths, fold_every: int = FOLD_EVERY, compact_every: int | None = None):
    """The `foreachBatch` function: four writes of one cached batch; empty batches write nothing.
    Before every `fold_every`-th batch the closed batches of the keyed table are folded, before every
    `compact_every`-th those of the lake tables are packed, which are then read by `compaction.read_lake`."""

    def write(batch_df: DataFrame, batch_id: int) -> None:
        if batch_df.isEmpty():
            return
        if compact_every and batch_id and batch_id % compact_every == 0:
            for path, fmt in ((paths.raw, "json"), (paths.processed, "parquet"), (paths.serving, "parquet")):
                compact_lake(batch_df.sparkSession, path, batch_id, fmt)
        if paths.keyed and batch_id and batch_id % fold_every == 0:
            fold_keyed(batch_df.sparkSession, paths.keyed, batch_id)
        batch = batch_df.withColumn("batch_id", F.lit(batch_id).cast("bigint")).persist()
        try:
            raw_lake_sink(batch, paths.raw)
            processed_lake_sink(batch, paths.processed)
            serving_lake_sink(batch, paths.serving)
            if paths.keyed:
                serving_upsert(batch, paths.keyed)
        finally:
            batch.unpersist()

    return write


def start_scoring(
    scored: DataFrame, paths: LakePaths, checkpoint: str, available_now: bool = False, fold_every: int = FOLD_EVERY, compact_every: int | None = None
):
    writer: DataStreamWriter = (
        scored.writeStream.foreachBatch(write_batch(paths, fold_every, compact_every))
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
