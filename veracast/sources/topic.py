"""The event topic and its file twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import STREAM_RECORD


def kafka_source(spark: SparkSession, servers: str, topic: str, starting: str = "earliest", **options: str) -> DataFrame:
    """The topic as a stream. Needs the Kafka connector on the class path of the cluster."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.load()


def file_source(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Parquet files with the topic's columns as a stream."""
    return (
        spark.readStream.schema(STREAM_RECORD).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    )
