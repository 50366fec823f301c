"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "veracast", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC timestamps and runtime re-planning; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The reliable folder the cluster names in `spark.checkpoint.dir`; where it names none, a folder
    in the warehouse. A warehouse on a machine's own disk serves a local session only."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if warehouse.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share: the warehouse is on a local disk")
    return f"{warehouse.rstrip('/')}/_scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder. What is written there goes when the session ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store `df` as Parquet in the shared folder, so that losing an executor does not lose it. Later
    reads take only the columns they need."""
    path = scratch_path(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def balanced(df: DataFrame) -> DataFrame:
    """Even partitions for rows that an iterative fit reads many times."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
