"""What the operators of this subpackage share: clean inputs, Arrow stages, stored intermediate tables."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veracast.session import scratch_path

#: Words are the runs between these white-space characters.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Of a batch that comes in, so many bytes are worked on at once.
SLICE_BYTES = 8 << 20
_HELD: dict = {}
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def texts(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Only (doc_id, text): other columns, whatever their names, stay out; a null text is empty."""
    return df.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


def held(key: tuple, build: Callable[[], Any]) -> Any:
    """What an operator keeps in a worker process between tasks (tables, remembered words). A worker
    keeps this for one operator only: the next one takes the place."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = build()
    return _HELD[key]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def arrow_stage(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | T.StructType) -> DataFrame:
    """`work` on each Arrow batch of `df`, inside the task that has it, some megabytes at a time."""

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = max(1, batch.num_rows * SLICE_BYTES // max(1, batch.nbytes))
            for at in range(0, batch.num_rows, rows):
                yield work(batch.slice(at, rows))

    return partition_stage(df, stage, schema)


def _workers_find_package(spark: SparkSession) -> None:
    """The workers find this package where the driver has it; on a cluster without that path it comes by --py-files."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, _ROOT])


def returning_memory(spark: SparkSession) -> None:
    """Workers started from now on give large freed arrays back to the system at once instead of keeping
    them for later: for operators whose stages need much memory one after the other."""
    spark.sparkContext.environment.update({"MALLOC_MMAP_THRESHOLD_": str(1 << 20), "ARROW_DEFAULT_MEMORY_POOL": "system"})


def partition_stage(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """`work` on the batches of each partition."""
    _workers_find_package(df.sparkSession)
    return df.mapInArrow(work, schema)


def arrow_column(spark: SparkSession, work: Callable[[pa.Array], pa.Array], kind: str) -> Callable[[Column], Column]:
    """A column made by `work` from another one, some megabytes at a time. Only that column goes to the
    Python worker and only the result comes back; the rest of the row waits in the JVM."""
    _workers_find_package(spark)

    def column(values: pa.Array) -> pa.Array:
        step = max(1, len(values) * SLICE_BYTES // max(1, values.nbytes))
        return pa.concat_arrays([work(values.slice(at, step)) for at in range(0, len(values), step)] or [work(values)])

    return F.arrow_udf(column, kind)


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` as a Parquet table in the shared folder: it outlives a lost executor and is computed once."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_key() -> Column:
    """A number of a row's doc_id, null or not, and its text: rows alike in both have one, rows that only share an id do not."""
    own = F.col("doc_id").cast("long")
    return F.xxhash64(own.isNull(), F.coalesce(own, F.lit(0).cast("long")), F.coalesce(F.col("text").cast("string"), F.lit("")))


def keep_rows(docs: DataFrame, kept: DataFrame, key: Column) -> DataFrame:
    """The documents whose `key` is in the only column of `kept`, one row for each key, that with the longest
    text, with their own columns only."""
    found = _keyed_rows(docs, key).join(kept.toDF("__key").distinct(), "__key", "left_semi")
    text = F.coalesce(F.col("document.text").cast("string"), F.lit(""))
    longest = F.max_by("document", F.struct(F.length(text), F.xxhash64(text)))
    return found.groupBy("__key").agg(longest.alias("document")).select("document.*")


def drop_rows(docs: DataFrame, gone: DataFrame, key: Column) -> DataFrame:
    """The documents whose `key` is not in the only column of `gone`, with their own columns only."""
    return _keyed_rows(docs, key).join(gone.toDF("__key").distinct(), "__key", "left_anti").select("document.*")


def _keyed_rows(docs: DataFrame, key: Column) -> DataFrame:
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"), key.alias("__key"))


def text_list(column: pa.Array | pa.ChunkedArray) -> list[str]:
    return column.to_pylist()


def byte_list(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8 bytes, without a way through str."""
    return column.cast(pa.binary()).to_pylist()
