"""Compaction of lake tables that grow by one partition for each date and batch.

Small closed partitions of a date are packed into files of a target size in a partition of their own, whose
batch number is negative. A manifest beside the data says which packed partitions count and which
partitions they replace; it is switched by one rename. Readers follow the newest manifest, so they see the rows before or
after a compaction, never both and never neither; a partition's files go only with the compaction after the one that replaced it, when
readers that began before the switch have had its whole interval to end.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

TARGET_BYTES = 128 << 20
_MANIFESTS = "_compacted"
_NONE_DATE = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Manifest:
    """Partitions by name, `event_date=.../batch_id=...`."""

    version: int = 0
    packed: list[str] = field(default_factory=list)  # these count although their number is negative
    replaced: list[str] = field(default_factory=list)  # these do not count any more


class Folder:
    """The few file operations that a manifest needs, on whatever store the path names."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path = path.rstrip("/")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._files = self._hadoop(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self._hadoop(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str) -> list[str]:
        return [s.getPath().getName() for s in self._files.listStatus(self.at(name))] if self._files.exists(self.at(name)) else []

    def size(self, name: str) -> int:
        return self._files.getContentSummary(self.at(name)).getLength()

    def delete(self, name: str) -> None:
        self._files.delete(self.at(name), True)

    def rename(self, old: str, new: str) -> bool:
        return self._files.rename(self.at(old), self.at(new))


def newest_manifest(spark: SparkSession, path: str) -> Manifest:
    folder = Folder(spark, path)
    versions = sorted(name for name in folder.names(_MANIFESTS) if name.startswith("v"))
    if not versions:
        return Manifest()
    return Manifest(**json.loads(spark.read.text(f"{folder.path}/{_MANIFESTS}/{versions[-1]}").first()["value"]))


def _switch(spark: SparkSession, path: str, manifest: Manifest) -> None:
    """The manifest becomes the newest one by a rename; a name that another writer has taken already is an error."""
    folder = Folder(spark, path)
    name = f"{_MANIFESTS}/v{manifest.version:09d}"
    folder.delete(f"{name}.next")
    line = spark.createDataFrame([(json.dumps(asdict(manifest)),)], "value string")
    line.coalesce(1).write.text(f"{folder.path}/{name}.next")
    if name.rsplit("/", 1)[1] in folder.names(_MANIFESTS) or not folder.rename(f"{name}.next", name):
        raise RuntimeError(f"{name} is there already: another compaction of {path} has run")
    for old in sorted(n for n in folder.names(_MANIFESTS) if n.startswith("v") and not n.endswith(".next"))[:-10]:
        folder.delete(f"{_MANIFESTS}/{old}")


def _name() -> Column:
    date = F.coalesce(F.col("event_date").cast("string"), F.lit(_NONE_DATE))
    return F.concat(F.lit("event_date="), date, F.lit("/batch_id="), F.col("batch_id").cast("string"))


def read_lake(spark: SparkSession, path: str, fmt: str = "parquet", manifest: Manifest | None = None) -> DataFrame:
    """The table as its newest manifest has it (or the one given). Which partitions count is settled before any file is read."""
    known = manifest or newest_manifest(spark, path)
    counts = F.col("batch_id") >= 0
    if known.replaced:
        counts = counts & ~_name().isin(known.replaced)
    if known.packed:
        counts = counts | _name().isin(known.packed)
    return spark.read.format(fmt).load(path).where(counts)


def small_partitions(spark: SparkSession, path: str, before: int, target: int, manifest: Manifest) -> dict[str, dict[str, int]]:
    """Date -> partition -> bytes: those that count, are closed (number lower than `before`) and do not fill a file, where a date has several."""
    folder = Folder(spark, path)
    found: dict[str, dict[str, int]] = {}
    for date in folder.names(""):
        for batch in folder.names(date) if date.startswith("event_date=") else []:
            name, number = f"{date}/{batch}", int(batch.removeprefix("batch_id="))
            closed = name in manifest.packed if number < 0 else number < before and name not in manifest.replaced
            if closed and (size := folder.size(name)) < target:
                found.setdefault(date, {})[name] = size
    return {date: parts for date, parts in found.items() if len(parts) > 1}


def compact_lake(spark: SparkSession, path: str, before: int, fmt: str = "parquet", target: int = TARGET_BYTES) -> Manifest:
    """Pack the small partitions of batches lower than `before`. Only closed batches take part: a batch that may
    still run again has a higher number and replaces its own partition as ever.

    Full files are left alone, so a row is written anew only while its file is small. A compaction
    that fails leaves packed partitions that no manifest names; the next one writes over them."""
    now = newest_manifest(spark, path)
    folder = Folder(spark, path)
    for name in now.replaced:  # readers from before the last switch have ended
        folder.delete(name)
    small = small_partitions(spark, path, before, target, now)
    if not small and not now.replaced:
        return now
    number = -(now.version + 1)
    packed: list[str] = []
    replaced = sorted(name for parts in small.values() for name in parts)
    if small:
        rows = read_lake(spark, path, fmt, now).where(_name().isin(replaced))
        # So many files a date as its bytes fill; the list has one number for each date.
        files = {date.removeprefix("event_date="): -(-sum(parts.values()) // target) for date, parts in small.items()}
        wanted = F.create_map(*[F.lit(x) for pair in files.items() for x in pair])
        date = F.coalesce(F.col("event_date").cast("string"), F.lit(_NONE_DATE))
        part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), F.element_at(wanted, date))
        columns = rows.columns
        dealt = rows.withColumn("_part", part).repartition(sum(files.values()), "event_date", "_part").select(*columns)
        (
            dealt.withColumn("batch_id", F.lit(number).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("event_date", "batch_id")
            .format(fmt)
            .save(path)
        )
        packed = [f"{date}/batch_id={number}" for date in small]
    kept = [name for name in now.packed if name not in replaced]
    manifest = Manifest(now.version + 1, sorted(kept + packed), replaced)
    _switch(spark, path, manifest)
    return manifest
