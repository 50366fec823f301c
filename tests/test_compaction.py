"""Lake tables stay in few files, and readers see each row once at any moment."""

import datetime

import pytest
from pyspark.sql import functions as F

from veracast.streaming import compaction


def batch(spark, path, number, fmt="parquet", dates=3, rows=4):
    found = spark.range(rows * dates).select(
        (F.col("id") + 1000 * number).alias("n"),
        F.when(F.col("id") % dates > 0, F.date_add(F.lit(datetime.date(2024, 1, 1)), (F.col("id") % dates).cast("int"))).alias("event_date"),
        F.lit(number).cast("bigint").alias("batch_id"),
    )
    found.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date", "batch_id").format(fmt).save(path)
    return {r.n for r in found.collect()}


def numbers(spark, path, fmt="parquet", manifest=None):
    return sorted(r.n for r in compaction.read_lake(spark, path, fmt, manifest).select("n").collect())


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_many_batches_few_files(spark, tmp_path, fmt):
    path, expected = str(tmp_path / "lake"), set()
    for number in range(14):
        if number and number % 5 == 0:
            before = compaction.read_lake(spark, path, fmt).select("n")  # planned before, read after
            old = set(expected)
            compaction.compact_lake(spark, path, number, fmt)
            assert sorted(r.n for r in before.collect()) == sorted(old)
        expected |= batch(spark, path, number, fmt)
    # The last batch runs again after a compaction that left it out.
    compaction.compact_lake(spark, path, 13, fmt)
    expected |= batch(spark, path, 13, fmt)
    assert numbers(spark, path, fmt) == sorted(expected)
    manifest = compaction.compact_lake(spark, path, 14, fmt)
    assert numbers(spark, path, fmt) == sorted(expected) and len(manifest.packed) == 3
    compaction.compact_lake(spark, path, 14, fmt)  # clears what was replaced
    assert numbers(spark, path, fmt) == sorted(expected)
    assert len(list((tmp_path / "lake").rglob("batch_id=*"))) == 3
    assert compaction.compact_lake(spark, path, 14, fmt).version == compaction.newest_manifest(spark, path).version


def test_full_files_stay_and_broken_runs_do_no_harm(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "lake")
    expected = set().union(*(batch(spark, path, k, rows=200) for k in range(4)))
    # The run ends after its rows are written and before the manifest is switched.
    with monkeypatch.context() as broken:
        broken.setattr(compaction, "_switch", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            compaction.compact_lake(spark, path, 4)
    assert numbers(spark, path) == sorted(expected)
    first = compaction.compact_lake(spark, path, 4, target=2500)
    assert numbers(spark, path) == sorted(expected)
    assert all(len(list((tmp_path / "lake" / name).glob("part-*"))) >= 1 for name in first.packed)
    # Files of the target size are not packed again.
    again = compaction.compact_lake(spark, path, 4, target=1)
    assert again.packed == first.packed and not again.replaced and numbers(spark, path) == sorted(expected)
    with pytest.raises(RuntimeError):
        compaction._switch(spark, path, again)
