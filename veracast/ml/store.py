"""Trained models on disk: the pipeline, and what it was trained on and measured at."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

# Fixed value: what every trained model says about its labels.
NOTICE = "labels are generated by rules, not ground truth"


def save_model(model: PipelineModel, path: str, kind: str, split: str, metrics: DataFrame) -> None:
    """The model with its kind, the split it was evaluated on, and the metric rows of the evaluation
    (a handful: one row, or one row for each class)."""
    model.write().overwrite().save(f"{path}/model")
    spark = metrics.sparkSession
    rows = [row.asDict(recursive=True) for row in metrics.collect()]
    note = json.dumps({"kind": kind, "split": split, "notice": NOTICE, "metrics": rows}, sort_keys=True)
    spark.createDataFrame([(note,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, dict]:
    """The model and its metadata, as they were saved."""
    note = spark.read.text(f"{path}/metadata").first()["value"]
    return PipelineModel.load(f"{path}/model"), json.loads(note)
