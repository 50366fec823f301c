"""Models given by a formula instead of a fit: saved, loaded and applied like trained ones.

They serve where scores must be known beforehand, as a stand-in until a model is trained, and to check everything around a model."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, StringIndexerModel, VectorAssembler

from .sentiment import LABEL_TO_SCORE


def trust_formula(prediction: str) -> PipelineModel:
    """A trust model whose prediction is an SQL expression over the feature columns."""
    return PipelineModel(stages=[SQLTransformer(statement=f"SELECT *, CAST({prediction} AS DOUBLE) AS prediction FROM __THIS__")])


def sentiment_formula(chances: dict[str, str]) -> PipelineModel:
    """A sentiment model whose chance of each class is an SQL expression over `plain`, the text in lower case
    without accents."""
    names = sorted(LABEL_TO_SCORE)
    labels = StringIndexerModel.from_labels(names, inputCol="label_name", outputCol="label", handleInvalid="skip")
    columns = ", ".join(f"CAST({chances[name]} AS DOUBLE) AS chance_{name}" for name in names)
    best = "array_position(array({0}), greatest({0})) - 1".format(", ".join(f"chance_{name}" for name in names))
    return PipelineModel(
        stages=[
            labels,
            SQLTransformer(statement=f"SELECT *, CAST({best} AS DOUBLE) AS prediction FROM (SELECT *, {columns} FROM __THIS__)"),
            VectorAssembler(inputCols=[f"chance_{name}" for name in names], outputCol="probability"),
        ]
    )
