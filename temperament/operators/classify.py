"""Text classifier over constitution labels, as a Spark ML pipeline."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from temperament.fixed_values import QUESTIONS_PER_CELL
from temperament.functions.labels import label_code, label_name
from temperament.operators.sampling import first_per_group


def training_rows(
    responses: DataFrame,
    labels: list[str],
    groups: list[str],
    order: list[str],
    per_cell: int | None = QUESTIONS_PER_CELL,
) -> DataFrame:
    """Labelled responses: the first ``per_cell`` of every cell, with the label's code.

    ``per_cell`` of None takes every row, as the two-turn scores do.
    """
    cut = responses if per_cell is None else first_per_group(responses, groups, order, per_cell)
    return cut.withColumn("label", label_code(labels, F.col("constitution")).cast("double"))


def fit_classifier(rows: DataFrame, text: str, *, features: int = 1 << 14, rounds: int = 20) -> PipelineModel:
    """Fit on all words of the whole texts. The model's size depends on ``features``, not on the data."""
    stages = [
        RegexTokenizer(inputCol=text, outputCol="tokens", pattern=r"[^\p{L}\p{N}]+"),
        HashingTF(inputCol="tokens", outputCol="counts", numFeatures=features),
        IDF(inputCol="counts", outputCol="weights"),
        LogisticRegression(
            featuresCol="weights", labelCol="label", maxIter=rounds, regParam=0.01, family="multinomial"
        ),
    ]
    return Pipeline(stages=stages).fit(rows)


def classify(model: PipelineModel, rows: DataFrame, labels: list[str]) -> DataFrame:
    """Attach the predicted constitution."""
    scored = model.transform(rows)
    return scored.withColumn("predicted", label_name(labels, F.col("prediction"))).drop(
        "tokens", "counts", "weights", "rawPrediction", "probability", "prediction"
    )
