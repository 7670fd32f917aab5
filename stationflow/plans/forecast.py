"""Training and evaluation of the three classifiers and the three regressors."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.operators.evaluate import (
    confusion_matrix,
    evaluate_classification,
    evaluate_regression,
    score_value,
)
from stationflow.operators.labels import with_regression_label
from stationflow.operators.models import CLASSIFIERS, REGRESSORS, TASK_LABEL, Trainer
from stationflow.storage import delete, stage, work_dir

TIDY_METRICS = "task string, model string, metric string, value double"
MATRICES = "model string, TP bigint, FP bigint, FN bigint, TN bigint"
TASK_NAMES = {"clf": "classification", "reg": "regression"}


PREDICTIONS = "model string, label double, prediction double, score double"


def run_classification(
    trainer: Trainer, test: DataFrame, names: tuple[str, ...] = CLASSIFIERS, predictions: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Tidy metrics of all classifiers, and a confusion matrix (model, TP, FP, FN, TN) of each.

    Both are read from the written predictions; ``predictions`` names the folder that keeps them.
    """
    table = predicted_rows(trainer, test, "clf", names, predictions)
    rows, matrices = [], []
    for name in map(str.upper, names):
        part = table.where(F.col("model") == name)
        rows += [("classification", name, *r) for r in evaluate_classification(part, "label", "score").collect()]
        matrices.append((name, *confusion_matrix(part, "label").first()))
    return _tidy_frame(test.sparkSession, rows), test.sparkSession.createDataFrame(matrices, MATRICES)


def run_regression(
    trainer: Trainer, test: DataFrame, names: tuple[str, ...] = REGRESSORS, predictions: str | None = None
) -> DataFrame:
    """Tidy metrics of all regressors, read from their written predictions."""
    table = predicted_rows(trainer, with_regression_label(test), "reg", names, predictions)
    rows = []
    for name in map(str.upper, names):
        part = table.where(F.col("model") == name)
        rows += [("regression", name, *r) for r in evaluate_regression(part, "label").collect()]
    return _tidy_frame(test.sparkSession, rows)


def predicted_rows(
    trainer: Trainer, test: DataFrame, task: str, names: tuple[str, ...], folder: str | None = None
) -> DataFrame:
    """(model, label, prediction, score) of every test row and model, written once, a partition for each model.

    ``score`` is that of class one, or the prediction of a value. The vectors of the test rows are built once and
    written, as predictions are: tables outlive lost executors and hold no memory while models are measured.
    """
    spark, label = test.sparkSession, TASK_LABEL[task]
    folder = folder or f"{work_dir(spark)}/predictions-{uuid.uuid4().hex}"
    delete(spark, folder)
    models = trainer.models([(task, name) for name in names])
    vectors = None
    for name in names:
        model = models[task, name]
        if vectors is None:
            # Models of one training frame share their preparation stages.
            shared = PipelineModel(stages=model.stages[:-1])
            vectors = stage(shared.transform(test).select("features", label), "test-vectors")
        scored = model.stages[-1].transform(vectors)
        score = score_value(scored, "rawPrediction") if task == "clf" else F.col("prediction")
        scored = scored.select(F.col(label).alias("label"), "prediction", score.alias("score"))
        scored.write.parquet(f"{folder}/model={name.upper()}")
    return spark.read.schema(PREDICTIONS).parquet(folder)


def _tidy_frame(spark: SparkSession, rows: list) -> DataFrame:
    return spark.createDataFrame(rows, TIDY_METRICS)
