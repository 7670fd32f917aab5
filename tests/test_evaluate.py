import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from stationflow.operators import evaluate as ev

# A published confusion matrix with its rounded metrics.
TP, FP, FN, TN = 135_457, 22_910, 23_987, 351_560


@pytest.fixture(scope="module")
def published(spark):
    cell = F.when(F.col("id") < TP, F.array(F.lit(1.0), F.lit(1.0)))
    cell = cell.when(F.col("id") < TP + FP, F.array(F.lit(0.0), F.lit(1.0)))
    cell = cell.when(F.col("id") < TP + FP + FN, F.array(F.lit(1.0), F.lit(0.0))).otherwise(F.array(F.lit(0.0), F.lit(0.0)))
    return spark.range(TP + FP + FN + TN).select(cell.alias("c")).select(
        F.col("c")[0].alias("label_clf"), F.col("c")[1].alias("prediction")
    )


def test_published_matrix(published):
    assert ev.confusion_matrix(published).first().asDict() == {"TP": TP, "FP": FP, "FN": FN, "TN": TN}
    row = ev.class_metrics(published).first()
    assert round(row["Accuracy"], 4) == round(row["Recall"], 4) == 0.9122
    assert round(row["Precision"], 4) == 0.9120
    assert round(row["F1-Score"], 4) == 0.9121


@pytest.mark.parametrize("shape", ["mixed", "one_class_never_said", "said_but_never_true", "three"])
def test_class_metrics_equal_the_evaluators(spark, shape):
    label, said = {
        "mixed": ("id % 3 % 2", "id % 7 % 2"),
        "one_class_never_said": ("id % 2", "0"),
        "said_but_never_true": ("0", "id % 2"),
        "three": ("id % 3", "id % 5 % 3"),
    }[shape]
    rows = spark.range(500).selectExpr(f"cast({label} as double) label_clf", f"cast({said} as double) prediction")
    row = ev.class_metrics(rows).first()
    for ours, theirs in {"Accuracy": "accuracy", "Precision": "weightedPrecision", "Recall": "weightedRecall", "F1-Score": "f1"}.items():
        expected = MulticlassClassificationEvaluator(labelCol="label_clf", metricName=theirs).evaluate(rows)
        assert row[ours] == pytest.approx(expected, abs=1e-12), ours


def test_regression_metrics_equal_the_evaluator(spark):
    rows = spark.range(500).selectExpr("cast(id % 37 as double) label_reg", "cast(id % 35 as double) + 0.5 prediction")
    found = {r["metric"]: r["value"] for r in ev.evaluate_regression(rows).collect()}
    assert list(found) == list(ev.REGRESSION_METRICS)
    for ours, theirs in {"RMSE": "rmse", "MAE": "mae", "R2": "r2"}.items():
        expected = RegressionEvaluator(labelCol="label_reg", metricName=theirs).evaluate(rows)
        assert found[ours] == pytest.approx(expected, abs=1e-10)


def test_area_under_roc_with_ties(spark):
    rows = spark.createDataFrame(
        [(1.0, 0.9), (1.0, 0.5), (0.0, 0.5), (0.0, 0.1), (1.0, 0.1)], "label_clf double, rawPrediction double"
    )
    pairs = [1, 1, 0.5, 1, 0, 0.5]  # every positive against every negative; ties count half
    assert ev.area_under_roc(rows, bins=0) == pytest.approx(sum(pairs) / 6)


def _metrics(spark, rows):
    return spark.createDataFrame(rows, "task string, model string, metric string, value double")


def test_best_models_and_comparison(spark):
    metrics = _metrics(spark, [
        ("classification", "LR", "AUC-ROC", 0.95), ("classification", "GBT", "AUC-ROC", 0.96),
        ("classification", "LR", "Accuracy", 0.91), ("classification", "GBT", "Accuracy", 0.90),
        ("regression", "LINEAR", "RMSE", 1.7), ("regression", "GBT", "RMSE", 1.6),
        ("regression", "LINEAR", "R2", 0.99), ("regression", "GBT", "R2", 0.98),
    ])
    assert {r["task"]: r["model"] for r in ev.best_models(metrics).collect()} == {"classification": "GBT", "regression": "GBT"}
    assert {r["metric"]: r["model"] for r in ev.best_per_metric(metrics).collect()} == {
        "AUC-ROC": "GBT", "Accuracy": "LR", "RMSE": "GBT", "R2": "LINEAR",
    }
    table = {r["model"]: r for r in ev.compare_models(metrics, "regression").collect()}
    assert table["GBT"]["best"] and not table["LINEAR"]["best"] and table["LINEAR"]["R2"] == 0.99
    assert {r["value"] for r in ev.printable(metrics).collect()} >= {"0.9500", "1.7000"}
