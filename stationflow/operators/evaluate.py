"""Classification and regression metrics, confusion matrices and model comparison."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationflow.spec import CLF_LABEL, REG_LABEL
from stationflow.storage import stage

# Metric names of the published documents, and which way is better.
CLASSIFICATION_METRICS = ("Accuracy", "Precision", "Recall", "F1-Score", "AUC-ROC")
REGRESSION_METRICS = ("RMSE", "MAE", "R2")
LOWER_IS_BETTER = ("RMSE", "MAE")
DECIDING_METRIC = {"classification": "AUC-ROC", "regression": "RMSE"}


def confusion_counts(predictions: DataFrame, label: str = CLF_LABEL) -> DataFrame:
    """Rows per (label, prediction)."""
    return (
        predictions.groupBy(F.col(label).alias("label"), "prediction")
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy("label", "prediction")
    )


def confusion_matrix(predictions: DataFrame, label: str = CLF_LABEL) -> DataFrame:
    """TP, FP, FN and TN in one aggregate."""
    actual, said = F.col(label) == 1, F.col("prediction") == 1
    not_actual, not_said = F.col(label) == 0, F.col("prediction") == 0
    return predictions.agg(
        F.count_if(actual & said).alias("TP"),
        F.count_if(not_actual & said).alias("FP"),
        F.count_if(actual & not_said).alias("FN"),
        F.count_if(not_actual & not_said).alias("TN"),
    )


def class_metrics(predictions: DataFrame, label: str = CLF_LABEL) -> DataFrame:
    """Accuracy and class-weighted precision, recall and F1 as one row.

    One pass counts rows per (label, prediction); everything after works on those few counts. Precision, recall
    and F1 are averaged over the classes with the class sizes as weights.
    """
    counts = (
        predictions.groupBy(F.col(label).alias("label"), "prediction").agg(F.count(F.lit(1)).alias("n"))
    )
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0))
    sides = F.array(
        F.struct(
            F.col("label").alias("class"),
            F.col("n").alias("actual"),
            F.lit(0).cast("bigint").alias("said"),
            hit.cast("bigint").alias("hits"),
        ),
        F.struct(
            F.col("prediction").alias("class"),
            F.lit(0).cast("bigint").alias("actual"),
            F.col("n").alias("said"),
            F.lit(0).cast("bigint").alias("hits"),
        ),
    )
    totals = (
        counts.select(F.inline(sides))
        .groupBy("class")
        .agg(*[F.sum(c).cast("double").alias(c) for c in ("actual", "said", "hits")])
    )
    precision = F.coalesce(F.try_divide("hits", "said"), F.lit(0.0))
    # F1 of a class: harmonic mean of hits / said and hits / actual.
    harmonic = F.coalesce(F.try_divide(2 * F.col("hits"), F.col("said") + F.col("actual")), F.lit(0.0))
    rows = F.sum("actual")
    accuracy = F.sum("hits") / rows
    return totals.agg(
        accuracy.alias("Accuracy"),
        (F.sum(F.col("actual") * precision) / rows).alias("Precision"),
        accuracy.alias("Recall"),
        (F.sum(F.col("actual") * harmonic) / rows).alias("F1-Score"),
    )


def score_value(predictions: DataFrame, score: str) -> Column:
    """The score of class one as a number, from a number or a vector with a score for each class."""
    if isinstance(predictions.schema[score].dataType, VectorUDT):
        return vector_to_array(F.col(score))[1]
    return F.col(score).cast("double")


def areas_under_roc(
    predictions: DataFrame, by: list[str], label: str = CLF_LABEL, score: str = "rawPrediction"
) -> DataFrame:
    """(by, positives, negatives, AUC-ROC) of every group at once, exact by mid-ranks; null where a class is missing.

    A pair of a positive and a negative counts one where the positive scores higher and a half where both score
    alike. Rows are first added up per score; the scores are range-partitioned, each part counts the negatives
    before a score inside itself, and sums of whole parts give the rest. So no group is ranked in one task. Rows
    without score or label take no part, NaN is the largest score.
    """
    actual = F.col(label) == 1
    counts = (
        predictions.select(*by, actual.alias("_one"), score_value(predictions, score).alias("_score"))
        .dropna(subset=["_one"])
        .where(F.col("_score").isNotNull())
        .groupBy(*by, "_score")
        .agg(F.count_if("_one").alias("_pos"), F.count_if(~F.col("_one")).alias("_neg"))
    )
    # Written, so that a score stays in its part whatever is computed again.
    parts = counts.repartitionByRange(*by, "_score").withColumn("_part", F.spark_partition_id())
    parts = stage(parts, "ranks")
    ahead = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = parts.groupBy(*by, "_part").agg(F.sum("_neg").alias("_all"))
    sums = sums.select(*by, "_part", F.coalesce(F.sum("_all").over(ahead), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*by, "_part").orderBy("_score").rowsBetween(Window.unboundedPreceding, -1)
    ranked = parts.withColumn("_inside", F.coalesce(F.sum("_neg").over(inside), F.lit(0)))
    matched = _joined_nulls(ranked, sums, [*by, "_part"])
    won = F.col("_pos").cast("double") * (F.col("_before") + F.col("_inside") + F.col("_neg") / 2)
    pairs = F.sum("_pos").cast("double") * F.sum("_neg")
    return matched.groupBy(*by).agg(
        F.sum("_pos").alias("positives"),
        F.sum("_neg").alias("negatives"),
        F.when(pairs > 0, F.sum(won) / pairs).alias("AUC-ROC"),
    )


def _joined_nulls(one: DataFrame, two: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join in which null keys are equal."""
    other = two.select(*[F.col(k).alias(f"{k}_of") for k in keys], *[c for c in two.columns if c not in keys])
    same = [F.col(k).eqNullSafe(F.col(f"{k}_of")) for k in keys]
    return one.join(other, same).drop(*[f"{k}_of" for k in keys])


def area_under_roc(
    predictions: DataFrame, label: str = CLF_LABEL, score: str = "rawPrediction", bins: int | None = None
) -> float | None:
    """AUC, exact by mid-ranks; with ``bins``, by the evaluator of Spark ML over that many bins (0: all scores)."""
    if bins is None:
        row = areas_under_roc(predictions.withColumn("_every", F.lit(0)), ["_every"], label, score).first()
        return None if row is None else row["AUC-ROC"]
    return BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol=score, metricName="areaUnderROC", numBins=bins
    ).evaluate(predictions)


def evaluate_classification(
    predictions: DataFrame,
    label: str = CLF_LABEL,
    score: str = "rawPrediction",
    bins: int | None = None,
) -> DataFrame:
    """Tidy (metric, value) rows of the five classification metrics; the area is exact unless ``bins`` is given."""
    area = area_under_roc(predictions, label, score, bins)
    row = class_metrics(predictions, label).withColumn("AUC-ROC", F.lit(area).cast("double"))
    return _tidy(row, CLASSIFICATION_METRICS)


def grouped_metrics(table: DataFrame, task: str, by: str = "model") -> DataFrame:
    """Tidy (by, metric, value) of all models at once, from a table (by, label, prediction, score).

    One grouped aggregate over the rows; classes are told apart inside it, and the areas come from one more pass.
    Labels are 0 and 1.
    """
    label, said = F.col("label"), F.col("prediction")
    if task == "regression":
        error = label - said
        wide = table.groupBy(by).agg(
            F.sqrt(F.avg(error * error)).alias("RMSE"),
            F.avg(F.abs(error)).alias("MAE"),
            (1 - F.try_divide(F.sum(error * error), F.regr_syy(label, F.lit(1.0)))).alias("R2"),
        )
        return wide.unpivot([by], list(REGRESSION_METRICS), "metric", "value")
    cell = {(a, p): F.count_if((label == a) & (said == p)).cast("double").alias(f"n{a}{p}") for a in (0, 1) for p in (0, 1)}
    sums = table.groupBy(by).agg(*cell.values())
    n = {key: F.col(f"n{key[0]}{key[1]}") for key in cell}
    rows = sum(n.values(), F.lit(0.0))
    actual = {c: n[c, 0] + n[c, 1] for c in (0, 1)}
    told = {c: n[0, c] + n[1, c] for c in (0, 1)}
    precision = {c: F.coalesce(F.try_divide(n[c, c], told[c]), F.lit(0.0)) for c in (0, 1)}
    recall = {c: F.coalesce(F.try_divide(n[c, c], actual[c]), F.lit(0.0)) for c in (0, 1)}
    harmonic = {
        c: F.coalesce(F.try_divide(2 * precision[c] * recall[c], precision[c] + recall[c]), F.lit(0.0)) for c in (0, 1)
    }
    weighted = lambda of: (actual[0] * of[0] + actual[1] * of[1]) / rows
    wide = sums.select(
        by,
        ((n[0, 0] + n[1, 1]) / rows).alias("Accuracy"),
        weighted(precision).alias("Precision"),
        weighted(recall).alias("Recall"),
        weighted(harmonic).alias("F1-Score"),
    )
    areas = areas_under_roc(table, [by], "label", "score").select(by, "AUC-ROC")
    wide = wide.join(areas, by, "left")
    return wide.unpivot([by], [F.col(f"`{m}`") for m in CLASSIFICATION_METRICS], "metric", "value")


def evaluate_regression(predictions: DataFrame, label: str = REG_LABEL) -> DataFrame:
    """Tidy (metric, value) rows of RMSE, MAE and R2 from one aggregate.

    R2 is null where the labels do not vary: there is nothing to explain.
    """
    error = F.col(label) - F.col("prediction")
    row = predictions.agg(
        F.sqrt(F.avg(error * error)).alias("RMSE"),
        F.avg(F.abs(error)).alias("MAE"),
        (F.lit(1.0) - F.try_divide(F.avg(error * error), F.var_pop(label))).alias("R2"),
    )
    return _tidy(row, REGRESSION_METRICS)


def _tidy(row: DataFrame, names: tuple[str, ...]) -> DataFrame:
    return row.unpivot([], [F.col(f"`{n}`") for n in names], "metric", "value")


def better_value(metric: Column, value: Column) -> Column:
    """``value`` turned so that larger is always better; null where it is no number."""
    return F.when(~F.isnan(value), F.when(metric.isin(*LOWER_IS_BETTER), -value).otherwise(value))


def _winner() -> Column:
    """Model and value of the best rank; of equal ranks the first name, and a model without a number comes last."""
    rank = better_value(F.col("metric"), F.col("value"))
    return F.min(F.struct(rank.isNull().alias("none"), (-rank).alias("place"), "model", "value"))


def best_models(metrics: DataFrame) -> DataFrame:
    """Per task the model that wins on its deciding metric (largest AUC, smallest RMSE)."""
    deciding = F.create_map(*[F.lit(x) for pair in DECIDING_METRIC.items() for x in pair])
    return (
        metrics.filter(F.col("metric") == deciding[F.col("task")])
        .groupBy("task", "metric")
        .agg(_winner().alias("best"))
        .select("task", "metric", "best.model", "best.value")
    )


def best_per_metric(metrics: DataFrame) -> DataFrame:
    """The winning model of every single metric."""
    best = metrics.groupBy("task", "metric").agg(_winner().alias("best"))
    return best.select("task", "metric", "best.model", "best.value")


def compare_models(metrics: DataFrame, task: str) -> DataFrame:
    """One row per model with a column per metric and a mark on the best one."""
    names = CLASSIFICATION_METRICS if task == "classification" else REGRESSION_METRICS
    wide = (
        metrics.filter(F.col("task") == task)
        .groupBy("model")
        .pivot("metric", list(names))
        .agg(F.first("value"))
    )
    deciding = DECIDING_METRIC[task]
    # A row per model: the whole table is a handful of rows.
    top = F.max(better_value(F.lit(deciding), F.col(f"`{deciding}`"))).over(Window.partitionBy())
    own = better_value(F.lit(deciding), F.col(f"`{deciding}`"))
    return wide.withColumn("best", F.coalesce(own == top, F.lit(False)))


def printable(metrics: DataFrame) -> DataFrame:
    """Metric values as text with four decimals."""
    return metrics.withColumn("value", F.format_string("%.4f", "value"))
