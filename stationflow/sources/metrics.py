"""The metrics document: nested JSON on disk, tidy rows in Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.storage import exists

TASKS = ("classification", "regression")
METRICS_DDL = (
    "classification map<string, map<string, double>>, regression map<string, map<string, double>>, "
    "train_count bigint, test_count bigint, notebook string"
)
# Short metric names some writers use.
METRIC_ALIASES = {"AUC": "AUC-ROC", "F1": "F1-Score"}


def metrics_document(
    metrics: DataFrame, train_count: int, test_count: int, tag: str | None = None
) -> DataFrame:
    """One row holding the whole document, from tidy (task, model, metric, value) rows.

    The rows are one per model and metric, so the document is small whatever the data size.
    """
    per_model = metrics.groupBy("task", "model").agg(
        F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("values")
    )
    whole = per_model.agg(
        *[
            F.map_from_entries(
                F.collect_list(F.when(F.col("task") == task, F.struct("model", "values")))
            ).alias(task)
            for task in TASKS
        ]
    )
    counts = {
        "train_count": F.lit(train_count).cast("bigint"),
        "test_count": F.lit(test_count).cast("bigint"),
    }
    if tag is not None:
        counts["notebook"] = F.lit(tag)
    return whole.withColumns(counts)


def save_metrics(
    metrics: DataFrame, path: str, train_count: int, test_count: int, tag: str | None = None
) -> None:
    """Write the document as a single JSON line."""
    metrics_document(metrics, train_count, test_count, tag).coalesce(1).write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame | None:
    """The document as written, or None when there is none."""
    if not exists(spark, path):
        return None
    return spark.read.schema(METRICS_DDL).option("multiLine", True).json(path)


def tidy_metrics(document: DataFrame) -> DataFrame:
    """Tidy (task, model, metric, value) rows; short metric names are read as their long form."""
    entries = F.concat(*[_task_entries(task) for task in TASKS])
    rows = document.select(F.inline(entries)).select("task", "model", F.explode("values").alias("metric", "value"))
    return rows.withColumn("metric", F.coalesce(_alias_map()[F.col("metric")], F.col("metric")))


def _task_entries(task: str) -> Column:
    none = F.array().cast("array<struct<key: string, value: map<string, double>>>")
    return F.transform(
        F.coalesce(F.map_entries(task), none),
        lambda e: F.struct(F.lit(task).alias("task"), e["key"].alias("model"), e["value"].alias("values")),
    )


def _alias_map() -> Column:
    return F.create_map(*[F.lit(x) for pair in METRIC_ALIASES.items() for x in pair])
