"""Fitted models on disk, kept under a key of their settings and training data."""

from __future__ import annotations

import hashlib

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.storage import exists

COMPLETE = "_COMPLETE"


def fingerprint(df: DataFrame, settings: str) -> str:
    """Key of (rows, settings) in one aggregate pass; row order and partitioning do not matter."""
    # 48-bit hashes added as decimals: no overflow at any row count, and repeated rows still count.
    mixed = F.shiftright(F.xxhash64(*sorted(df.columns)), 16).cast("decimal(20,0)")
    row = df.agg(F.count(F.lit(1)), F.sum(mixed)).first()
    text = f"{settings}|{sorted(df.columns)}|{row[0]}|{row[1]}"
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def model_path(root: str, task: str, name: str, key: str) -> str:
    return f"{root.rstrip('/')}/{task}_{name}_{key}"


def save_model(model: PipelineModel, path: str) -> None:
    """Replace the model at ``path``; the marker is written last, so a broken save never counts."""
    model.write().overwrite().save(path)
    sc = SparkSession.active().sparkContext
    marker = sc._jvm.org.apache.hadoop.fs.Path(f"{path}/{COMPLETE}")
    marker.getFileSystem(sc._jsc.hadoopConfiguration()).create(marker, True).close()


def load_model(spark: SparkSession, path: str) -> PipelineModel | None:
    """The stored model, or None when there is none or its save did not finish."""
    if not exists(spark, f"{path}/{COMPLETE}"):
        return None
    return PipelineModel.load(path)
