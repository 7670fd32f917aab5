"""Feature vectors: the entity as an index and a one-hot vector, next to the numeric inputs, all scaled."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationflow.spec import SeriesSpec
from stationflow.storage import broadcast_if_small, stage

# Output column suffixes and names.
INDEX, ONE_HOT = "_idx", "_vec"
ASSEMBLED, SCALED = "features_raw", "features"


def preparation(keys: list[str], inputs: list[str] | None = None) -> Pipeline:
    """Unfitted preparation: all ``keys`` in one indexer and one encoder, then ``inputs`` as one scaled vector.

    Indices follow falling frequency with ties by label, and unseen labels get the next one. Rows with a missing
    input are skipped; inputs are divided by their standard deviation. Without ``inputs`` only keys are encoded.
    """
    at, dense = [k + INDEX for k in keys], [k + ONE_HOT for k in keys]
    pipeline = [
        StringIndexer(inputCols=keys, outputCols=at, handleInvalid="keep"),
        OneHotEncoder(inputCols=at, outputCols=dense, handleInvalid="keep"),
    ]
    if inputs is not None:
        pipeline.append(VectorAssembler(inputCols=inputs, outputCol=ASSEMBLED, handleInvalid="skip"))
        pipeline.append(StandardScaler(inputCol=ASSEMBLED, outputCol=SCALED, withMean=False, withStd=True))
    return Pipeline(stages=pipeline)


def base_preparation(spec: SeriesSpec) -> Pipeline:
    """What all six models have in common."""
    return preparation([spec.entity], spec.feature_columns)


def fit_base(train: DataFrame, spec: SeriesSpec) -> PipelineModel:
    """The common preparation, fitted once."""
    return base_preparation(spec).fit(train)


def vector_width(vector: str) -> Column:
    """Positions of a vector."""
    v = F.unwrap_udt(vector)
    return F.when(v["type"] == 0, v["size"]).otherwise(F.size(v["values"]))


def vector_value(vector: str, at: Column) -> Column:
    """The value at a position of a vector, found among those it holds: a sparse one is not made dense."""
    v = F.unwrap_udt(vector)
    held = F.get(v["values"], F.array_position(v["indices"], at) - 1)
    return F.when(v["type"] == 0, F.coalesce(held, F.lit(0.0))).otherwise(F.get(v["values"], at))


def vector_entries(vector: str) -> Column:
    """Array of (at, x) of the values a vector holds; positions a sparse one leaves out are zero."""
    v = F.unwrap_udt(vector)
    every = F.transform(v["values"], lambda x, at: F.struct(at.alias("at"), x.alias("x")))
    held = F.zip_with(v["indices"], v["values"], lambda at, x: F.struct(at.alias("at"), x.alias("x")))
    return F.when(v["type"] == 0, held).otherwise(every)


def label_index(rows: DataFrame, key: str) -> DataFrame:
    """(key, idx) of every label: falling frequency, ties by label, from 0; null labels have none.

    The same order as the indexer of ``preparation``, which takes all labels to the driver and into every task. Here
    they stay a table: labels are counted, range-partitioned in that order, numbered inside their part, and the sizes
    of the parts before are added. Only these sizes, one row a part, meet in one task.
    """
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    order = (F.desc("_n"), F.asc(key))
    # Written, so that a part keeps its number and rows whatever is computed again.
    parts = stage(counts.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "index")
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    sizes = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_first"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    numbered = parts.withColumn("_inside", inside).join(F.broadcast(sizes), "_part")
    return numbered.select(key, (F.col("_first") + F.col("_inside")).alias("idx"))


def with_label_index(rows: DataFrame, index: DataFrame, key: str, into: str) -> DataFrame:
    """``rows`` with the index of their label; labels that are not in it, and null, get the next free number."""
    size = index.agg(F.count(F.lit(1)).alias("_unseen"))
    found = rows.join(broadcast_if_small(index.withColumnRenamed("idx", "_idx")), key, "left").join(F.broadcast(size))
    return found.withColumn(into, F.coalesce("_idx", "_unseen")).drop("_idx", "_unseen")
