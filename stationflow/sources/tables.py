"""Parquet tables that count as present only when their write finished."""

from __future__ import annotations

import math

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.spec import SeriesSpec
from stationflow.storage import ROWS_PER_PARTITION, exists, stage


def save_frame(df: DataFrame, path: str) -> None:
    """Replace the table at ``path``."""
    df.write.mode("overwrite").parquet(path)


def load_frame(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``; None when it is absent, its write did not finish, or it holds no file."""
    if not exists(spark, f"{path.rstrip('/')}/_SUCCESS"):
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        # A partitioned write of no rows leaves nothing a schema could be read from.
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


def save_split(df: DataFrame, path: str) -> None:
    """Write rows in one pass, each value of the column ``split`` as a partition of the table."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def load_split(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame] | None:
    """(train, test), each reading its own partition only; None unless both were written."""
    if load_frame(spark, path) is None:
        return None
    return tuple(load_part(spark, path, part) for part in ("train", "test"))


def load_part(spark: SparkSession, path: str, part: str) -> DataFrame | None:
    """The rows of one partition, or None without a finished table."""
    table = load_frame(spark, path)
    return None if table is None else table.filter(F.col("split") == part).drop("split")


def part_sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """Rows per partition; no column is read for it."""
    table = load_frame(spark, path)
    return {} if table is None else {r["split"]: r["count"] for r in table.groupBy("split").count().collect()}


def save_bucketed(df: DataFrame, name: str, path: str, entity: str, order: tuple[str, ...], buckets: int) -> DataFrame:
    """Write ``df`` as the table ``name`` below ``path``, bucketed by entity and sorted inside; what reads it next.

    One shuffle brings the rows of a bucket into one task, so each bucket is one sorted file. Whatever is
    partitioned by the entity afterwards (windows, counts, joins with equal buckets) needs none. The catalogue keeps the
    name, so later sessions with the same catalogue find the layout again.
    """
    buckets = max(1, buckets)
    ordered = df.repartition(buckets, entity)
    writer = ordered.write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, entity).sortBy(entity, *order).saveAsTable(name)
    return df.sparkSession.table(name)


def bucket_count(rows: int) -> int:
    """Buckets for a number of rows: a bucket is read by one task."""
    return max(1, math.ceil(rows / ROWS_PER_PARTITION))


def save_by_station(df: DataFrame, path: str, spec: SeriesSpec) -> None:
    """Write rows in entity and time order, so a later read of one entity skips most row groups.

    Range partitioning cuts by rows, not by entity: a dominant station spreads over many files. The number of
    parts follows the number of rows. The rows are written as they come first, so that counting them, looking for the
    ranges and sorting do not each compute them again.
    """
    df = stage(df, "unordered")
    parts = bucket_count(df.count())
    (
        df.repartitionByRange(parts, spec.entity, *spec.order)
        .sortWithinPartitions(spec.entity, *spec.order)
        .write.mode("overwrite")
        .parquet(path)
    )


def station_rows(table: DataFrame, station: str, spec: SeriesSpec) -> DataFrame:
    """Rows of one station, pushed down to the scan."""
    return table.filter(F.col(spec.entity) == station)
