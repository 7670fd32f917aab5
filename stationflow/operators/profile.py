"""Profiles of observation tables: audits, ratios, missing values, histograms, per-station summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.functions.scalars import depression, present, rain_flag
from stationflow.spec import MEASURES, RAIN_THRESHOLD
from stationflow.storage import broadcast_if_small, stage


def summary_frame(rows: DataFrame) -> DataFrame:
    """One row per column: position, name, type and how many values are not null, in one scan."""
    counts = rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.array(
            *[
                F.struct(
                    F.lit(at).alias("position"),
                    F.lit(field.name).alias("name"),
                    F.lit(field.dataType.simpleString()).alias("type"),
                    F.count(F.col(field.name)).alias("non_null"),
                )
                for at, field in enumerate(rows.schema)
            ]
        ).alias("columns"),
    )
    return counts.select("rows", F.inline("columns"))


def audit(rows: DataFrame, kept: Column) -> DataFrame:
    """Rows before, after and removed by a filter, in one pass. Null conditions count as removed."""
    return rows.agg(
        F.count(F.lit(1)).alias("before"), F.count_if(F.coalesce(kept, F.lit(False))).alias("after")
    ).withColumn("removed", F.col("before") - F.col("after"))


def all_present(rows: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Condition under which a row survives dropping incomplete rows."""
    names = columns or rows.columns
    numeric = {f.name for f in rows.schema if f.dataType.simpleString() in ("double", "float")}
    checks = [(present(c) if c in numeric else F.col(c)).isNotNull() for c in names]
    whole = checks[0]
    for check in checks[1:]:
        whole = whole & check
    return whole


def positive_ratio(rows: DataFrame, flag: str = "Rain") -> DataFrame:
    """Positive rows, all rows and their percentage (0 for an empty input)."""
    return rows.agg(
        F.count_if(F.col(flag) == 1.0).alias("positive"), F.count(F.lit(1)).alias("rows")
    ).withColumn(
        "percent",
        F.when(F.col("rows") > 0, F.col("positive") * 100.0 / F.col("rows")).otherwise(F.lit(0.0)),
    )


def missing_profile(rows: DataFrame, columns: Sequence[str] = MEASURES) -> DataFrame:
    """Null count and percentage of every column that has nulls, in one scan for all columns."""
    counts = rows.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    return (
        counts.unpivot("rows", list(columns), "column", "missing")
        .filter(F.col("missing") > 0)
        .select("column", "missing", (F.col("missing") * 100.0 / F.col("rows")).alias("percent"))
    )


def entity_count(rows: DataFrame, entity: str = "StationID") -> DataFrame:
    return rows.agg(F.countDistinct(entity).alias("entities"))


def label_distribution(rows: DataFrame, label: str) -> DataFrame:
    return rows.groupBy(label).agg(F.count(F.lit(1)).alias("rows")).orderBy(label)


def _bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width bin number; the right edge belongs to the last bin, and a single value to the middle."""
    at = F.least(F.floor((value - low) / (high - low) * bins), F.lit(bins - 1))
    return F.when(high > low, at).otherwise(F.lit(bins // 2)).cast("int")


def histogram(values: DataFrame, measures: Sequence[str], bins: int = 60) -> DataFrame:
    """Bin counts of several measures over all rows; empty bins are not listed.

    Two scans with tiny shuffles: the first finds the bounds, one row per measure; the second puts values into
    bins where they are read and shuffles a count per bin and task.
    """
    tall = series_of_measures(values, [], measures)
    bounds = tall.groupBy("measure").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    return (
        tall.join(F.broadcast(bounds), "measure")
        .groupBy("measure", _bin(F.col("value"), F.col("low"), F.col("high"), bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def station_histogram(
    values: DataFrame, measures: Sequence[str], bins: int = 80, entity: str = "StationID"
) -> DataFrame:
    """As ``histogram``, separately for every station.

    The bounds, one row per station and measure, are written and counted before they are broadcast; more of them are
    joined by a shuffle instead. So the values are read twice, as in ``histogram``.
    """
    tall = series_of_measures(values, [entity], measures)
    bounds = tall.groupBy(entity, "measure").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    bounds = stage(bounds, "bounds")
    return (
        tall.join(broadcast_if_small(bounds), [entity, "measure"])
        .groupBy(entity, "measure", _bin(F.col("value"), F.col("low"), F.col("high"), bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def value_counts(values: DataFrame, keys: list[str], measures: Sequence[str]) -> DataFrame:
    """Rows per (keys, measure, distinct value), missing values left out."""
    tall = series_of_measures(values, keys, measures)
    return tall.groupBy(*keys, "measure", "value").agg(F.count(F.lit(1)).alias("rows"))


def series_of_measures(rows: DataFrame, keys: Sequence[str], measures: Sequence[str] = MEASURES) -> DataFrame:
    """(keys, measure, value) rows of all measures at once, missing values left out."""
    return (
        rows.select(*keys, *[present(c).alias(c) for c in measures])
        .unpivot(list(keys), list(measures), "measure", "value")
        .filter(F.col("value").isNotNull())
    )


def station_profile(
    rows: DataFrame, entity: str = "StationID", threshold: float = RAIN_THRESHOLD
) -> DataFrame:
    """Row count, mean temperature and rain percentage (of rows with a depression) per station."""
    gap = F.when(~F.isnan(depression()), depression())
    return rows.groupBy(entity).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(present("Temperature")).alias("mean_temperature"),
        (F.avg(F.when(gap.isNotNull(), rain_flag(gap, threshold))) * 100.0).alias("rain_percent"),
    )


def head_rows(rows: DataFrame, order: Sequence[str], count: int = 5) -> DataFrame:
    """The first rows in a stated order."""
    return rows.orderBy(*order).limit(count)
