"""Rain label, next-step targets and their null handling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from stationflow.functions.scalars import depression, rain_flag
from stationflow.operators.series import Series
from stationflow.spec import CLF_LABEL, RAIN_THRESHOLD, REG_LABEL

TARGETS = ("Rain_next", "Temp_next")


def with_rain(rows: DataFrame, threshold: float = RAIN_THRESHOLD) -> DataFrame:
    return rows.withColumns(
        {"DewPointDepression": depression(), "Rain": rain_flag(depression(), threshold)}
    )


def target_columns(w: WindowSpec) -> dict[str, Column]:
    return {
        "Rain_next": F.lead("Rain", 1).over(w),
        "Temp_next": F.lead("Temperature", 1).over(w),
    }


def with_targets(series: Series) -> Series:
    """The next row's rain label and temperature within each station, and the label under its model name."""
    return series.over(target_columns, ahead=1).each(
        lambda rows: rows.withColumn(CLF_LABEL, F.col("Rain_next"))
    )


def drop_without_target(rows: DataFrame) -> DataFrame:
    return rows.dropna(subset=list(TARGETS))


def with_regression_label(rows: DataFrame) -> DataFrame:
    return rows.withColumn(REG_LABEL, F.col("Temp_next").cast("double"))
