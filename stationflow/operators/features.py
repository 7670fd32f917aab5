"""Lag, rolling and change features per station."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from stationflow.functions.calendar import calendar_columns
from stationflow.functions.scalars import depression
from stationflow.operators.series import Series
from stationflow.spec import SeriesSpec

# Feature name prefix, measure and row offsets or frame lengths.
LAGS = (
    ("Temp", "Temperature", (1, 3, 6, 24)),
    ("DewPoint", "DewPoint", (1,)),
    ("Pressure", "Pressure", (1,)),
    ("WindSpeed", "WindSpeed", (1,)),
    ("Rain", "Rain", (1, 3)),
)
ROLLING_MEANS = (
    ("Temp", "Temperature", (6, 24)),
    ("DewPoint", "DewPoint", (6,)),
    ("Pressure", "Pressure", (6,)),
)
ROLLING_SUMS = (("Rain", "Rain", (6, 24)),)
CHANGES = (("Temp", "Temperature"), ("DewPoint", "DewPoint"), ("Pressure", "Pressure"))
DEEPEST = 24


def lag_columns(w: WindowSpec) -> dict[str, Column]:
    """Values of earlier rows; offsets count rows, not hours."""
    return {
        f"{prefix}_lag{k}": F.lag(measure, k).over(w)
        for prefix, measure, offsets in LAGS
        for k in offsets
    }


def rolling_columns(w: WindowSpec) -> dict[str, Column]:
    """Means and sums over the preceding rows, the current one excluded."""
    means = {
        f"{prefix}_roll{n}h": F.avg(measure).over(w.rowsBetween(-n, -1))
        for prefix, measure, lengths in ROLLING_MEANS
        for n in lengths
    }
    sums = {
        f"{prefix}_sum{n}h": F.sum(measure).over(w.rowsBetween(-n, -1))
        for prefix, measure, lengths in ROLLING_SUMS
        for n in lengths
    }
    return {**means, **sums}


def change_columns() -> dict[str, Column]:
    """Differences to the previous row and the plain depression."""
    changes = {
        f"{prefix}Change_1h": F.col(measure) - F.col(f"{prefix}_lag1") for prefix, measure in CHANGES
    }
    return {**changes, "TempDewPoint": depression()}


def with_calendar(rows: DataFrame, spec: SeriesSpec) -> DataFrame:
    return rows.withColumns(calendar_columns(spec.time))


def with_lags(series: Series) -> Series:
    return series.over(lag_columns, back=DEEPEST)


def with_rolling(series: Series) -> Series:
    return series.over(rolling_columns, back=DEEPEST)


def with_history(series: Series) -> Series:
    """Lags and rolling features in one window step."""
    return series.over(lambda w: {**lag_columns(w), **rolling_columns(w)}, back=DEEPEST)


def with_changes(rows: DataFrame) -> DataFrame:
    return rows.withColumns(change_columns())
