"""Calendar parts and their cyclic encodings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stationflow.spec import TWO_PI


def calendar_parts(ts: str) -> dict[str, Column]:
    """Hour, month, weekday (1 = Sunday) and day of year of a timestamp column."""
    return {
        "Hour": F.hour(ts),
        "Month": F.month(ts),
        "DayOfWeek": F.dayofweek(ts),
        "DayOfYear": F.dayofyear(ts),
    }


def on_circle(name: str, value: Column, period: int) -> dict[str, Column]:
    """``value`` with the given period as a point on the unit circle."""
    angle = F.lit(TWO_PI) * value / F.lit(float(period))
    return {f"{name}_sin": F.sin(angle), f"{name}_cos": F.cos(angle)}


def calendar_columns(ts: str) -> dict[str, Column]:
    """All eight calendar features."""
    parts = calendar_parts(ts)
    return {**parts, **on_circle("Hour", parts["Hour"], 24), **on_circle("Month", parts["Month"], 12)}
