"""Small column functions used by several operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stationflow.spec import RAIN_THRESHOLD


def parse_time(text: str) -> Column:
    """Text to wall-clock timestamp; null where it cannot be read. Independent of the session zone."""
    return F.col(text).try_cast("timestamp_ntz")


def depression() -> Column:
    """How far the dew point lies below the temperature."""
    return F.col("Temperature") - F.col("DewPoint")


def rain_flag(gap: Column, threshold: float = RAIN_THRESHOLD) -> Column:
    """1.0 where the gap is strictly below the threshold, else 0.0 (also for null and NaN)."""
    return F.when(gap < F.lit(float(threshold)), F.lit(1.0)).otherwise(F.lit(0.0))


def present(name: str) -> Column:
    """A numeric column with NaN turned into null, i.e. only values that count as present."""
    return F.when(~F.isnan(name), F.col(name))


def strip_csv(name: Column) -> Column:
    """Entity name of a file name."""
    return F.regexp_replace(name, r"\.csv$", "")


def hash_32(key: Column) -> Column:
    """The first 32 bits of the key's md5, as a number."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
