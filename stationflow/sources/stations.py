"""Station metadata: JSON maps from file name to attributes, as a station dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.functions.scalars import strip_csv
from stationflow.operators.sampling import smallest_hashes
from stationflow.spec import MIN_VALID_SHARE, SEED

ORDERED_STATIONS = 10_000
STATION_MAP = (
    "map<string, struct<latitude: double, longitude: double, ELEVATION: double, valid_percent: double>>"
)


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    """One row per station from one or several JSON map files (every attribute is optional).

    A map file is exactly one JSON object, hence one row until it is exploded; a large catalogue should come as
    several files, which are then read in parallel.
    """
    return (
        spark.read.text(path, wholetext=True)
        .select(F.explode(F.from_json("value", STATION_MAP, {"mode": "FAILFAST"})).alias("file_name", "info"))
        .select(strip_csv(F.col("file_name")).alias("StationID"), "file_name", "info.*")
    )


def valid_stations(stations: DataFrame, minimum: float = MIN_VALID_SHARE) -> DataFrame:
    """Stations whose share of valid rows reaches the minimum; a missing share counts as 0."""
    return stations.filter(F.coalesce("valid_percent", F.lit(0.0)) >= F.lit(float(minimum)))


def sample_stations(stations: DataFrame, count: int, seed: int = SEED) -> DataFrame:
    """``count`` stations in seeded hash order; all of them when there are no more than that."""
    key = F.concat_ws("|", "StationID", F.lit(str(seed)))
    if count > ORDERED_STATIONS:
        return smallest_hashes(stations, key, count)
    return stations.orderBy(F.md5(key)).limit(count)


def station_list(stations: DataFrame, first: int = 200) -> DataFrame:
    """The first stations by name."""
    return stations.select("StationID").orderBy("StationID").limit(first)
