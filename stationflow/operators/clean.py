"""From raw observation rows to the canonical table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.functions.scalars import parse_time
from stationflow.spec import CANONICAL_NAMES, UNUSED_COLUMNS, VALID_MASK, SeriesSpec
from stationflow.storage import broadcast_if_small


def only_valid(raw: DataFrame) -> DataFrame:
    """Rows whose five measures are all marked valid."""
    return raw.filter(F.col("MASK") == VALID_MASK)


def canonical(raw: DataFrame) -> DataFrame:
    """Long column names; columns no later step reads are dropped."""
    return raw.withColumnsRenamed(CANONICAL_NAMES).drop(*UNUSED_COLUMNS)


def clean(raw: DataFrame) -> DataFrame:
    return canonical(only_valid(raw))


def of_stations(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """Rows of the chosen stations; the choice is broadcast while it is small."""
    return rows.join(broadcast_if_small(chosen.select("StationID")), "StationID", "left_semi")


def with_station_info(rows: DataFrame, stations: DataFrame) -> DataFrame:
    """Station attributes next to each row; unknown stations get no position and a valid share of 0."""
    info = stations.select("StationID", "latitude", "longitude", "ELEVATION", "valid_percent")
    return rows.join(broadcast_if_small(info), "StationID", "left").withColumn(
        "valid_percent", F.coalesce("valid_percent", F.lit(0.0))
    )


def parsed(rows: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Add the timestamp and drop rows whose time cannot be read."""
    return rows.withColumn(spec.time, parse_time(spec.time_text)).filter(F.col(spec.time).isNotNull())


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Frames of equal columns, matched by name, as one. Pairs are united first, so plans stay shallow."""
    if not frames:
        raise ValueError("nothing to unite")
    while len(frames) > 1:
        pairs = [frames[i : i + 2] for i in range(0, len(frames), 2)]
        frames = [pair[0].unionByName(pair[1]) if len(pair) == 2 else pair[0] for pair in pairs]
    return frames[0]
