"""Windows over long entities cut into blocks equal plain windows."""

import pytest
from pyspark.sql import functions as F

from helpers import ROW, same_rows
from stationflow import storage
from stationflow.operators import features as ft
from stationflow.operators import labels as lb
from stationflow.operators.clean import parsed
from stationflow.operators.series import BLOCK, Series
from stationflow.plans import feature_job as fj


@pytest.fixture(scope="module")
def skewed(spark):
    """One station with most rows, bursts of equal times, gaps and missing measures; several short ones."""
    hot = spark.range(3000).select(
        F.lit("hot").alias("StationID"),
        # Half of the rows fall on a few hours only.
        F.when(F.col("id") % 2 == 0, F.col("id") % 7).otherwise(F.col("id")).alias("hour"),
        F.col("id").alias("row_key"),
    )
    rest = spark.range(400).select(
        F.concat(F.lit("s"), F.col("id") % 5).alias("StationID"), F.col("id").alias("hour"), (F.col("id") + 10_000).alias("row_key")
    )
    value = F.pmod(F.xxhash64("row_key"), F.lit(400)) / 10.0
    return hot.unionByName(rest).select(
        "StationID",
        F.date_format(F.timestamp_seconds(F.lit(1388534400) + F.col("hour") * 3600), "yyyy-MM-dd HH:mm:ss").alias("datetime"),
        value.alias("Temperature"),
        F.when(F.col("row_key") % 11 != 0, value - F.pmod(F.hash("row_key"), F.lit(90)) / 10.0).alias("DewPoint"),
        F.lit(90.0).alias("WindDirection"),
        (F.col("row_key") % 9).cast("double").alias("WindSpeed"),
        (F.lit(1000.0) + F.col("row_key") % 13).alias("Pressure"),
        "row_key",
    )


def brute_force(rows, back, ahead):
    """Neighbouring keys of every row within its station, straight from the definition."""
    found = {}
    stations = {r["StationID"] for r in rows}
    for station in stations:
        keys = [r["row_key"] for r in sorted((r for r in rows if r["StationID"] == station), key=lambda r: (r["datetime"], r["row_key"]))]
        for at, key in enumerate(keys):
            found[key] = (keys[max(0, at - back):at], keys[at + 1:at + 1 + ahead])
    return found


@pytest.mark.parametrize("max_rows", [40, 300, 1000])
def test_frames_over_blocks_see_exactly_their_neighbours(spark, skewed, max_rows):
    rows = parsed(skewed, ROW)
    series = Series.of(rows, ROW, max_rows=max_rows)
    assert series.long is not None and series.long.select(BLOCK).distinct().count() > 3

    def near(w):
        return {
            "before": F.collect_list("row_key").over(w.rowsBetween(-24, -1)),
            "after": F.collect_list("row_key").over(w.rowsBetween(1, 2)),
        }

    found = {r["row_key"]: (r["before"], r["after"]) for r in series.over(near, back=24, ahead=2).frame().collect()}
    assert found == brute_force(skewed.collect(), 24, 2)


@pytest.mark.parametrize("max_rows", [60, 500])
def test_feature_rows_do_not_depend_on_blocks(spark, skewed, max_rows):
    plain = fj.feature_rows(skewed, ROW)
    assert plain.count() > 2000
    assert same_rows(plain, fj.feature_rows(skewed, ROW, max_rows=max_rows))


def test_blocks_much_shorter_than_the_frame(spark, skewed):
    """Copies then come from many earlier blocks."""
    rows = lb.with_rain(parsed(skewed, ROW))
    assert same_rows(
        ft.with_history(Series.of(rows, ROW)).frame(),
        ft.with_history(Series.of(rows, ROW, max_rows=12)).frame(),
    )


def test_no_task_holds_a_long_station(spark, skewed):
    series = Series.of(parsed(skewed, ROW), ROW, max_rows=300)
    sizes = series.long.groupBy(BLOCK).count().agg(F.max("count"), F.count(F.lit(1))).first()
    assert sizes[0] <= 450 and sizes[1] >= 15
    assert series.ordinary.count() + series.long.count() == skewed.count()
    assert series.long.select("StationID").distinct().count() == 1


def test_more_partitions_than_the_session_asks_for(spark, skewed, monkeypatch):
    plain = fj.feature_rows(skewed, ROW)
    monkeypatch.setattr(storage, "ROWS_PER_PARTITION", 40)
    assert same_rows(plain, fj.feature_rows(skewed, ROW, max_rows=500))


def test_short_stations_stay_in_one_plan(spark, skewed):
    assert Series.of(parsed(skewed, ROW), ROW).long is None
