"""Null handling, frame borders and stage order on tiny frames."""

import hashlib
import pytest
from pyspark.sql import functions as F

from helpers import ROW, by_key, hourly
from stationflow.functions.calendar import calendar_columns
from stationflow.functions.scalars import hash_32, strip_csv
from stationflow.operators import clean as cl
from stationflow.operators import features as ft
from stationflow.operators import labels as lb
from stationflow.operators import profile as pf
from stationflow.operators import regions as rg
from stationflow.operators.series import Series
from stationflow.plans import feature_job as fj
from stationflow.sources.stations import sample_stations, valid_stations

NAN = float("nan")


def test_rain_label_of_null_nan_and_boundary(spark):
    rows = spark.createDataFrame(
        [(0, None, 1.0), (1, NAN, 0.0), (2, 2.5, 0.0), (3, 1.0, 0.0)],
        "row_key bigint, Temperature double, DewPoint double",
    )
    assert by_key(lb.with_rain(rows), "Rain") == {0: (0.0,), 1: (0.0,), 2: (0.0,), 3: (1.0,)}


def test_unreadable_dates_are_dropped(spark):
    rows = spark.createDataFrame(
        [("bad",), (None,), ("2014-01-01 00:00:00",), ("2014-02-30 00:00:00",)], "datetime string"
    )
    assert [r["datetime"] for r in cl.parsed(rows, ROW).collect()] == ["2014-01-01 00:00:00"]


def test_calendar_does_not_depend_on_the_session_zone(spark):
    rows = hourly(spark, [1.0, 2.0, 3.0, 4.0])
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        found = by_key(cl.parsed(rows, ROW).withColumns(calendar_columns("datetime_ts")), "Hour", "DayOfWeek")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found == {h: (h, 4) for h in range(4)}  # 1 January 2014 was a Wednesday, with Sunday = 1


def test_mask_is_compared_as_text_and_names_change(spark):
    raw = spark.createDataFrame(
        [("A", "2014-01-01 00:00:00", 1.0, "[1 1 1 1 1]"), ("A", "x", 2.0, "[1 1 1 1 0]"), ("A", "x", 3.0, None)],
        "StationID string, DATE string, TMP double, MASK string",
    )
    found = cl.clean(raw)
    assert found.columns == ["StationID", "datetime", "Temperature"]
    assert [r["Temperature"] for r in found.collect()] == [1.0]


def test_lags_count_rows_across_a_gap(spark):
    rows = cl.parsed(hourly(spark, [10.0, 11.0, 15.0], hours=[0, 1, 5]), ROW)
    found = ft.with_lags(Series.of(lb.with_rain(rows), ROW)).frame()
    assert by_key(found, "Temp_lag1")[2] == (11.0,)


def test_rolling_frames_leave_the_current_row_out(spark):
    rows = lb.with_rain(cl.parsed(hourly(spark, [1.0, 2.0, 4.0, 100.0]), ROW))
    found = by_key(ft.with_rolling(Series.of(rows, ROW)).frame(), "Temp_roll6h", "Rain_sum6h")
    assert found == {0: (None, None), 1: (1.0, 0.0), 2: (1.5, 0.0), 3: (7.0 / 3.0, 0.0)}


def test_targets_come_from_the_next_row_and_end_rows_are_dropped(spark):
    rows = hourly(spark, [1.0, None, 3.0, 4.0], dew=[0.0, 0.0, -5.0, 4.0])
    series = fj.labelled_series(rows, ROW)
    # Row 0 goes because its successor has no temperature, row 3 because it has no successor.
    assert by_key(series.frame(), "Temp_next", "Rain_next", "label_clf") == {
        1: (3.0, 0.0, 0.0),
        2: (4.0, 1.0, 1.0),
    }


def test_filling_comes_after_labels(spark):
    temperatures = [float(i % 7) for i in range(40)]
    dew = [t - 5.0 for t in temperatures]
    dew[30] = None
    rows = hourly(spark, temperatures, dew=dew)
    filled = by_key(fj.preprocess(rows, ROW), "DewPoint", "DewPointDepression")
    median = sorted(d for k, d in enumerate(dew[:39]) if d is not None)
    assert filled[30] == ((median[18] + median[19]) / 2, None)
    found = by_key(fj.feature_rows(rows, ROW), "DewPoint_lag1")
    assert 30 not in found and found[31] == (filled[30][0],)


def test_first_day_of_every_station_is_lost(spark):
    rows = hourly(spark, [float(i) for i in range(30)]).unionByName(
        hourly(spark, [float(i) for i in range(24)], station="B")
    )
    found = fj.feature_rows(rows, ROW)
    assert sorted(by_key(found, "StationID")) == [24, 25, 26, 27, 28]
    assert len(found.columns) == 41  # forty columns and the row key


def test_all_null_column_stays_null_and_empties_the_result(spark):
    rows = hourly(spark, [float(i) for i in range(30)]).withColumn("Pressure", F.lit(None).cast("double"))
    assert fj.preprocess(rows, ROW).filter(F.col("Pressure").isNotNull()).isEmpty()
    assert fj.feature_rows(rows, ROW).isEmpty()


def test_empty_input_gives_empty_output(spark):
    rows = hourly(spark, [1.0]).limit(0)
    assert fj.feature_rows(rows, ROW).isEmpty()


def test_features_do_not_look_ahead(spark):
    rows = fj.preprocess(hourly(spark, [float((i * 37) % 23) for i in range(80)]), ROW)
    whole = fj.engineer_features(rows, ROW)
    early = fj.engineer_features(rows.filter(F.col("row_key") < 50), ROW)
    names = [c for c in whole.columns if c != "row_key"]
    kept = by_key(whole.filter(F.col("row_key") < 50), *names)
    assert kept and kept == by_key(early, *names)


def test_nan_counts_as_missing(spark):
    rows = hourly(spark, [1.0, NAN, 3.0, 5.0, 9.0], dew=[0.0] * 5)
    # Row 0 goes because its target is NaN and row 4 because it has none; the median is that of 3 and 5.
    assert by_key(fj.preprocess(rows, ROW), "Temperature") == {1: (4.0,), 2: (3.0,), 3: (5.0,)}


def test_missing_profile_lists_only_columns_with_nulls(spark):
    rows = spark.createDataFrame([(1.0, None), (None, None), (2.0, None), (3.0, 4.0)], "a double, b double")
    found = {r["column"]: (r["missing"], r["percent"]) for r in pf.missing_profile(rows, ["a", "b"]).collect()}
    assert found == {"a": (1, 25.0), "b": (3, 75.0)}
    assert pf.missing_profile(rows.dropna(), ["a", "b"]).isEmpty()


def test_positive_ratio_of_nothing_is_zero(spark):
    assert pf.positive_ratio(spark.createDataFrame([], "Rain double")).first()["percent"] == 0.0


def test_histogram_edges_and_constant_values(spark):
    rows = spark.createDataFrame([(0.0, 7.0), (5.0, 7.0), (10.0, 7.0), (None, 7.0), (NAN, 7.0)], "a double, b double")
    found = {(r["measure"], r["bin"]): r["rows"] for r in pf.histogram(rows, ["a", "b"], bins=10).collect()}
    assert found == {("a", 0): 1, ("a", 5): 1, ("a", 9): 1, ("b", 5): 5}


def test_station_profile_ignores_missing_depressions(spark):
    rows = spark.createDataFrame(
        [("A", 5.0, 4.0), ("A", 9.0, 1.0), ("A", None, 1.0), ("B", None, None)],
        "StationID string, Temperature double, DewPoint double",
    )
    found = {r["StationID"]: (r["rows"], r["mean_temperature"], r["rain_percent"]) for r in pf.station_profile(rows).collect()}
    assert found == {"A": (3, 7.0, 50.0), "B": (1, None, None)}


def test_regions_overlap_and_bounds_are_inclusive(spark):
    stations = spark.createDataFrame(
        [("edge", 35.0, 25.0), ("zero", 0.0, 0.0), ("none", None, None), ("equator", 0.0, 100.0)],
        "StationID string, latitude double, longitude double",
    )
    found = {(r["StationID"], r["region"]) for r in rg.by_region(rg.located(stations)).collect()}
    assert found == {
        ("edge", "global"), ("edge", "asia"), ("edge", "europe"), ("edge", "africa"),
        ("equator", "global"), ("equator", "asia"), ("equator", "oceania"),
    }


def test_station_choice(spark):
    stations = spark.createDataFrame([(f"S{i}", None if i == 0 else i / 10) for i in range(11)], "StationID string, valid_percent double")
    valid = valid_stations(stations)
    assert {r["StationID"] for r in valid.collect()} == {"S8", "S9", "S10"}
    two = [r["StationID"] for r in sample_stations(valid, 2).collect()]
    assert len(two) == 2 and two == [r["StationID"] for r in sample_stations(valid.repartition(5), 2).collect()]
    assert sample_stations(valid, 50).count() == 3


def test_unknown_station_gets_no_position(spark):
    rows = spark.createDataFrame([("A",), ("B",)], "StationID string")
    info = spark.createDataFrame(
        [("A", 1.0, 2.0, 3.0, 0.9)],
        "StationID string, latitude double, longitude double, ELEVATION double, valid_percent double",
    )
    found = {r["StationID"]: (r["latitude"], r["valid_percent"]) for r in cl.with_station_info(rows, info).collect()}
    assert found == {"A": (1.0, 0.9), "B": (None, 0.0)}


def test_union_by_name_ignores_column_order(spark):
    one = spark.createDataFrame([(1, "x")], "a int, b string")
    two = spark.createDataFrame([("y", 2)], "b string, a int")
    assert sorted(tuple(r) for r in cl.union_all([one, two]).collect()) == [(1, "x"), (2, "y")]
    with pytest.raises(ValueError):
        cl.union_all([])


def test_small_functions(spark):
    row = spark.range(1).select(strip_csv(F.lit("01.csv.csv")).alias("n"), hash_32(F.lit("k")).alias("h")).first()
    assert row["n"] == "01.csv" and row["h"] == int(hashlib.md5(b"k").hexdigest()[:8], 16)
