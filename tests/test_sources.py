import json

import pytest
from pyspark.sql import functions as F

from helpers import ROW, hourly, same_rows
from stationflow.operators import sampling as sp
from stationflow.sources import event_feed as feed
from stationflow.sources import metrics as mt
from stationflow.sources import observations as ob
from stationflow.sources import stations as st
from stationflow.sources import tables as tb
from stationflow.storage import broadcast_if_small

HEADER = "DATE,LONGITUDE,LATITUDE,TMP,DEW,WND_ANGLE,WND_RATE,SLP,MASK,TIME_DIFF\n"


@pytest.fixture
def files(tmp_path):
    folder = tmp_path / "obs"
    folder.mkdir()
    for name, temperature in (("10", 1.5), ("20", 2.5), ("30", 3.5)):
        (folder / f"{name}.csv").write_text(
            HEADER
            + f"2014-01-01 00:00:00,1.0,2.0,{temperature},0.5,90,3,1000,[1 1 1 1 1],1\n"
            + f"2014-01-01 01:00:00,1.0,2.0,{temperature},,90,3,1000,[1 0 1 1 1],1\n"
        )
    (folder / "notes.txt").write_text("not an observation file")
    meta = tmp_path / "meta.json"
    meta.write_text(json.dumps({
        "10.csv": {"latitude": 1.0, "longitude": 2.0, "ELEVATION": 3.0, "valid_percent": 0.9},
        "20.csv": {"valid_percent": 0.95},
        "30.csv": {"latitude": 5.0},
        "40.csv": {"valid_percent": 0.99, "longitude": 7.0},
    }, indent=2))
    return str(folder), str(meta)


def test_station_map(spark, files):
    found = {r["StationID"]: r for r in st.read_stations(spark, files[1]).collect()}
    assert set(found) == {"10", "20", "30", "40"} and found["10"]["file_name"] == "10.csv"
    assert found["20"]["latitude"] is None and found["30"]["valid_percent"] is None


def test_catalogue_of_several_files(spark, tmp_path):
    for part in range(3):
        entries = {f"{part}{i}.csv": {"valid_percent": 0.5} for i in range(4)}
        (tmp_path / f"meta{part}.json").write_text(json.dumps(entries))
    assert st.read_stations(spark, str(tmp_path)).count() == 12


def test_feed_files_keep_every_station(spark, small, monkeypatch):
    monkeypatch.setattr(feed, "STATIONS_PER_FILE", 7)
    monkeypatch.setattr(feed, "_written", {})
    _, meta = feed.write_station_files(spark, small)
    names = feed.stations(spark, small).select("StationID")
    assert same_rows(st.read_stations(spark, meta).select("StationID"), names)


def test_only_files_of_valid_stations_are_read(spark, files):
    rows = ob.load_observations(spark, *files)
    assert {(r["StationID"], r["TMP"]) for r in rows.collect()} == {("10", 1.5), ("20", 2.5)}
    assert len(rows.inputFiles()) == 2 and rows.count() == 4
    assert rows.select("row_key").distinct().count() == 4
    valid = st.valid_stations(st.read_stations(spark, files[1]))
    missing = ob.missing_files(valid, ob.list_observation_files(spark, files[0]))
    assert [r["StationID"] for r in missing.collect()] == ["40"]


def test_sample_bounds_the_files(spark, files):
    # Three stations are valid, one of them has no file.
    assert len(ob.load_observations(spark, *files, stations=2).inputFiles()) in (1, 2)


def test_long_choice_reads_the_folder(spark, files, monkeypatch):
    listed = ob.load_observations(spark, *files)
    monkeypatch.setattr(ob, "LISTED_FILES", 1)
    assert same_rows(listed, ob.load_observations(spark, *files).select(listed.columns))


def test_nothing_to_read_is_an_error(spark, files):
    with pytest.raises(ValueError):
        ob.load_observations(spark, *files, minimum=1.1)


def test_unfinished_tables_do_not_count(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tb.load_frame(spark, path) is None
    tb.save_frame(spark.range(3), path)
    assert tb.load_frame(spark, path).count() == 3
    tb.save_frame(spark.range(5), path)
    assert tb.load_frame(spark, path).count() == 5
    (tmp_path / "t" / "_SUCCESS").unlink()
    assert tb.load_frame(spark, path) is None


def test_split_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tb.load_split(spark, path) is None
    rows = hourly(spark, [float(i) for i in range(200)])
    tb.save_split(sp.with_split(rows, ROW), path)
    tb.save_split(sp.with_split(rows.limit(0), ROW), f"{path}-empty")
    assert tb.load_split(spark, f"{path}-empty") is None
    for saved, direct in zip(tb.load_split(spark, path), sp.split_rows(rows, ROW)):
        assert same_rows(saved, direct)
        plan = saved._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(split" in plan and len(saved.inputFiles()) < 17


def test_station_lookup_is_pushed_down(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = hourly(spark, [1.0, 2.0]).unionByName(hourly(spark, [3.0], station="B")).withColumn(
        "datetime_ts", F.col("datetime").cast("timestamp_ntz")
    )
    tb.save_by_station(rows, path, ROW)
    found = tb.station_rows(tb.load_frame(spark, path), "B", ROW)
    assert [r["Temperature"] for r in found.collect()] == [3.0]
    assert "EqualTo(StationID,B)" in found._jdf.queryExecution().executedPlan().toString()


def test_metrics_document_round_trip(spark, tmp_path):
    tidy = spark.createDataFrame(
        [("classification", "LR", "AUC-ROC", 0.9), ("classification", "LR", "Accuracy", 0.8), ("regression", "RF", "RMSE", 1.5)],
        "task string, model string, metric string, value double",
    )
    path = str(tmp_path / "m")
    assert mt.read_metrics(spark, path) is None
    mt.save_metrics(tidy, path, 80, 20, tag="fast")
    document = mt.read_metrics(spark, path)
    assert document.first()["train_count"] == 80 and document.first()["notebook"] == "fast"
    assert same_rows(mt.tidy_metrics(document), tidy)
    written = json.loads(next((tmp_path / "m").glob("part-*")).read_text())
    assert written["classification"]["LR"] == {"AUC-ROC": 0.9, "Accuracy": 0.8} and written["test_count"] == 20


def test_short_metric_names_and_indented_documents(spark, tmp_path):
    path = tmp_path / "metrics.json"
    path.write_text(json.dumps({"classification": {"GBT": {"AUC": 0.9, "F1": 0.7}}, "train_count": 1}, indent=2))
    found = {r["metric"]: r["value"] for r in mt.tidy_metrics(mt.read_metrics(spark, str(path))).collect()}
    assert found == {"AUC-ROC": 0.9, "F1-Score": 0.7}


def test_broadcast_is_hinted_below_the_bound_only(spark):
    small = broadcast_if_small(spark.range(10), max_rows=10)
    large = broadcast_if_small(spark.range(11), max_rows=10)
    assert "broadcast" in small._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in large._jdf.queryExecution().analyzed().toString().lower()
