"""Shapes of physical plans."""

import re

from stationflow import storage
from stationflow.plans import queries as q
from stationflow.sources import event_feed as feed
from stationflow.sources.event_feed import FEED


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text: str) -> int:
    return len(re.findall(r"\bExchange \w", text))


def test_features_take_one_shuffle_and_one_sort(spark, small):
    text = plan(q.fj.feature_rows(q.clean_rows(spark, small), FEED))
    assert shuffles(text) == 1 and len(re.findall(r"\bSort \[", text)) == 1
    assert "BroadcastHashJoin" in text and text.count("Window [") == 2


def test_scan_reads_needed_columns_only(spark, small):
    text = plan(q.QUERIES["c01_hour"](spark, small))
    scan = next(line for line in text.splitlines() if "events.parquet" in line)
    assert "value" not in scan.split("ReadSchema")[1] and "props" not in scan


def test_station_choice_is_broadcast(spark, small):
    text = plan(q.cl.of_stations(feed.observations(spark, small), feed.stations(spark, small)))
    assert "BroadcastHashJoin" in text and "LeftSemi" in text and shuffles(text) == 0


def test_regions_need_no_join(spark, small):
    assert "Join" not in plan(q.QUERIES["b13_regions"](spark, small))


def test_profiles_scan_once(spark, small):
    for name in ("a11_summary", "e04_missing_profile", "e08_station_profile", "e02_positive_ratio"):
        assert plan(q.QUERIES[name](spark, small)).count("events.parquet") == 1, name


def test_no_query_pairs_rows_or_runs_python(spark, small):
    for name in ("j02_feature_rows", "e07_station_histogram", "b13_regions", "g03_station_info", "i09_evaluate", "f03_capped_sample"):
        text = plan(q.QUERIES[name](spark, small))
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name
        assert "Python" not in text and "Pandas" not in text, name


def test_window_shuffles_grow_with_the_rows(spark, small, monkeypatch):
    monkeypatch.setattr(storage, "ROWS_PER_PARTITION", 10)
    text = plan(q.fj.feature_rows(q.clean_rows(spark, small), FEED))
    assert shuffles(text) == 1 and "hashpartitioning(StationID#" in text and ", 39), REPARTITION_BY_NUM" in text
