"""Hourly multi-station time series on Spark: load, label, engineer, split, model, evaluate."""

from stationflow.spec import ModelSettings, SeriesSpec

__all__ = ["ModelSettings", "SeriesSpec"]
