"""The two preparation jobs: labelled rows, then feature rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stationflow.operators.clean import parsed
from stationflow.operators.features import with_calendar, with_changes, with_history
from stationflow.operators.impute import approximate_medians, exact_medians, fill_missing
from stationflow.operators.labels import drop_without_target, with_rain, with_targets
from stationflow.operators.series import MAX_ROWS_PER_TASK, Series
from stationflow.spec import RAIN_THRESHOLD, SeriesSpec


def labelled_series(
    cleaned: DataFrame,
    spec: SeriesSpec,
    threshold: float = RAIN_THRESHOLD,
    max_rows: int = MAX_ROWS_PER_TASK,
    laid_out: bool = False,
) -> Series:
    """Parsed, labelled rows that have both targets, not yet imputed.

    From a table bucketed by the entity (``laid_out``) the windows of ordinary entities need no shuffle.
    """
    # Counting before parsing reads the entity column only.
    series = Series.of(parsed(cleaned, spec), spec, max_rows, superset=cleaned, laid_out=laid_out)
    return with_targets(series.each(lambda rows: with_rain(rows, threshold))).each(drop_without_target)


def preprocessed_series(
    cleaned: DataFrame,
    spec: SeriesSpec,
    threshold: float = RAIN_THRESHOLD,
    max_rows: int = MAX_ROWS_PER_TASK,
    exact: bool = True,
    laid_out: bool = False,
) -> Series:
    """Labelled rows with missing measures filled.

    Filling comes last on purpose: a row whose own measure was missing keeps its null depression (and is
    dropped later), while its neighbours' lags and means see the filled value.
    """
    series = labelled_series(cleaned, spec, threshold, max_rows, laid_out)
    rows = series.frame()
    if exact:
        medians = exact_medians(rows, spec.measures, at_most=series.counted)
    else:
        medians = approximate_medians(rows, spec.measures)
    return series.each(lambda part: fill_missing(part, medians))


def preprocess(cleaned: DataFrame, spec: SeriesSpec, **options) -> DataFrame:
    return preprocessed_series(cleaned, spec, **options).frame()


def engineered(series: Series, complete: bool = True) -> DataFrame:
    """All features; rows with anything missing are dropped unless ``complete`` is false."""
    dated = series.each(lambda rows: with_calendar(rows, series.spec))
    rows = with_history(dated).each(with_changes).frame()
    return rows.dropna() if complete else rows


def engineer_features(
    rows: DataFrame, spec: SeriesSpec, max_rows: int = MAX_ROWS_PER_TASK
) -> DataFrame:
    """Features of an already preprocessed frame."""
    return engineered(Series.of(rows, spec, max_rows))


def feature_rows(cleaned: DataFrame, spec: SeriesSpec, complete: bool = True, **options) -> DataFrame:
    """Clean rows to feature rows: both jobs over one partitioning by station."""
    return engineered(preprocessed_series(cleaned, spec, **options), complete)

