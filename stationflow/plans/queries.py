"""One query per operator, over the station feed of a folder of tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationflow.functions.calendar import calendar_columns
from stationflow.functions.scalars import depression, parse_time, rain_flag
from stationflow.operators import clean as cl
from stationflow.operators import evaluate as ev
from stationflow.operators import features as ft
from stationflow.operators import impute as im
from stationflow.operators import labels as lb
from stationflow.operators import linear as ln
from stationflow.operators import models as md
from stationflow.operators import prepare as pp
from stationflow.operators import profile as pf
from stationflow.operators import regions as rg
from stationflow.operators import sampling as sp
from stationflow.operators import trees as tr
from stationflow.operators.series import Series
from stationflow.plans import feature_job as fj
from stationflow.plans import forecast as fc
from stationflow.plans import job
from stationflow.sources import event_feed as feed
from stationflow.sources import metrics as mt
from stationflow.sources import observations as ob
from stationflow.sources import stations as st
from stationflow.sources import tables as tb
from stationflow.sources.event_feed import FEED
from stationflow.spec import MEASURES, NUMERIC_FEATURES, VALID_MASK, SeriesSpec
from stationflow.storage import exists, stage, work_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
KEYS = ("StationID", "event_id")
SAMPLED_STATIONS = 50
SAMPLE_ROWS = 1_000
SHORT_BLOCKS = 70
FILE_TASKS = 16
# Clean rows have no parsed time yet; their date text sorts the same way.
FEED_BY_TEXT = SeriesSpec(time="datetime", tiebreak=FEED.tiebreak)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def tidy_types(df: DataFrame) -> DataFrame:
    """Doubles to six decimals, all integers as bigint, timestamps as text: comparable across engines."""
    columns = []
    for field in df.schema:
        kind, c = field.dataType.simpleString(), F.col(f"`{field.name}`")
        if kind == "double":
            c = F.round(c, 6)
        elif kind in ("int", "smallint", "tinyint"):
            c = c.cast("bigint")
        elif kind.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        columns.append(c.alias(field.name))
    return df.select(columns)


def keyed(df: DataFrame, *columns: str) -> DataFrame:
    return tidy_types(df.select(*KEYS, *columns))


# ---- stages of the feed -------------------------------------------------------------------------------


def raw_rows(spark: SparkSession, sf: str) -> DataFrame:
    return feed.observations(spark, sf)


def clean_rows(spark: SparkSession, sf: str) -> DataFrame:
    chosen = st.valid_stations(feed.stations(spark, sf))
    return cl.clean(cl.of_stations(raw_rows(spark, sf), chosen))


def parsed_rows(spark: SparkSession, sf: str) -> DataFrame:
    return cl.parsed(clean_rows(spark, sf), FEED)


def rain_rows(spark: SparkSession, sf: str) -> DataFrame:
    return lb.with_rain(parsed_rows(spark, sf))


def target_rows(spark: SparkSession, sf: str) -> DataFrame:
    return fj.labelled_series(clean_rows(spark, sf), FEED).frame()


def filled_series(spark: SparkSession, sf: str) -> Series:
    return fj.preprocessed_series(clean_rows(spark, sf), FEED)


_features: dict[tuple[str, str], DataFrame] = {}
_trainers: dict[tuple[str, str], md.Trainer] = {}


def feature_table(spark: SparkSession, sf: str) -> DataFrame:
    """Feature rows with their split, written once per application as the whole run does."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _features:
        rows = sp.with_split(fj.feature_rows(clean_rows(spark, sf), FEED), FEED)
        _features[key] = stage(rows, "features")
    return _features[key]


def split_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = lb.with_regression_label(feature_table(spark, sf))
    return tuple(rows.filter(F.col("split") == part).drop("split") for part in ("train", "test"))


# Predictions that need no model, so that evaluation can be compared with SQL: value and score columns.
VALUE_BASELINES = {"PERSISTENCE": "Temperature", "ROLL6": "Temp_roll6h", "ROLL24": "Temp_roll24h"}


def class_baselines() -> dict[str, tuple[Column, Column]]:
    often = F.when(F.col("Rain_sum24h") >= 6, 1.0).otherwise(0.0)
    return {
        "PERSISTENCE": (F.col("Rain"), -F.col("DewPointDepression")),
        "LAG3": (F.col("Rain_lag3"), F.col("Rain_sum6h")),
        "OFTEN": (often, F.col("Rain_sum24h")),
    }


def class_predictions(spark: SparkSession, sf: str, name: str = "PERSISTENCE") -> DataFrame:
    said, score = class_baselines()[name]
    return feature_table(spark, sf).select(
        *KEYS, "label_clf", said.alias("prediction"), score.alias("rawPrediction")
    )


def value_predictions(spark: SparkSession, sf: str, name: str = "PERSISTENCE") -> DataFrame:
    rows = lb.with_regression_label(feature_table(spark, sf))
    return rows.select(*KEYS, "label_reg", F.col(VALUE_BASELINES[name]).alias("prediction"))


def baseline_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Tidy metrics of all baselines of both tasks."""
    parts = [
        _tagged(ev.evaluate_classification(class_predictions(spark, sf, name), bins=0), "classification", name)
        for name in class_baselines()
    ]
    parts += [
        _tagged(ev.evaluate_regression(value_predictions(spark, sf, name)), "regression", name)
        for name in VALUE_BASELINES
    ]
    return cl.union_all(parts)


def _tagged(metrics: DataFrame, task: str, model: str) -> DataFrame:
    return metrics.select(F.lit(task).alias("task"), F.lit(model).alias("model"), "metric", "value")


def _folder(spark: SparkSession, label: str) -> str:
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"


# ---- A: sources and sinks -----------------------------------------------------------------------------


@query
def a01_read_observations(spark, sf):
    csv = feed.write_observation_files(spark, sf)
    return tidy_types(ob.read_observations(spark, csv).drop("row_key"))


@query
def a01_mixed_headers(spark, sf):
    """Files whose headers have other orders, fewer columns or one more."""
    return tidy_types(ob.read_mixed_observations(spark, feed.write_mixed_files(spark, sf)).drop("row_key"))


@query
def a02_entity_from_file(spark, sf):
    csv = feed.write_observation_files(spark, sf)
    return ob.read_observations(spark, csv).groupBy("StationID").agg(F.count(F.lit(1)).alias("rows"))


@query
def a03_read_stations(spark, sf):
    return tidy_types(st.read_stations(spark, feed.write_metadata_files(spark, sf)))


@query
def a04_missing_files(spark, sf):
    csv, meta = feed.write_station_files(spark, sf)
    chosen = st.valid_stations(st.read_stations(spark, meta))
    return ob.missing_files(chosen, ob.list_observation_files(spark, csv)).select("StationID")


@query
def a05_station_rows(spark, sf):
    """Rows of the station with most valid rows, from a table laid out by station."""
    path = _folder(spark, "by-station")
    tb.save_by_station(clean_rows(spark, sf), path, FEED_BY_TEXT)
    table = tb.load_frame(spark, path)
    sizes = table.groupBy("StationID").count()
    busiest = sizes.orderBy(F.desc("count"), "StationID").first()["StationID"]
    return tidy_types(tb.station_rows(table, busiest, FEED))


@query
def a06_save_table(spark, sf):
    path = _folder(spark, "saved")
    tb.save_frame(clean_rows(spark, sf), path)
    return tidy_types(spark.read.parquet(path))


@query
def a07_load_split(spark, sf):
    path = _folder(spark, "split")
    tb.save_split(sp.with_split(clean_rows(spark, sf), FEED), path)
    train, test = tb.load_split(spark, path)
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    return keyed(both, "split", "Temperature")


@query
def a08_model_store(spark, sf):
    """Predictions of a fitted model before and after a reload, compared row by row."""
    train, test = split_tables(spark, sf)
    fitted = md.model_plan("clf", "lr", FEED).fit(train)
    path = md.model_path(_folder(spark, "store"), "clf", "lr", "check")
    md.save_model(fitted, path)
    loaded = md.load_model(spark, path)
    one = fitted.transform(test).select(*KEYS, F.col("prediction").alias("fitted"))
    two = loaded.transform(test).select(*KEYS, F.col("prediction").alias("loaded"))
    return one.join(two, list(KEYS)).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("fitted") != F.col("loaded")).alias("changed")
    )


@query
def a09_metrics_document(spark, sf):
    """The document as one row per task with its models counted, next to the row counts."""
    sizes = _split_counts(spark, sf)
    document = mt.metrics_document(baseline_metrics(spark, sf), *sizes)
    return document.select(
        F.size("classification").cast("bigint").alias("classifiers"),
        F.size("regression").cast("bigint").alias("regressors"),
        F.round(F.col("classification")["PERSISTENCE"]["Accuracy"], 6).alias("persistence_accuracy"),
        F.round(F.col("regression")["PERSISTENCE"]["RMSE"], 6).alias("persistence_rmse"),
        "train_count",
        "test_count",
    )


@query
def a10_load_metrics(spark, sf):
    path = _folder(spark, "metrics")
    mt.save_metrics(baseline_metrics(spark, sf), path, *_split_counts(spark, sf))
    return tidy_types(mt.tidy_metrics(mt.read_metrics(spark, path)))


def _split_counts(spark, sf) -> tuple[int, int]:
    sizes = {r["split"]: r["count"] for r in feature_table(spark, sf).groupBy("split").count().collect()}
    return sizes.get("train", 0), sizes.get("test", 0)


@query
def a11_summary(spark, sf):
    return tidy_types(pf.summary_frame(clean_rows(spark, sf)))


# ---- B: projections and filters -----------------------------------------------------------------------


@query
def b01_mask_filter(spark, sf):
    return tidy_types(cl.only_valid(raw_rows(spark, sf)))


@query
def b02_canonical_names(spark, sf):
    return tidy_types(cl.canonical(raw_rows(spark, sf)))


@query
def b03_column_drop(spark, sf):
    return tidy_types(clean_rows(spark, sf))


@query
def b04_parse_time(spark, sf):
    return keyed(parsed_rows(spark, sf), "datetime", "datetime_ts")


@query
def b05_depression(spark, sf):
    return keyed(parsed_rows(spark, sf).withColumn("DewPointDepression", depression()), "DewPointDepression")


@query
def b06_rain_label(spark, sf):
    return keyed(rain_rows(spark, sf), "DewPointDepression", "Rain")


@query
def b07_class_label(spark, sf):
    return keyed(target_rows(spark, sf), "Rain_next", "label_clf")


@query
def b08_value_label(spark, sf):
    return keyed(lb.with_regression_label(target_rows(spark, sf)), "Temp_next", "label_reg")


@query
def b09_drop_without_target(spark, sf):
    return keyed(target_rows(spark, sf), "Temperature", "Rain_next", "Temp_next")


@query
def b10_complete_rows(spark, sf):
    return keyed(fj.engineered(filled_series(spark, sf)), "Temp_lag24", "DewPointDepression")


@query
def b11_fill_missing(spark, sf):
    return keyed(filled_series(spark, sf).frame(), *MEASURES, "DewPointDepression")


@query
def b12_valid_stations(spark, sf):
    return tidy_types(st.valid_stations(feed.stations(spark, sf)))


@query
def b13_regions(spark, sf):
    return rg.by_region(rg.located(feed.stations(spark, sf))).select("region", "StationID")


def _boxes(spark, sf) -> DataFrame:
    """A box for each customer, of very different sizes."""
    number = F.col("c_custkey")
    south, west = (number * 37) % 181 - 90.0, (number * 73) % 361 - 180.0
    return spark.read.parquet(f"{sf}/customer.parquet").select(
        F.col("c_custkey").cast("bigint").alias("box"),
        south.alias("south"),
        (south + number % 7 * (number % 5)).alias("north"),
        west.alias("west"),
        (west + number % 11 * (number % 9) * (number % 3)).alias("east"),
    )


@query
def b13_region_table(spark, sf):
    """Stations in the boxes of a table as long as the station table itself."""
    points = rg.located(feed.stations(spark, sf)).select("StationID", "latitude", "longitude")
    return rg.in_boxes(points, _boxes(spark, sf)).select("box", "StationID")


@query
def b14_located(spark, sf):
    return tidy_types(rg.located(feed.stations(spark, sf)).select("StationID", "latitude", "longitude"))


@query
def b15_map_points(spark, sf):
    return tidy_types(rg.map_points(rg.located(feed.stations(spark, sf))))


@query
def b16_series(spark, sf):
    return tidy_types(pf.series_of_measures(clean_rows(spark, sf), [*KEYS, "datetime"]))


@query
def b17_feature_columns(spark, sf):
    return keyed(fj.engineered(filled_series(spark, sf)), *NUMERIC_FEATURES)


# ---- C: scalar functions ------------------------------------------------------------------------------


def _calendar(spark, sf, *names):
    columns = {k: v for k, v in calendar_columns("datetime_ts").items() if k in names}
    return keyed(parsed_rows(spark, sf).withColumns(columns), *names)


@query
def c01_hour(spark, sf):
    return _calendar(spark, sf, "Hour")


@query
def c02_month(spark, sf):
    return _calendar(spark, sf, "Month")


@query
def c03_day_of_week(spark, sf):
    return _calendar(spark, sf, "DayOfWeek")


@query
def c04_day_of_year(spark, sf):
    return _calendar(spark, sf, "DayOfYear")


@query
def c05_hour_on_circle(spark, sf):
    return _calendar(spark, sf, "Hour_sin", "Hour_cos")


@query
def c06_month_on_circle(spark, sf):
    return _calendar(spark, sf, "Month_sin", "Month_cos")


@query
def c07_difference(spark, sf):
    return keyed(raw_rows(spark, sf).withColumn("gap", F.col("TMP") - F.col("DEW")), "gap")


@query
def c08_conditional(spark, sf):
    return keyed(raw_rows(spark, sf).withColumn("flag", rain_flag(F.col("TMP") - F.col("DEW"))), "flag")


@query
def c09_cast(spark, sf):
    rows = raw_rows(spark, sf).withColumns(
        {"event_value": F.col("event_id").cast("double"), "origin": F.lit("feed")}
    )
    return keyed(rows, "event_value", "origin")


@query
def c10_try_parse(spark, sf):
    return keyed(raw_rows(spark, sf).withColumn("at", parse_time("DATE")), "DATE", "at")


@query
def c11_strip_suffix(spark, sf):
    meta = feed.write_metadata_files(spark, sf)
    return st.read_stations(spark, meta).select("file_name", "StationID")


@query
def c12_null_tests(spark, sf):
    rows = raw_rows(spark, sf).withColumns(
        {
            "no_dew": F.col("DEW").isNull(),
            "has_slp": F.col("SLP").isNotNull(),
            "both": F.col("DEW").isNotNull() & F.col("SLP").isNotNull(),
        }
    )
    return keyed(rows, "no_dew", "has_slp", "both")


@query
def c13_round(spark, sf):
    return tidy_types(
        feed.stations(spark, sf).select("StationID", F.round(F.col("valid_percent") * 100, 1).alias("valid"))
    )


# ---- D: windows ---------------------------------------------------------------------------------------


@query
def d01_targets(spark, sf):
    series = Series.of(rain_rows(spark, sf), FEED)
    return keyed(lb.with_targets(series).frame(), "Rain_next", "Temp_next")


def _lagged(spark, sf, *names):
    return keyed(ft.with_lags(filled_series(spark, sf)).frame(), *names)


@query
def d02_temperature_lags(spark, sf):
    return _lagged(spark, sf, "Temp_lag1", "Temp_lag3", "Temp_lag6", "Temp_lag24")


@query
def d03_measure_lags(spark, sf):
    return _lagged(spark, sf, "DewPoint_lag1", "Pressure_lag1", "WindSpeed_lag1")


@query
def d04_label_lags(spark, sf):
    return _lagged(spark, sf, "Rain_lag1", "Rain_lag3")


def _rolled(spark, sf, *names):
    return keyed(ft.with_rolling(filled_series(spark, sf)).frame(), *names)


@query
def d05_rolling_means(spark, sf):
    return _rolled(spark, sf, "Temp_roll6h", "Temp_roll24h", "DewPoint_roll6h", "Pressure_roll6h")


def bucketed_rows(spark, sf) -> DataFrame:
    """Clean rows as a table bucketed by station."""
    rows = clean_rows(spark, sf)
    name = f"clean_{uuid.uuid4().hex}"
    buckets = tb.bucket_count(feed.observations(spark, sf).count())
    return tb.save_bucketed(rows, name, f"{work_dir(spark)}/{name}", FEED.entity, ("datetime", *FEED.tiebreak), buckets)


@query
def d05_rolling_means_bucketed(spark, sf):
    """As d05_rolling_means, from a table bucketed by station: targets and means without a shuffle."""
    filled = fj.preprocessed_series(bucketed_rows(spark, sf), FEED, laid_out=True)
    names = ("Temp_roll6h", "Temp_roll24h", "DewPoint_roll6h", "Pressure_roll6h")
    return keyed(ft.with_rolling(filled).frame(), *names)


@query
def d06_rolling_sums(spark, sf):
    return _rolled(spark, sf, "Rain_sum6h", "Rain_sum24h")


@query
def d07_changes(spark, sf):
    rows = ft.with_changes(ft.with_lags(filled_series(spark, sf)).frame())
    return keyed(rows, "TempChange_1h", "DewPointChange_1h", "PressureChange_1h")


@query
def d08_depression_copy(spark, sf):
    rows = filled_series(spark, sf).frame().withColumn("TempDewPoint", depression())
    return keyed(rows, "TempDewPoint", "DewPointDepression")


# ---- E: aggregates and profiles -----------------------------------------------------------------------


@query
def e01_audits(spark, sf):
    """Rows before and after the mask filter, the target filter and the completeness filter."""
    masked = pf.audit(raw_rows(spark, sf), F.col("MASK") == VALID_MASK)
    labelled = lb.with_targets(Series.of(rain_rows(spark, sf), FEED)).frame()
    targets = pf.audit(labelled, pf.all_present(labelled, lb.TARGETS))
    series = filled_series(spark, sf)
    features = ft.with_history(series.each(lambda rows: ft.with_calendar(rows, FEED)))
    rows = features.each(ft.with_changes).frame()
    complete = pf.audit(rows, pf.all_present(rows))
    parts = {"mask": masked, "targets": targets, "features": complete}
    return cl.union_all([a.withColumn("stage", F.lit(name)) for name, a in parts.items()])


@query
def e02_positive_ratio(spark, sf):
    return tidy_types(pf.positive_ratio(rain_rows(spark, sf)))


@query
def e03_medians(spark, sf):
    series = fj.labelled_series(clean_rows(spark, sf), FEED)
    medians = im.exact_medians(series.frame(), at_most=series.counted)
    return tidy_types(
        spark.createDataFrame(list(medians.items()), "measure string, median double")
    )


@query
def e04_missing_profile(spark, sf):
    return tidy_types(pf.missing_profile(clean_rows(spark, sf)))


@query
def e05_entities(spark, sf):
    return pf.entity_count(clean_rows(spark, sf))


@query
def e06_label_distribution(spark, sf):
    return pf.label_distribution(target_rows(spark, sf), "label_clf")


@query
def e07_histogram(spark, sf):
    rows = clean_rows(spark, sf).withColumn("DPD", depression())
    return tidy_types(pf.histogram(rows, ["Temperature", "DewPoint", "DPD"]))


@query
def e07_station_histogram(spark, sf):
    rows = clean_rows(spark, sf).withColumn("DPD", depression())
    return tidy_types(pf.station_histogram(rows, ["Temperature", "DPD"]))


@query
def e08_station_profile(spark, sf):
    return tidy_types(pf.station_profile(clean_rows(spark, sf)))


@query
def e09_coverage(spark, sf):
    return rg.coverage(feed.stations(spark, sf))


@query
def e10_split_sizes(spark, sf):
    return tidy_types(sp.split_sizes(sp.with_split(fj.feature_rows(clean_rows(spark, sf), FEED), FEED)))


@query
def e11_confusion_counts(spark, sf):
    return ev.confusion_counts(class_predictions(spark, sf))


@query
def e12_confusion_matrix(spark, sf):
    return ev.confusion_matrix(class_predictions(spark, sf))


# ---- F: order and limits ------------------------------------------------------------------------------


@query
def f01_ordered(spark, sf):
    return ev.confusion_counts(class_predictions(spark, sf, "LAG3"))


@query
def f02_head(spark, sf):
    return tidy_types(pf.head_rows(clean_rows(spark, sf), KEYS))


@query
def f03_capped_sample(spark, sf):
    rows = clean_rows(spark, sf)
    return keyed(sp.capped_sample(rows, "DewPoint", FEED.row_id(), SAMPLE_ROWS), "DewPoint")


@query
def f04_sampled_stations(spark, sf):
    valid = st.valid_stations(feed.stations(spark, sf))
    return st.sample_stations(valid, SAMPLED_STATIONS).select("StationID")


@query
def f05_station_list(spark, sf):
    return st.station_list(feed.stations(spark, sf))


@query
def f06_best_models(spark, sf):
    return tidy_types(ev.best_models(baseline_metrics(spark, sf)))


@query
def f07_best_per_metric(spark, sf):
    return tidy_types(ev.best_per_metric(baseline_metrics(spark, sf)))


# ---- G: joins and unions ------------------------------------------------------------------------------


@query
def g01_union_by_name(spark, sf):
    """Two inputs of different column order, united by name."""
    rows = raw_rows(spark, sf).select(*KEYS, "TMP", "DEW")
    odd = rows.filter(F.col("event_id") % 2 == 1).select("DEW", "TMP", *KEYS)
    even = rows.filter(F.col("event_id") % 2 == 0)
    return keyed(cl.union_all([even, odd]), "TMP", "DEW")


@query
def g02_of_stations(spark, sf):
    chosen = st.valid_stations(feed.stations(spark, sf))
    return keyed(cl.of_stations(raw_rows(spark, sf), chosen), "TMP")


@query
def g03_station_info(spark, sf):
    rows = cl.with_station_info(raw_rows(spark, sf), feed.stations(spark, sf))
    return keyed(rows, "latitude", "longitude", "ELEVATION", "valid_percent")


# ---- H: preparation and models ------------------------------------------------------------------------


def _indexed_stations(spark, sf) -> DataFrame:
    rows = feature_table(spark, sf).select("StationID")
    return pp.preparation(["StationID"]).fit(rows).transform(rows.distinct())


@query
def h01_string_index(spark, sf):
    return _indexed_stations(spark, sf).select("StationID", F.col("StationID_idx").cast("bigint").alias("idx"))


@query
def h01_string_index_distributed(spark, sf):
    """As h01_string_index, with the labels as a table from end to end."""
    rows = feature_table(spark, sf).select("StationID")
    index = pp.label_index(rows, "StationID")
    return pp.with_label_index(rows.distinct(), index, "StationID", "idx").select("StationID", "idx")


@query
def h02_one_hot(spark, sf):
    dense = vector_to_array("StationID_vec")
    return _indexed_stations(spark, sf).select(
        "StationID",
        F.size(dense).cast("bigint").alias("width"),
        (F.array_position(dense, 1.0) - 1).alias("active"),
    )


def _vectors(spark, sf, column: str) -> DataFrame:
    """The numeric part of a feature vector as columns again, and the vector's width."""
    rows = feature_table(spark, sf)
    vectors = pp.fit_base(rows, FEED).transform(rows)
    # Only the numeric positions are made dense: the rest is as wide as there are stations.
    numeric = VectorSlicer(inputCol=column, outputCol="numeric", indices=list(range(len(NUMERIC_FEATURES)))).transform(vectors)
    numeric = numeric.select(*KEYS, pp.vector_width(column).alias("width"), vector_to_array("numeric").alias("v"))
    return tidy_types(
        numeric.select(*KEYS, "width", *[F.col("v")[i].alias(name) for i, name in enumerate(NUMERIC_FEATURES)])
    )


@query
def h03_assembled(spark, sf):
    return _vectors(spark, sf, "features_raw")


@query
def h04_scaled(spark, sf):
    return _vectors(spark, sf, "features")


@query
def h05_base_stages(spark, sf):
    """What the shared preparation yields: rows, and the width of their vectors."""
    rows = feature_table(spark, sf)
    widths = pp.fit_base(rows, FEED).transform(rows).select(pp.vector_width("features").alias("width"))
    return tidy_types(widths.agg(F.count(F.lit(1)).alias("rows"), F.max("width").alias("width")))


@query
def h06_hash_split(spark, sf):
    return keyed(sp.with_split(clean_rows(spark, sf), FEED), "split")


@query
def h06_csv_split(spark, sf):
    """Rows of the CSV files, and how many change sides or keys when the files are cut into other input splits."""
    csv = feed.write_observation_files(spark, sf)
    spec, setting, packing = SeriesSpec(), "spark.sql.files.maxPartitionBytes", "spark.sql.files.maxPartitionNum"
    usual, packed = spark.conf.get(setting), spark.conf.get(packing, None)
    sides = []
    for size in (usual, "2k"):
        spark.conf.set(setting, size)
        # Files are cut at the size all the same; the pieces share tasks, as one for each would be a task per file or more.
        spark.conf.set(packing, str(FILE_TASKS * spark.sparkContext.defaultParallelism))
        try:
            # Staged, because the scan is planned with the setting of the moment.
            rows = sp.with_split(ob.read_observations(spark, csv), spec).select("StationID", "row_key", "split")
            sides.append(stage(rows, "csv-split"))
        finally:
            spark.conf.set(setting, usual)
            spark.conf.unset(packing) if packed is None else spark.conf.set(packing, packed)
    one, two = sides
    return one.agg(F.count(F.lit(1)).alias("rows")).crossJoin(
        one.exceptAll(two).agg(F.count(F.lit(1)).alias("moved"))
    )


@query
def h07_split_placement(spark, sf):
    train, test = sp.placed(*split_tables(spark, sf), partitions=32)
    sizes = [
        part.groupBy(F.spark_partition_id().alias("p")).count().agg(
            F.lit(name).alias("split"),
            F.count(F.lit(1)).alias("partitions"),
            F.sum("count").alias("rows"),
        )
        for name, part in (("train", train), ("test", test))
    ]
    return cl.union_all(sizes)


def _trainer(spark, sf) -> md.Trainer:
    key = (spark.sparkContext.applicationId, sf)
    if key not in _trainers:
        _trainers[key] = md.Trainer(split_tables(spark, sf)[0], FEED, _folder(spark, "models"))
    return _trainers[key]


def _predicted(spark, sf, task: str, name: str) -> DataFrame:
    _, test = split_tables(spark, sf)
    model = _trainer(spark, sf).model(task, name)
    return keyed(md.score(model, test), md.TASK_LABEL[task], "prediction")


@query
def h08_logistic_regression(spark, sf):
    return _predicted(spark, sf, "clf", "lr")


@query
def h09_forest_classifier(spark, sf):
    return _predicted(spark, sf, "clf", "rf")


@query
def h10_boosted_classifier(spark, sf):
    return _predicted(spark, sf, "clf", "gbt")


@query
def h11_linear_regression(spark, sf):
    return _predicted(spark, sf, "reg", "linear")


@query
def h11_single_feature_line(spark, sf):
    """One-feature least squares, comparable with SQL."""
    rows = lb.with_regression_label(feature_table(spark, sf)).select("Temp_roll24h", "label_reg")
    assembled = VectorAssembler(inputCols=["Temp_roll24h"], outputCol="x").transform(rows)
    line = LinearRegression(featuresCol="x", labelCol="label_reg", regParam=0.0).fit(assembled)
    return tidy_types(
        spark.createDataFrame(
            [(float(line.coefficients[0]), float(line.intercept))], "slope double, intercept double"
        )
    )


@query
def h12_forest_regressor(spark, sf):
    return _predicted(spark, sf, "reg", "rf")


@query
def h13_boosted_regressor(spark, sf):
    return _predicted(spark, sf, "reg", "gbt")


@query
def h14_train_or_load(spark, sf):
    """A model asked for twice is fitted once: the second answer is the stored one, under the same identifier."""
    trainer = _trainer(spark, sf)
    rows = []
    for task, name in (("clf", "lr"), ("reg", "linear")):
        path = md.model_path(trainer.store, task, name, trainer.key)
        first = trainer.model(task, name)
        again = md.Trainer(trainer.train, trainer.spec, trainer.store, trainer.settings).model(task, name)
        same = [s.uid for s in first.stages] == [s.uid for s in again.stages]
        rows.append((task, name, exists(spark, path), same, len(again.stages)))
    return spark.createDataFrame(rows, "task string, model string, stored boolean, same boolean, stages bigint")


@query
def h14_model_statements(spark, sf):
    """What holds for a right fit of any of the six models: every test row gets a valid prediction, the
    forest of averages stays within the labels it saw, and on its own training rows a model beats the best constant."""
    train, test = split_tables(spark, sf)
    trainer, rows = _trainer(spark, sf), []
    models = trainer.models([("clf", n) for n in md.CLASSIFIERS] + [("reg", n) for n in md.REGRESSORS])
    # The preparation is the same in all six, so the vectors of either part are written once.
    shared = PipelineModel(stages=models["clf", "lr"].stages[:-1])
    tested = stage(md.score(shared, test).select("features", *md.TASK_LABEL.values()), "test-vectors")
    learned = trainer.vectors()
    for (task, name), model in models.items():
        label = md.TASK_LABEL[task]
        last = PipelineModel(stages=model.stages[-1:])
        low, high, constant = train.agg(
            F.min(label), F.max(label), F.greatest(F.avg(label), 1 - F.avg(label)) if task == "clf" else F.var_pop(label)
        ).first()
        said = F.col("prediction")
        valid = said.isin(0.0, 1.0) if task == "clf" else said.between(low, high) if name == "rf" else ~F.isnan(said)
        scored = md.score(last, tested).agg(F.count(F.lit(1)), F.count_if(valid)).first()
        error = F.avg((said != F.col(label)).cast("double") if task == "clf" else (said - F.col(label)) ** 2)
        missed = md.score(last, learned).agg(error).first()[0]
        better = missed <= 1 - constant if task == "clf" else missed < constant
        rows.append((task, name, *scored, bool(better)))
    return spark.createDataFrame(rows, "task string, model string, rows bigint, valid bigint, beats_constant boolean")


@query
def h11_normal_equations(spark, sf):
    """Least squares without penalty: residuals on the training rows are orthogonal to every scaled input."""
    train, _ = split_tables(spark, sf)
    base = pp.fit_base(train, FEED)
    vectors = base.transform(train).select("features", "label_reg")
    line = md.estimator("reg", "linear", md.ModelSettings(l2=0.0)).fit(vectors)
    residual = F.col("label_reg") - F.col("prediction")
    scored = line.transform(vectors).select(residual.alias("r"), "features")
    # Zeros of an input add to no sum, and all inputs share the sum over the squared residuals.
    held = scored.select("r", F.inline(pp.vector_entries("features")))
    sums = held.groupBy("at").agg(F.sum(F.col("r") * F.col("x")).alias("rx"), F.sum(F.col("x") ** 2).alias("xx"))
    whole = scored.agg(F.sum(F.col("r") ** 2).alias("rr"))
    # Per input: the cosine between residuals and input, which is scale-free.
    cosine = F.try_divide(F.abs("rx"), F.sqrt(F.col("rr") * F.col("xx")))
    inputs = _positions(spark, vectors).join(sums, "at", "left").join(F.broadcast(whole))
    cosines = inputs.select(cosine.alias("c"))
    return cosines.agg(F.count(F.lit(1)).alias("inputs"), F.count_if(F.coalesce("c", F.lit(0.0)) < 1e-4).alias("orthogonal"))


@query
def h15_batch_scoring(spark, sf):
    """Every test row is scored."""
    _, test = split_tables(spark, sf)
    scored = md.score(_trainer(spark, sf).model("clf", "lr"), test)
    return scored.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("prediction").isin(0.0, 1.0)).alias("scored")
    )


def _stored_trees(spark, sf, task: str, name: str) -> tuple[DataFrame, DataFrame, md.Trainer]:
    """Prepared rows with a key and the model's predictions, its node table, and the trainer; test rows first."""
    trainer = _trainer(spark, sf)
    model = trainer.model(task, name)
    path = md.model_path(trainer.store, task, name, trainer.key)
    return model, tr.tree_table(spark, path, model.stages[-1].uid), trainer


def _said(model, rows: DataFrame, label: str) -> DataFrame:
    """Key, label, vector and prediction of rows, written: the walk and the model are compared on the same ones."""
    scored = model.transform(rows).select(*KEYS, F.col(label).alias("label"), "features", "prediction")
    return stage(scored, "said")


def _agreeing(said: DataFrame, walked: DataFrame) -> DataFrame:
    both = said.join(walked, list(KEYS), "left")
    near = F.abs(F.col("walked") - F.col("prediction")) <= 1e-9 * (1 + F.abs(F.col("prediction")))
    return both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(near).alias("agreeing"))


@query
def h09_walked(spark, sf):
    """Votes of the stored forest by joins with its node table, against the fitted model, on every test row."""
    model, trees, trainer = _stored_trees(spark, sf, "clf", "rf")
    said = _said(model, split_tables(spark, sf)[1], md.TASK_LABEL["clf"])
    ends = tr.walked(said.select(*KEYS, "features"), trees, trainer.settings.forest_depth, keys=list(KEYS))
    return _agreeing(said, tr.forest_votes(ends, list(KEYS)))


@query
def h12_walked(spark, sf):
    """Means of the stored forest by joins with its node table, against the fitted model, on every test row."""
    model, trees, trainer = _stored_trees(spark, sf, "reg", "rf")
    said = _said(model, split_tables(spark, sf)[1], md.TASK_LABEL["reg"])
    ends = tr.walked(said.select(*KEYS, "features"), trees, trainer.settings.forest_depth, keys=list(KEYS))
    return _agreeing(said, tr.forest_means(ends, list(KEYS)))


def _staged(spark, sf, task: str) -> DataFrame:
    """Stages of a boosted model over its training rows: how many, how often the loss rises, and whether the last
    stage says what the fitted model says."""
    model, trees, trainer = _stored_trees(spark, sf, task, "gbt")
    said = _said(model, split_tables(spark, sf)[0], md.TASK_LABEL[task])
    ends = tr.walked(said.select(*KEYS, "label", "features"), trees, trainer.settings.boost_depth, keys=list(KEYS))
    margins = stage(tr.staged_margins(ends, list(KEYS)).select(*KEYS, "label", "tree", "margin"), "margins")
    loss = (tr.log_loss if task == "clf" else tr.squared_loss)(F.col("label"), F.col("margin"))
    # A row for each tree of the model.
    losses = tr.staged_loss(margins, loss).withColumn("before", F.lag("loss").over(Window.partitionBy(F.lit(0)).orderBy("tree")))
    counts = losses.agg(
        F.count(F.lit(1)).alias("stages"), F.count_if(F.col("loss") > F.col("before") * (1 + 1e-12)).alias("rises")
    )
    last = margins.join(F.broadcast(trees.agg(F.max("tree").alias("tree"))), "tree")
    final = F.when(F.col("margin") > 0, 1.0).otherwise(0.0) if task == "clf" else F.col("margin")
    return counts.join(F.broadcast(_agreeing(said, last.select(*KEYS, final.alias("walked")))))


@query
def h10_staged_loss(spark, sf):
    return _staged(spark, sf, "clf")


@query
def h13_staged_loss(spark, sf):
    return _staged(spark, sf, "reg")


@query
def h08_stationary(spark, sf):
    """At the fitted coefficients the penalised loss is flat in the direction of every input."""
    train, _ = split_tables(spark, sf)
    trainer = _trainer(spark, sf)
    model = trainer.model("clf", "lr")
    base = PipelineModel(stages=model.stages[:-1])
    inputs = stage(ln.sparse_inputs(train, base, FEED, list(KEYS)), "inputs")
    weights = ln.coefficients(model.stages[-1], train)
    slopes = ln.logistic_gradient(inputs, train, weights, list(KEYS), md.TASK_LABEL["clf"], trainer.settings.l2)
    flat = F.count_if((F.col("at") != ln.INTERCEPT) & (F.abs("gradient") < 1e-3)).alias("flat")
    return slopes.agg(
        F.count_if(F.col("at") != ln.INTERCEPT).alias("inputs"),
        flat,
        F.count_if((F.col("at") == ln.INTERCEPT) & (F.abs("gradient") < 1e-3)).alias("flat_intercepts"),
    )


@query
def h15_scores_by_join(spark, sf):
    """Every test row's score from coefficients joined to its inputs, against the fitted models.

    The two models are fitted side by side. They share the preparation of their trainer, so rows are prepared once, and
    the inputs of a row meet the coefficients of both models in one join and one grouped sum.
    """
    _, test = split_tables(spark, sf)
    wanted = {("clf", "lr"): "rawPrediction", ("reg", "linear"): "prediction"}
    models = _trainer(spark, sf).models(list(wanted))
    base = PipelineModel(stages=next(iter(models.values())).stages[:-1])
    scored, weights, names = base.transform(test).select(*KEYS, "features"), None, []
    for (task, name), column in wanted.items():
        line = models[task, name].stages[-1]
        rows = md.score(PipelineModel(stages=[line]), scored)
        said = ev.score_value(rows, column)
        scored = rows.select(*scored.columns, said.alias(f"said_{task}"))
        own = ln.coefficients(line, test).withColumnRenamed("weight", task)
        weights = own if weights is None else weights.join(own, "at")
        names.append(task)
    inputs = ln.sparse_inputs(test, base, FEED, list(KEYS))
    dots = ln.dot_products(inputs, weights, list(KEYS), {task: f"walked_{task}" for task in names})
    both = scored.drop("features").join(dots, list(KEYS), "left")
    near = {c: F.abs(F.col(f"walked_{c}") - F.col(f"said_{c}")) <= 1e-6 * (1 + F.abs(F.col(f"said_{c}"))) for c in names}
    counts = both.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(near[c]).alias(c) for c in names])
    lines = [F.struct(F.lit(t).alias("task"), F.lit(n).alias("model"), "rows", F.col(t).alias("agreeing")) for t, n in wanted]
    return counts.select(F.inline(F.array(*lines)))


@query
def h05_vector_sums(spark, sf):
    """Sums over all rows of every position of the prepared vectors."""
    rows = feature_table(spark, sf)
    vectors = pp.fit_base(rows, FEED).transform(rows)
    held = vectors.select(F.inline(pp.vector_entries("features")))
    sums = held.groupBy(F.col("at").cast("bigint").alias("at")).agg(F.round(F.sum("x"), 3).alias("total"))
    # Positions that are zero in every row add up to zero.
    every = _positions(spark, vectors).join(sums, "at", "left")
    return every.select("at", (F.coalesce("total", F.lit(0.0)) + 0.0).alias("total"))


def _positions(spark, vectors: DataFrame) -> DataFrame:
    """(at) of every position of vectors of one preparation."""
    return spark.range(vectors.agg(F.max(pp.vector_width("features"))).first()[0] or 0).withColumnRenamed("id", "at")


# ---- I: evaluation ------------------------------------------------------------------------------------


@query
def i01_auc(spark, sf):
    rows = [
        (name, ev.area_under_roc(class_predictions(spark, sf, name), bins=0)) for name in class_baselines()
    ]
    return tidy_types(spark.createDataFrame(rows, "model string, auc double"))


@query
def i01_auc_by_station(spark, sf):
    """The area of the persistence score at every station, in one pass; null where a station has one class only."""
    areas = ev.areas_under_roc(class_predictions(spark, sf), ["StationID"])
    return tidy_types(areas.withColumnRenamed("AUC-ROC", "auc"))


def _class_metric(spark, sf, metric: str, name: str):
    return tidy_types(ev.class_metrics(class_predictions(spark, sf)).select(F.col(f"`{metric}`").alias(name)))


@query
def i02_accuracy(spark, sf):
    return _class_metric(spark, sf, "Accuracy", "accuracy")


@query
def i03_weighted_f1(spark, sf):
    return _class_metric(spark, sf, "F1-Score", "f1")


@query
def i04_weighted_precision(spark, sf):
    return _class_metric(spark, sf, "Precision", "precision")


@query
def i05_weighted_recall(spark, sf):
    return _class_metric(spark, sf, "Recall", "recall")


def _value_metric(spark, sf, metric: str):
    rows = ev.evaluate_regression(value_predictions(spark, sf))
    return tidy_types(rows.filter(F.col("metric") == metric))


@query
def i06_rmse(spark, sf):
    return _value_metric(spark, sf, "RMSE")


@query
def i07_mae(spark, sf):
    return _value_metric(spark, sf, "MAE")


@query
def i08_r2(spark, sf):
    return _value_metric(spark, sf, "R2")


@query
def i09_evaluate(spark, sf):
    return tidy_types(baseline_metrics(spark, sf))


@query
def i10_compare_classifiers(spark, sf):
    return tidy_types(ev.compare_models(baseline_metrics(spark, sf), "classification"))


@query
def i10_compare_regressors(spark, sf):
    return tidy_types(ev.compare_models(baseline_metrics(spark, sf), "regression"))


@query
def i11_printable(spark, sf):
    return ev.printable(baseline_metrics(spark, sf))


# ---- J: jobs ------------------------------------------------------------------------------------------


@query
def j01_preprocess(spark, sf):
    return tidy_types(fj.preprocess(clean_rows(spark, sf), FEED))


@query
def j02_feature_rows(spark, sf):
    return tidy_types(fj.feature_rows(clean_rows(spark, sf), FEED))


@query
def j02_feature_rows_in_blocks(spark, sf):
    """As j02_feature_rows, with the longer stations cut into blocks on the way."""
    return tidy_types(fj.feature_rows(clean_rows(spark, sf), FEED, max_rows=SHORT_BLOCKS))


@query
def j03_classification(spark, sf):
    _, test = split_tables(spark, sf)
    metrics, _ = fc.run_classification(_trainer(spark, sf), test)
    return tidy_types(metrics)


def _grid(metrics: DataFrame) -> DataFrame:
    """Models and metrics of a run, and whether each value lies where it can."""
    bounded = F.col("value").between(0.0, 1.0) | F.col("metric").isin("RMSE", "MAE", "R2")
    return metrics.select("task", "model", "metric", (bounded & ~F.isnan("value")).alias("possible"))


@query
def j03_classification_grid(spark, sf):
    """Every model has every metric, and each confusion matrix sums up to the test rows."""
    _, test = split_tables(spark, sf)
    metrics, matrices = fc.run_classification(_trainer(spark, sf), test)
    sums = matrices.select(
        F.lit("classification").alias("task"),
        "model",
        F.lit("rows").alias("metric"),
        (F.col("TP") + F.col("FP") + F.col("FN") + F.col("TN") == F.lit(test.count())).alias("possible"),
    )
    return _grid(metrics).unionByName(sums)


@query
def j04_regression(spark, sf):
    _, test = split_tables(spark, sf)
    return tidy_types(fc.run_regression(_trainer(spark, sf), test))


@query
def j04_regression_grid(spark, sf):
    _, test = split_tables(spark, sf)
    return _grid(fc.run_regression(_trainer(spark, sf), test))


def _values(spark, metrics: DataFrame, table: DataFrame, task: str) -> DataFrame:
    """Metrics of a run, the test rows each was taken over, and whether one grouped aggregate over the written
    predictions gives the same values."""
    again = ev.grouped_metrics(table, task).withColumnRenamed("value", "again")
    sizes = table.groupBy("model").agg(F.count(F.lit(1)).alias("rows"))
    both = metrics.join(again, ["model", "metric"], "left").join(sizes, "model", "left")
    same = F.abs(F.col("value") - F.col("again")) <= 1e-9 * (1 + F.abs(F.col("value")))
    return both.select("task", "model", "metric", "rows", F.coalesce(same, F.lit(False)).alias("same"))


@query
def j03_classification_values(spark, sf):
    _, test = split_tables(spark, sf)
    folder = _folder(spark, "predictions")
    metrics, _ = fc.run_classification(_trainer(spark, sf), test, predictions=folder)
    return _values(spark, metrics, spark.read.schema(fc.PREDICTIONS).parquet(folder), "classification")


@query
def j04_regression_values(spark, sf):
    _, test = split_tables(spark, sf)
    folder = _folder(spark, "predictions")
    metrics = fc.run_regression(_trainer(spark, sf), test, predictions=folder)
    return _values(spark, metrics, spark.read.schema(fc.PREDICTIONS).parquet(folder), "regression")


_runs: dict[tuple[str, str], str] = {}


def _whole_run(spark, sf) -> str:
    """Where a run over the files of all valid stations left its results; made once per application."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _runs:
        csv, meta = feed.write_station_files(spark, sf)
        out = _folder(spark, "run")
        job.run(spark, csv, meta, out, stations=None)
        _runs[key] = out
    return _runs[key]


@query
def j05_run_audits(spark, sf):
    """What the run itself counted before and after its three filters."""
    out = _whole_run(spark, sf)
    return cl.union_all([tb.load_frame(spark, f"{out}/audits/{part}") for part in ("mask", "features")])


@query
def j05_run_values(spark, sf):
    """Sums over the run's feature table: its values, not only its size."""
    train, test = tb.load_split(spark, f"{_whole_run(spark, sf)}/features")
    rows = train.unionByName(test)
    named = ("Temperature", "Temp_lag24", "Rain_sum24h", "Temp_roll6h", "PressureChange_1h", "Temp_next")
    return rows.agg(
        F.count(F.lit(1)).alias("rows"), *[F.round(F.sum(c), 3).alias(c) for c in named]
    )


@query
def j05_whole_run(spark, sf):
    """Files to metrics document, then the rows of the written feature table per split."""
    document = mt.read_metrics(spark, f"{_whole_run(spark, sf)}/metrics")
    return document.select(
        F.size("classification").cast("bigint").alias("classifiers"),
        F.size("regression").cast("bigint").alias("regressors"),
        (F.col("train_count") + F.col("test_count")).alias("rows"),
    )
