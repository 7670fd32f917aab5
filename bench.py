"""Time the headline queries: one JSON line, seconds per query.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the local cores. Results go to a sink that computes every
row and keeps none. A first pass over the smallest tables warms the JVM up and is not timed. What queries share
(the staged feature table, fitted models, a whole run) is made and timed apart, under ``stage_features``, or
forgotten before each query that pays for it. ``wide_features`` repeats the events as many series, which makes
about 4 million rows at scale factor 0.1.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from stationflow.plans import feature_job, queries
from stationflow.plans.queries import QUERIES

COPIES = 100

HEADLINE = (
    "a05_station_rows",
    "b13_regions",
    "d01_targets",
    "d05_rolling_means",
    "e03_medians",
    "e04_missing_profile",
    "e07_histogram",
    "e07_station_histogram",
    "e08_station_profile",
    "f03_capped_sample",
    "g03_station_info",
    "h04_scaled",
    "h08_logistic_regression",
    "h09_forest_classifier",
    "h10_boosted_classifier",
    "h11_linear_regression",
    "h12_forest_regressor",
    "h13_boosted_regressor",
    "i09_evaluate",
    "j01_preprocess",
    "j02_feature_rows",
    "j05_whole_run",
)


def timed(spark: SparkSession, name: str, folder: str) -> float:
    # Each query fits its own models; the staged feature table stays, its making is timed apart.
    queries._trainers.clear()
    queries._runs.clear()
    began = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def timed_staging(spark: SparkSession, folder: str) -> float:
    queries._features.clear()
    began = time.perf_counter()
    queries.feature_table(spark, folder)
    return time.perf_counter() - began


def timed_wide_features(spark: SparkSession, folder: str) -> float:
    """Feature rows of every station taken ``COPIES`` times under other names."""
    rows = queries.clean_rows(spark, folder).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(COPIES))))
    rows = rows.withColumn("StationID", F.concat_ws("-", "StationID", "copy")).drop("copy")
    began = time.perf_counter()
    feature_job.feature_rows(rows, queries.FEED).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    warm = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    for name in ("e07_histogram", "j02_feature_rows"):
        timed(spark, name, warm if os.path.isdir(warm) else folder)
    seconds = {"stage_features": round(timed_staging(spark, folder), 3)}
    seconds |= {name: round(timed(spark, name, folder), 3) for name in HEADLINE}
    seconds["wide_features"] = round(timed_wide_features(spark, folder), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
