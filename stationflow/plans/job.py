"""The whole run: observation files to metrics document, resumable at each written table.

    python -m stationflow.plans.job --observations DIR --metadata PATH --out DIR [--stations N] [--force]
"""

from __future__ import annotations

import argparse
import json
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.operators.clean import canonical, parsed
from stationflow.operators.evaluate import DECIDING_METRIC, compare_models
from stationflow.operators.labels import with_rain, with_regression_label
from stationflow.operators.models import CLASSIFIERS, REGRESSORS, Trainer
from stationflow.operators.profile import all_present, positive_ratio, summary_frame
from stationflow.operators.sampling import split_column
from stationflow.plans.feature_job import feature_rows
from stationflow.plans.forecast import run_classification, run_regression
from stationflow.sources.metrics import save_metrics
from stationflow.sources.observations import load_observations
from stationflow.sources.tables import load_frame, load_part, load_split, part_sizes, save_frame, save_split
from stationflow.spec import (
    MIN_VALID_SHARE,
    RAIN_THRESHOLD,
    SEED,
    STATION_SAMPLE,
    TEST_SHARE,
    VALID_MASK,
    ModelSettings,
    SeriesSpec,
)
from stationflow.storage import delete, exists, scratch

log = logging.getLogger(__name__)
AUDITS = "stage string, before bigint, after bigint, removed bigint"


# What a run writes below its folder; nothing else there is touched.
OUTPUTS = ("clean", "features", "models", "metrics", "audits", "comparison", "confusion", "predictions")


def run(
    spark: SparkSession,
    observations: str,
    metadata: str,
    out: str,
    stations: int | None = STATION_SAMPLE,
    minimum: float = MIN_VALID_SHARE,
    settings: ModelSettings = ModelSettings(),
    force: bool = False,
    threshold: float = RAIN_THRESHOLD,
    test_share: float = TEST_SHARE,
    tag: str | None = None,
) -> DataFrame:
    """Tidy metrics of all six models; every finished table, model and document stays below ``out``.

    A run continues from what an earlier run of the same inputs and parameters finished: the split feature table,
    else the cleaned observations, else the files. Tables of other parameters are made again, and models know
    their own rows and settings. ``force`` makes everything again: once the inputs are found, what runs write is
    deleted, and nothing else. ``stations=None`` takes all valid stations; ``tag`` names the source of the metrics.
    """
    out = out.rstrip("/")
    for path in (observations, metadata):
        if not exists(spark, path):
            raise ValueError(f"{path} does not exist")
    if force:
        for name in OUTPUTS:
            delete(spark, f"{out}/{name}")
            delete(spark, _mark(f"{out}/{name}"))
    with scratch(spark):
        return _run(spark, observations, metadata, out, stations, minimum, settings, threshold, test_share, tag)


def _run(spark, observations, metadata, out, stations, minimum, settings, threshold, test_share, tag):
    spec = SeriesSpec()
    read = {"observations": observations, "metadata": metadata, "stations": stations, "minimum": minimum, "seed": SEED}
    made = {**read, "threshold": threshold, "test_share": test_share}
    cleaned_now = _clean(spark, out, read) if not _matches(spark, f"{out}/features", made) else None
    train, test = _features(spark, out, made, spec, cleaned_now)
    # Row counts of Parquet partitions come from file footers.
    sizes = train.count(), test.count()
    log.info("train %d rows, test %d rows", *sizes)
    labelled = with_regression_label(train)
    trainer = Trainer(labelled, spec, f"{out}/models", settings)
    # All six side by side; the two evaluations find them there.
    trainer.models([*[("clf", name) for name in CLASSIFIERS], *[("reg", name) for name in REGRESSORS]])
    classification, matrices = run_classification(trainer, test, CLASSIFIERS, f"{out}/predictions/clf")
    regression = run_regression(trainer, test, REGRESSORS, f"{out}/predictions/reg")
    save_frame(matrices.coalesce(1), f"{out}/confusion")
    metrics = classification.unionByName(regression)
    for row in matrices.collect():
        log.info("confusion matrix %s", row.asDict())
    for task in DECIDING_METRIC:
        table = compare_models(metrics, task)
        save_frame(table.coalesce(1), f"{out}/comparison/{task}")
        for row in table.collect():
            log.info("%s %s", task, row.asDict())
    save_metrics(metrics, f"{out}/metrics", *sizes, tag)
    return metrics


def _mark(path: str) -> str:
    return f"{path}.inputs"


def _matches(spark: SparkSession, path: str, inputs: dict) -> bool:
    """Whether the table at ``path`` was finished from exactly these inputs."""
    if load_frame(spark, path) is None or not exists(spark, _mark(path)):
        return False
    return [r["value"] for r in spark.read.text(_mark(path)).collect()] == [json.dumps(inputs)]


def _finished(spark: SparkSession, path: str, inputs: dict) -> None:
    spark.createDataFrame([(json.dumps(inputs),)], "value string").coalesce(1).write.mode("overwrite").text(_mark(path))


def _clean(spark: SparkSession, out: str, inputs: dict) -> DataFrame:
    path = f"{out}/clean"
    if not _matches(spark, path, inputs):
        names = ("observations", "metadata", "stations", "minimum", "seed")
        raw = load_observations(spark, *[inputs[n] for n in names])
        delete(spark, _mark(path))
        # Text is parsed once; every later pass reads columns. What the mask removes is a partition of its own, so
        # counting it needs no second look at the files.
        part = F.when(F.col("MASK") == VALID_MASK, "valid").otherwise("masked")
        save_split(canonical(raw.withColumn("split", part)), path)
        sizes = part_sizes(spark, path)
        if not sizes.get("valid"):
            raise ValueError("no valid observation")
        _finished(spark, path, inputs)
        counts = {"before": sum(sizes.values()), "after": sizes["valid"]}
        _save_audits(spark, f"{out}/audits/mask", {"mask": counts})
        for row in summary_frame(load_part(spark, path, "valid")).collect():
            log.info("%s", row.asDict())
    return load_part(spark, path, "valid")


def _features(spark, out, inputs, spec, cleaned) -> tuple[DataFrame, DataFrame]:
    path = f"{out}/features"
    if cleaned is not None:
        delete(spark, _mark(path))
        # Incomplete rows (the first ones of each station) are a partition that no reader takes, only counts.
        rows = feature_rows(cleaned, spec, complete=False, threshold=inputs["threshold"])
        side = F.when(all_present(rows), split_column(spec, inputs["test_share"])).otherwise("incomplete")
        save_split(rows.withColumn("split", side), path)
        sizes = part_sizes(spark, path)
        complete = sizes.get("train", 0) + sizes.get("test", 0)
        if not complete:
            raise ValueError("no feature rows to train on")
        _finished(spark, path, inputs)
        # The clean table is columns by now: labels and their ratio need three of them.
        labelled = with_rain(parsed(cleaned, spec), inputs["threshold"])
        ratio = positive_ratio(labelled).first()
        log.info("rain in %d of %d rows (%.2f %%)", *ratio)
        counts = {"before": sum(sizes.values()), "after": complete}
        audits = {"targets": {"before": ratio["rows"], "after": counts["before"]}, "features": counts}
        _save_audits(spark, f"{out}/audits/features", audits)
    else:
        log.info("continuing from %s", path)
    return load_split(spark, path)


def _save_audits(spark: SparkSession, path: str, counts: dict[str, dict[str, int]]) -> None:
    rows = [(name, c["before"], c["after"], c["before"] - c["after"]) for name, c in counts.items()]
    for row in rows:
        log.info("%s filter: %d rows before, %d after, %d removed", *row)
    save_frame(spark.createDataFrame(rows, AUDITS).coalesce(1), path)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("--observations", required=True)
    parser.add_argument("--metadata", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--stations", type=int, default=STATION_SAMPLE, help="0 takes all valid ones")
    parser.add_argument("--min-valid", type=float, default=MIN_VALID_SHARE)
    parser.add_argument("--fast", action="store_true", help="lighter model settings")
    parser.add_argument("--force", action="store_true", help="start over")
    parser.add_argument("--tag", help="source named in the metrics document")
    args = parser.parse_args()
    logging.basicConfig(level=logging.INFO, format="%(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    spark = SparkSession.builder.appName("stationflow").getOrCreate()
    settings = ModelSettings.fast() if args.fast else ModelSettings()
    metrics = run(
        spark,
        args.observations,
        args.metadata,
        args.out,
        stations=args.stations or None,
        minimum=args.min_valid,
        settings=settings,
        force=args.force,
        tag=args.tag,
    )
    metrics.show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
