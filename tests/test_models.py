"""Models on a frame with something to learn."""

import math
from pathlib import Path
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from helpers import ROW
from stationflow.operators import linear as ln
from stationflow.operators import models as md
from stationflow.operators import prepare as pp
from stationflow.operators import sampling as sp
from stationflow.operators.evaluate import area_under_roc, evaluate_regression
from stationflow.operators.labels import with_regression_label
from stationflow.plans import feature_job as fj
from stationflow.plans import forecast as fc
from stationflow.plans.queries import QUERIES
from stationflow.sources.models import fingerprint
from stationflow.spec import ModelSettings
from stationflow.storage import stage

TINY = ModelSettings(forest_trees=8, forest_depth=6, boost_iterations=5, linear_iterations=50)


@pytest.fixture(scope="module")
def learnable(spark):
    stations, hours = 10, 400
    hour = F.floor(F.col("id") / stations)
    angle = hour * (2 * math.pi / 24)
    temperature = 15 + 8 * F.sin(angle) + F.col("id") % stations % 5
    noise = F.pmod(F.xxhash64("id"), F.lit(100)) / 100 - 0.5
    rows = spark.range(stations * hours).select(
        F.concat(F.lit("S"), F.col("id") % stations).alias("StationID"),
        F.date_format(F.timestamp_seconds(F.lit(1388534400) + hour * 3600), "yyyy-MM-dd HH:mm:ss").alias("datetime"),
        temperature.alias("Temperature"),
        (temperature - (3 + 2 * F.sin(angle + 1)) + noise).alias("DewPoint"),
        F.lit(90.0).alias("WindDirection"),
        F.lit(3.0).alias("WindSpeed"),
        (F.lit(1000.0) + noise).alias("Pressure"),
        F.col("id").alias("row_key"),
    )
    features = with_regression_label(stage(fj.feature_rows(rows, ROW), "learnable"))
    return sp.split_rows(features, ROW)


@pytest.fixture(scope="module")
def trainer(learnable, tmp_path_factory):
    return md.Trainer(learnable[0], ROW, str(tmp_path_factory.mktemp("models")), TINY)


@pytest.mark.parametrize("name", md.CLASSIFIERS)
def test_classifiers_learn(trainer, learnable, name):
    assert area_under_roc(md.score(trainer.model("clf", name), learnable[1])) > 0.98


@pytest.mark.parametrize("name", md.REGRESSORS)
def test_regressors_learn(trainer, learnable, name):
    predictions = md.score(trainer.model("reg", name), learnable[1])
    bound = 0.99 if name == "linear" else 0.95
    assert {r["metric"]: r["value"] for r in evaluate_regression(predictions).collect()}["R2"] > bound


def test_a_stored_model_is_loaded_and_other_settings_miss(trainer, learnable, monkeypatch):
    first = trainer.model("clf", "lr")
    monkeypatch.setattr(md, "fit_base", lambda *_: pytest.fail("fitted again"))
    again = md.Trainer(learnable[0].repartition(3), ROW, trainer.store, TINY)
    assert again.model("clf", "lr").stages[-1].coefficients == first.stages[-1].coefficients
    other = md.Trainer(learnable[0], ROW, trainer.store, ModelSettings(l2=0.5))
    assert other.key != trainer.key
    with pytest.raises(BaseException, match="fitted again"):
        other.model("clf", "lr")


def test_a_half_saved_model_does_not_count(trainer):
    trainer.model("clf", "lr")
    path = md.model_path(trainer.store, "clf", "lr", trainer.key)
    marker = Path(path) / "_COMPLETE"
    marker.unlink()
    assert md.load_model(trainer.train.sparkSession, path) is None
    marker.touch()
    assert md.load_model(trainer.train.sparkSession, path) is not None


def test_fingerprint_ignores_order_and_sees_every_row(spark):
    rows = spark.range(100).withColumn("v", F.col("id") * 2.0)
    key = fingerprint(rows, "s")
    assert key == fingerprint(rows.repartition(9).orderBy(F.desc("id")).select("v", "id"), "s")
    assert key != fingerprint(rows, "t")
    assert key != fingerprint(rows.filter("id > 0"), "s")
    assert key != fingerprint(rows.unionByName(rows), "s")


def test_unknown_models_are_refused():
    for task, name in (("clf", "linear"), ("reg", "lr"), ("clf", "svm")):
        with pytest.raises(ValueError):
            md.estimator(task, name, TINY)


def test_settings_reach_the_estimators(spark):
    forest = md.estimator("clf", "rf", ModelSettings())
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getMaxBins(), forest.getSubsamplingRate()) == (40, 8, 24, 0.5)
    assert md.estimator("reg", "gbt", ModelSettings()).getMaxIter() == 50
    assert md.estimator("reg", "gbt", ModelSettings.fast()).getMaxIter() == 30
    assert md.estimator("clf", "rf", ModelSettings.fast()).getNumTrees() == 32
    assert len(md.model_plan("clf", "lr", ROW).getStages()) == 5


def test_unseen_stations_get_their_own_index(spark):
    seen = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "StationID string")
    stages = pp.preparation(["StationID"]).getStages()
    model = pp.Pipeline(stages=stages).fit(seen)
    found = model.transform(spark.createDataFrame([("b",), ("a",), ("zzz",)], "StationID string"))
    assert [(r["StationID_idx"], r["StationID_vec"].size) for r in found.collect()] == [(0.0, 4), (1.0, 4), (3.0, 4)]


def test_models_are_fitted_side_by_side(learnable, tmp_path, monkeypatch):
    """Two fits wait for each other, which ends only if both are under way; the shared vectors are made once."""
    both, plain, bases = Barrier(2, timeout=60), md.ensembles.fit, []

    def fit(*args):
        both.wait()
        return plain(*args)

    monkeypatch.setattr(md.ensembles, "fit", fit)
    prepare = md.fit_base
    monkeypatch.setattr(md, "fit_base", lambda *args: bases.append(args) or prepare(*args))
    trainer = md.Trainer(learnable[0], ROW, str(tmp_path), TINY)
    metrics, _ = fc.run_classification(trainer, learnable[1], ("rf", "gbt"))
    assert {r["model"] for r in metrics.collect()} == {"RF", "GBT"} and len(bases) == 1


def test_models_fitted_side_by_side_are_the_same(trainer, learnable, tmp_path):
    wanted = [("clf", name) for name in md.CLASSIFIERS]
    found = md.Trainer(learnable[0], ROW, str(tmp_path), TINY).models(wanted)
    assert list(found) == wanted
    for (task, name), model in found.items():
        one, two = (m.stages[-1] for m in (model, trainer.model(task, name)))
        if name == "lr":
            assert one.coefficients.toArray() == pytest.approx(two.coefficients.toArray(), rel=1e-9)
        else:
            # The first line of a tree is its identifier.
            assert _shapes(one) == _shapes(two)


def _shapes(model) -> list[str]:
    return [t.toDebugString.split("\n", 1)[1] for t in model.trees]


def test_both_tasks(trainer, learnable):
    metrics, matrices = fc.run_classification(trainer, learnable[1])
    assert {r["model"]: r["TP"] + r["FP"] + r["FN"] + r["TN"] for r in matrices.collect()} == dict.fromkeys(
        ("LR", "RF", "GBT"), learnable[1].count()
    )
    assert metrics.count() == 15
    regression = fc.run_regression(trainer, learnable[1])
    assert {r["model"] for r in regression.collect()} == {"LINEAR", "RF", "GBT"} and regression.count() == 9


def test_scores_by_join_prepare_the_rows_once(spark, small, monkeypatch):
    """Both models share one set of inputs, one prepared table and one grouped sum, and are fitted side by side."""
    calls = {"inputs": 0, "sums": 0, "together": []}
    inputs, sums, fits = ln.sparse_inputs, ln.dot_products, md.Trainer.models

    def counted(name, fn):
        def run(*a, **k):
            calls[name] += 1
            return fn(*a, **k)

        return run

    monkeypatch.setattr(ln, "sparse_inputs", counted("inputs", inputs))
    monkeypatch.setattr(ln, "dot_products", counted("sums", sums))
    monkeypatch.setattr(md.Trainer, "models", lambda self, wanted: calls["together"].append(list(wanted)) or fits(self, wanted))
    rows = {(r["task"], r["model"]): (r["rows"], r["agreeing"]) for r in QUERIES["h15_scores_by_join"](spark, small).collect()}
    assert calls == {"inputs": 1, "sums": 1, "together": [[("clf", "lr"), ("reg", "linear")]]}
    assert len(rows) == 2 and all(n == same > 0 for n, same in rows.values())


def test_several_dot_products_in_one_pass(spark):
    inputs = spark.createDataFrame([(1, 0, 2.0), (1, 1, 3.0), (2, -1, 1.0), (2, 1, 5.0)], "id int, at int, x double")
    weights = spark.createDataFrame([(-1, 10.0, 1.0), (0, 1.0, -1.0), (1, 0.5, 2.0)], "at int, a double, b double")
    got = ln.dot_products(inputs, weights, ["id"], {"a": "of_a", "b": "of_b"}).collect()
    assert {r["id"]: (r["of_a"], r["of_b"]) for r in got} == {1: (3.5, 4.0), 2: (12.5, 11.0)}
    alone = ln.dot_products(inputs, weights.withColumnRenamed("a", "weight"), ["id"]).collect()
    assert {r["id"]: r["dot"] for r in alone} == {1: 3.5, 2: 12.5}
