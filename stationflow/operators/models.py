"""The six estimators, fitted over one shared preparation and kept in the model store."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame

from stationflow.operators import ensembles
from stationflow.operators.prepare import base_preparation, fit_base
from stationflow.sources.models import fingerprint, load_model, model_path, save_model
from stationflow.spec import CLF_LABEL, NUMERIC_FEATURES, REG_LABEL, ModelSettings, SeriesSpec
from stationflow.storage import stage

CLASSIFIERS = ("lr", "rf", "gbt")
REGRESSORS = ("linear", "rf", "gbt")
TASK_LABEL = {"clf": CLF_LABEL, "reg": REG_LABEL}
SLOWEST = ("gbt", "rf")


def estimator(task: str, name: str, settings: ModelSettings):
    """An unfitted estimator of a task (``clf`` or ``reg``); unknown names raise ``ValueError``."""
    columns = {"featuresCol": "features", "labelCol": TASK_LABEL[task]}
    linear = {**columns, "maxIter": settings.linear_iterations, "regParam": settings.l2}
    forest = {
        **columns,
        "numTrees": settings.forest_trees,
        "maxDepth": settings.forest_depth,
        "maxBins": settings.forest_bins,
        "subsamplingRate": settings.forest_subsample,
        "seed": settings.seed,
    }
    boost = {
        **columns,
        "maxIter": settings.boost_iterations,
        "maxDepth": settings.boost_depth,
        "seed": settings.seed,
    }
    makers = {
        ("clf", "lr"): lambda: LogisticRegression(**linear),
        ("clf", "rf"): lambda: RandomForestClassifier(**forest),
        ("clf", "gbt"): lambda: GBTClassifier(**boost),
        ("reg", "linear"): lambda: LinearRegression(**linear),
        ("reg", "rf"): lambda: RandomForestRegressor(**forest),
        ("reg", "gbt"): lambda: GBTRegressor(**boost),
    }
    if (task, name) not in makers:
        raise ValueError(f"unknown model {name!r} for task {task!r}")
    return makers[task, name]()


def model_plan(task: str, name: str, spec: SeriesSpec, settings: ModelSettings = ModelSettings()) -> Pipeline:
    """Preparation and estimator as one unfitted pipeline."""
    return Pipeline(stages=[*base_preparation(spec).getStages(), estimator(task, name, settings)])


@dataclass
class Trainer:
    """Loads or fits models on one training frame.

    Index, encoder and scaler do not depend on the model, so they are fitted once, and all estimators read one
    written table of vectors and labels. The estimators cache their own form of the rows while they iterate, so
    keeping the vectors in memory as well would only hold them twice, and a table outlives lost executors.
    """

    train: DataFrame
    spec: SeriesSpec
    store: str
    settings: ModelSettings = ModelSettings()
    _key: str | None = None
    _base: PipelineModel | None = None
    _vectors: DataFrame | None = None
    # Models of this trainer that were fitted or loaded.
    _found: dict[tuple[str, str], PipelineModel] = field(default_factory=dict)
    _making: Lock = field(default_factory=Lock, repr=False, compare=False)

    @property
    def key(self) -> str:
        if self._key is None:
            self._key = fingerprint(self.train, self.settings.as_text())
        return self._key

    def model(self, task: str, name: str) -> PipelineModel:
        """The stored model of these settings and rows, else a fitted and stored one."""
        unfitted = estimator(task, name, self.settings)
        if (task, name) not in self._found:
            path = model_path(self.store, task, name, self.key)
            found = load_model(self.train.sparkSession, path)
            self._found[task, name] = self._fitted(task, name, unfitted, path) if found is None else found
        return self._found[task, name]

    def _fitted(self, task: str, name: str, unfitted, path: str) -> PipelineModel:
        base, vectors = self._prepared()
        if (task, name) in ensembles.MODELS:
            fitted = ensembles.fit(vectors, unfitted, task, name, len(NUMERIC_FEATURES))
        else:
            fitted = unfitted.fit(vectors)
        model = PipelineModel(stages=[*base.stages, fitted])
        save_model(model, path)
        # A fresh linear model drags its training summary into every task that scores with it; ensembles were loaded.
        return model if (task, name) in ensembles.MODELS else load_model(self.train.sparkSession, path)

    def models(self, wanted: Sequence[tuple[str, str]]) -> dict[tuple[str, str], PipelineModel]:
        """Several models, fitted side by side as the searches of Spark ML do with their candidates.

        A fit is many short jobs with work of the driver between them, so one alone leaves most cores idle.
        """
        # The key is one pass over the rows, for all of them. Those with most jobs after another begin first.
        spark, _ = self.train.sparkSession, self.key
        order = sorted(wanted, key=lambda one: SLOWEST.index(one[1]) if one[1] in SLOWEST else len(SLOWEST))
        with ThreadPoolExecutor(max(len(order), 1)) as pool:
            found = {one: pool.submit(inheritable_thread_target(spark)(self.model), *one) for one in order}
            return {one: found[one].result() for one in wanted}

    def _prepared(self) -> tuple[PipelineModel, DataFrame]:
        with self._making:
            if self._base is None:
                base = fit_base(self.train, self.spec)
                labels = [c for c in TASK_LABEL.values() if c in self.train.columns]
                self._vectors = stage(base.transform(self.train).select("features", *labels), "vectors")
                self._base = base
        return self._base, self._vectors

    def vectors(self) -> DataFrame:
        """The written vectors and labels of the training rows."""
        return self._prepared()[1]


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    return model.transform(rows)
