"""Tree ensembles and vector sums over a wide one-hot entity, and station files written by the tasks."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from stationflow.operators import ensembles as en
from stationflow.operators import models as md
from stationflow.operators import prepare as pp
from stationflow.operators import trees as tr
from stationflow.plans import queries as q
from stationflow.sources import event_feed as feed
from stationflow.spec import ModelSettings

TINY = ModelSettings(forest_trees=4, forest_depth=3, boost_iterations=2, boost_depth=3)


def rows_of(spark, width, entities, count=1200):
    """Two numeric inputs, then a one-hot entity among ``width`` positions; a fifth of the rows is of the first one."""

    def vector(i):
        entity = 0 if i % 5 == 0 else (i * 7919) % entities
        numbers = [i * 31 % 97 / 10.0, (i * 17 % 89 - 40) / 8.0]
        return Vectors.sparse(width, [0, 1, 2 + entity], [*numbers, 2.0]), numbers, entity

    found = []
    for i in range(count):
        v, (a, b), entity = vector(i)
        value = 3 * a - b * b + (25 if entity == 0 else entity % 3) + i * 7 % 11 / 100
        found.append((i, v, value, float(value > 10)))
    return spark.createDataFrame(found, ["id", "features", "label_reg", "label_clf"]).repartition(3).cache()


@pytest.mark.parametrize("task", ["reg", "clf"])
def test_boosting_makes_the_trees_of_spark(spark, task):
    rows = rows_of(spark, 22, 20)
    estimator = md.estimator(task, "gbt", TINY)
    one, two = en.fit(rows, estimator, task, "gbt", 2), estimator.fit(rows)
    assert one.treeWeights == two.treeWeights and one.numFeatures == two.numFeatures
    splits, values = [[], []], [[], []]
    for at, model in enumerate((one, two)):
        for tree in model.trees:
            for line in tree.toDebugString.split("\n")[1:]:
                if "Predict" in line:
                    values[at].append(float(line.split()[-1]))
                else:
                    splits[at].append(line)
    # Sums are added up in another order.
    assert splits[0] == splits[1] and values[0] == pytest.approx(values[1], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("task, most", [("reg", 7), ("clf", 8)])
def test_a_level_is_one_pass(spark, monkeypatch, task, most):
    """Stages of two boosted trees of three levels: they took two a level, and one a tree for its totals."""
    rows, context, stages = rows_of(spark, 22, 20), spark.sparkContext, []
    inner, group = en._boosted, f"grown-{task}"

    def counted(*args):
        context.setJobGroup(group, group)
        try:
            return inner(*args)
        finally:
            context.setJobGroup("other", "other")
            tracker = context.statusTracker()
            for job in tracker.getJobIdsForGroup(group):
                ran = [tracker.getStageInfo(at) for at in tracker.getJobInfo(job).stageIds]
                stages.extend(s.stageId for s in ran if s and s.numCompletedTasks)

    monkeypatch.setattr(en, "_boosted", counted)
    en.fit(rows, md.estimator(task, "gbt", TINY), task, "gbt", 2)
    assert 0 < len(stages) <= most


def test_gains_are_taken_of_the_entities_a_node_holds(monkeypatch):
    """Gains per (node, entity) with rows, not of all entities of a block at every node; the best one as by a plain loop."""
    entities, count = 5_000, 300
    names = np.arange(2, 2 + entities, dtype=np.int32)
    own = (np.arange(count) * 7 % 40 * 100).astype(np.int32)
    label = np.arange(count) % 13 + own / 1_000
    block = {"bins": (np.arange(2 * count).reshape(2, count) % 5).astype(np.uint8), "hot": names[own], "own": own}
    block |= {"spread": np.zeros(count, np.int16), "names": names, "scales": np.full(entities, 2.0)}
    tree = en.Tree(2, en._totals(label))
    tree.feature[0], tree.cut[0] = 1, 2
    right = block["bins"][1] > 2
    tree.stats[1], tree.stats[2] = en._totals(label[~right]), en._totals(label[right])
    sizes, inner = [], en._gains
    monkeypatch.setattr(en, "_gains", lambda sums, total: sizes.append(len(sums.reshape(-1, 3))) or inner(sums, total))
    inputs = en.Inputs([np.arange(4.0)] * 2, 2 + entities, 5, [])
    best = en._statistics(block, inputs, tree, 0, 1, inputs.width, 1, None, label)[2]
    assert max(sizes) <= count
    for node, rows in enumerate((~right, right)):
        gains = {e: float(inner(en._totals(label[rows & (own == e)]), tree.stats[1 + node])) for e in sorted({*own[rows]})}
        top = max(gains, key=gains.get)
        assert best[node] == pytest.approx([gains[top], names[top], 1.0, *en._totals(label[rows & (own == top)])])


def test_slopes_left_over_by_a_tree():
    y, side = np.array([1.0, 2.0, 4.0, 8.0, 8.5]), np.array([1, 1, 2, 2, 2])
    tree = en.Tree(1, en._totals(y))
    tree.feature[0] = 0
    for node in (1, 2):
        tree.stats[node] = en._totals(y[side == node])
    left = 2.0 * y - 0.2 * tree.values()[side]
    assert en._left_over(tree, 2.0, 0.2) == pytest.approx(en._totals(left))


@pytest.mark.parametrize("task, name", [("reg", "rf"), ("clf", "rf"), ("reg", "gbt"), ("clf", "gbt")])
def test_entities_do_not_widen_rows(spark, tmp_path, task, name):
    """2 million positions: dense rows of bins or values would be 10 and 20 GB."""
    rows = rows_of(spark, 2_000_000, 1_500_000)
    model = en.fit(rows, md.estimator(task, name, TINY), task, name, 2)
    label = md.TASK_LABEL[task]
    scored = model.transform(rows).select("id", "features", label, "prediction")
    missed = scored.agg(F.avg((F.col("prediction") - F.col(label)) ** 2), F.var_pop(label)).first()
    assert model.numFeatures == 2_000_000 and missed[0] < missed[1] or name == "rf"
    model.write().save(f"{tmp_path}/stages/4_{model.uid}")
    trees = tr.tree_table(spark, str(tmp_path), model.uid)
    ends = tr.walked(scored.select("id", "features"), trees, 3)
    assert ends.groupBy("id").count().where(f"count = {len(model.treeWeights)}").count() == 1200
    if (task, name) == ("reg", "rf"):
        both = scored.join(tr.forest_means(ends, ["id"]), "id")
        assert both.where("abs(prediction - walked) < 1e-9").count() == 1200


NODES = (
    "tree int, node int, left int, right int, feature int, cut double, categories array<double>, prediction double, "
    "stats array<double>, weight double"
)


def test_rounds_of_a_walk_are_no_single_method(spark):
    """Nine joins in one generated method are more than the JVM compiles: a step took some 50 microseconds."""
    rows = spark.createDataFrame([(1, Vectors.dense([1.0]))], ["id", "features"])
    trees = spark.createDataFrame([(0, 0, -1, -1, -1, None, None, 2.0, [1.0], 1.0)], NODES)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        ends = tr.walked(rows, trees, 8)
        text = ends._jdf.queryExecution().executedPlan().toString()
        assert [tuple(r) for r in ends.collect()] == [(0, 1, 2.0, [1.0], 1.0)]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    together = Counter(re.findall(r"\*\((\d+)\) BroadcastHashJoin", text))
    assert text.count("BroadcastHashJoin") == 9 and max(together.values(), default=0) <= 2


def test_rows_times_trees_are_not_shuffled(spark):
    """Running sums over the trees of a row take the deal of the rows, before they are walked."""
    rows = spark.createDataFrame([(1, 2.0, Vectors.dense([1.0]))], ["id", "label", "features"])
    trees = spark.createDataFrame([(0, 0, -1, -1, -1, None, None, 2.0, [1.0], 1.0)], NODES)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for grouped in (lambda ends: tr.staged_margins(ends, ["id"]), lambda ends: tr.forest_means(ends, ["id"])):
            text = grouped(tr.walked(rows, trees, 3, keys=["id"]))._jdf.queryExecution().executedPlan().toString()
            assert len(re.findall("Exchange (?:hash|RoundRobin)", text)) == 1
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_walks_read_near_and_far_positions(spark):
    """Positions before and beyond those that are held as an array, in sparse and dense vectors, held or zero."""
    first, far = tr.HEAD - 1, tr.HEAD + 7
    held = [{}, {first: 1.0}, {far: 1.0}, {first: 1.0, far: 1.0}, {first: float("nan"), far: 1.0}]
    width = tr.HEAD + 20
    vectors = [Vectors.sparse(width, v) for v in held] + [Vectors.dense(Vectors.sparse(width, v).toArray()) for v in held]
    rows = spark.createDataFrame(list(enumerate(vectors)), ["id", "features"])
    leaf = (-1, -1, -1, None, None)
    trees = spark.createDataFrame(
        [
            (3, 0, 1, 2, first, 0.5, None, 0.0, [1.0], 1.0),
            (3, 1, 3, 4, far, None, [0.0, 2.0], 0.0, [1.0], 1.0),
            (3, 2, *leaf, 9.0, [1.0], 1.0),
            (3, 3, *leaf, 7.0, [1.0], 1.0),
            (3, 4, *leaf, 8.0, [1.0], 1.0),
        ],
        NODES,
    )
    ends = tr.walked(rows, trees, 2, keys=["id"])
    said = [r["prediction"] for r in ends.orderBy("id").collect()]
    assert said == 2 * [7.0, 9.0, 8.0, 9.0, 9.0]


def test_values_and_entries_of_vectors(spark):
    vectors = [Vectors.sparse(50_000_000, [1, 40_000_000], [2.0, 3.0]), Vectors.dense([0.0, 5.0, 6.0])]
    rows = spark.createDataFrame([(v,) for v in vectors], ["v"])
    found = rows.select(pp.vector_width("v"), pp.vector_value("v", F.lit(1)), pp.vector_value("v", F.lit(2)), pp.vector_entries("v"))
    assert [tuple(r[:3]) for r in found.collect()] == [(50_000_000, 2.0, 0.0), (3, 5.0, 6.0)]
    assert [[tuple(e) for e in r[3]] for r in found.collect()] == [[(1, 2.0), (40_000_000, 3.0)], [(0, 0.0), (1, 5.0), (2, 6.0)]]


def test_station_files_are_written_by_tasks(spark, small, monkeypatch):
    """One whole file a station under its last name, and none besides: no partition folders, no renaming."""
    monkeypatch.setattr(feed, "_written", {})
    folder = feed.write_observation_files(spark, small)
    files = {r["path"].rsplit("/", 1)[1]: r["value"].split("\n") for r in spark.read.text(folder, wholetext=True).select("_metadata.file_path", "value").toDF("path", "value").collect()}
    sizes = {r["StationID"]: r["count"] for r in feed.observations(spark, small).groupBy("StationID").count().collect()}
    assert {name.removesuffix(".csv"): len(lines) - 2 for name, lines in files.items()} == sizes
    assert all(lines[0].startswith("DATE,") for lines in files.values())
    assert not [p for p in __import__("pathlib").Path(folder.removeprefix("file:")).parent.rglob("*") if "part" in p.name]


def test_pieces_of_files_share_tasks(spark, monkeypatch):
    tasks = []
    monkeypatch.setattr(q, "stage", lambda df, label: tasks.append(df.rdd.getNumPartitions()) or df)
    q.h06_csv_split(spark, "/root/testdata/sf0.01")
    assert max(tasks) <= q.FILE_TASKS * spark.sparkContext.defaultParallelism + 8 and tasks[1] > 8
    assert spark.conf.get("spark.sql.files.maxPartitionNum", None) is None
