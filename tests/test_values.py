"""Models recomputed as relations, areas by ranks, ordered indices, boxes, headers and bucketed windows."""

import math
import random

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler, VectorIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from helpers import same_rows
from stationflow.operators import evaluate as ev
from stationflow.operators import linear as ln
from stationflow.operators import prepare as pp
from stationflow.operators import regions as rg
from stationflow.operators import trees as tr
from stationflow.operators.series import Series
from stationflow.plans import queries as q
from stationflow.sources import observations as ob
from stationflow.sources import tables as tb
from stationflow.sources.event_feed import FEED
from stationflow.spec import NUMERIC_FEATURES, OBSERVATION_DDL, SeriesSpec
from test_plans import plan, shuffles

# ---- trees -------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def labelled(spark):
    """Numbers and a category of three values, with labels that depend on both."""
    x = F.pmod(F.xxhash64("id"), F.lit(1000)) / 100
    rows = spark.range(600).select("id", x.alias("x"), (F.col("id") % 3).cast("double").alias("kind"))
    flag = ((F.col("x") > 4) != (F.col("kind") == 1)).cast("double")
    return rows.withColumns({"y": flag, "v": F.col("x") * F.when(F.col("kind") == 2, -1.0).otherwise(2.0)}).cache()


def fitted(labelled, estimator, folder):
    stages = [
        VectorAssembler(inputCols=["x", "kind"], outputCol="raw"),
        VectorIndexer(inputCol="raw", outputCol="features", maxCategories=3),
        estimator(),
    ]
    model = Pipeline(stages=stages).fit(labelled)
    model.write().overwrite().save(folder)
    spark = labelled.sparkSession
    return model.transform(labelled), tr.tree_table(spark, folder, model.stages[-1].uid)


@pytest.mark.parametrize("estimator, how", [
    (lambda: RandomForestClassifier(labelCol="y", numTrees=7, maxDepth=4, seed=1), "votes"),
    (lambda: RandomForestRegressor(labelCol="v", numTrees=5, maxDepth=5, seed=1), "means"),
], ids=["classifier", "regressor"])
def test_walked_forests_predict_like_the_model(labelled, tmp_path, estimator, how):
    scored, trees = fitted(labelled, estimator, str(tmp_path / "m"))
    assert trees.where("categories is not null").count() > 0 and trees.where("cut is not null").count() > 0
    ends = tr.walked(scored.select("id", "features"), trees, 5)
    said = tr.forest_votes(ends, ["id"]) if how == "votes" else tr.forest_means(ends, ["id"])
    both = scored.select("id", "prediction").join(said, "id")
    assert both.count() == 600 and both.where("abs(prediction - walked) > 1e-9").isEmpty()


@pytest.mark.parametrize("estimator, label, loss", [
    (lambda: GBTClassifier(labelCol="y", maxIter=6, maxDepth=3, seed=1), "y", tr.log_loss),
    (lambda: GBTRegressor(labelCol="v", maxIter=6, maxDepth=3, seed=1), "v", tr.squared_loss),
], ids=["classifier", "regressor"])
def test_staged_losses_fall_and_end_at_the_prediction(labelled, tmp_path, estimator, label, loss):
    scored, trees = fitted(labelled, estimator, str(tmp_path / "m"))
    margins = tr.staged_margins(tr.walked(scored.select("id", label, "features"), trees, 3), ["id"])
    rows = sorted(map(tuple, tr.staged_loss(margins, loss(F.col(label), F.col("margin"))).collect()))
    assert [r[0] for r in rows] == list(range(6)) and {r[1] for r in rows} == {600}
    assert all(b[2] <= a[2] for a, b in zip(rows, rows[1:]))
    last = margins.where("tree = 5").select("id", "margin").join(scored, "id")
    said = F.when(F.col("margin") > 0, 1.0).otherwise(0.0) if label == "y" else F.col("margin")
    assert last.where(F.abs(said - F.col("prediction")) > 1e-9).isEmpty()


def test_log_loss_does_not_overflow(spark):
    rows = spark.createDataFrame([(1.0, -1e6), (0.0, -1e6), (1.0, 0.0)], "y double, m double")
    got = [r[0] for r in rows.select(tr.log_loss(F.col("y"), F.col("m"))).collect()]
    assert got == pytest.approx([4e6, 0.0, 2 * math.log(2)])


# ---- linear models -----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def prepared(spark):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        numbers = [rng.gauss(k, 1 + k) for k in range(len(NUMERIC_FEATURES))]
        numbers[6] = 5.0  # does not vary
        rows.append((i, f"S{min(rng.randrange(6), 4)}", *numbers, float(numbers[0] + rng.gauss(0, 1) > 0)))
    columns = ", ".join(f"{n} double" for n in NUMERIC_FEATURES)
    df = spark.createDataFrame(rows, f"id long, StationID string, {columns}, y double").cache()
    return df, pp.fit_base(df, SeriesSpec())


def test_sparse_inputs_are_the_vector(prepared):
    df, base = prepared
    odd = df.limit(3).withColumn("StationID", F.lit("unseen"))
    rows = df.unionByName(odd.withColumn("id", F.col("id") + 1000))
    dense = base.transform(rows).select("id", F.posexplode(vector_to_array("features")).alias("at", "x")).where("x <> 0")
    sparse = ln.sparse_inputs(rows, base, SeriesSpec(), ["id"])
    assert sparse.where(F.col("at") == ln.INTERCEPT).count() == rows.count()
    both = dense.join(sparse.where("at >= 0").withColumnRenamed("x", "z"), ["id", "at"], "full")
    assert both.where("x is null or z is null or abs(x - z) > 1e-9").isEmpty()


def test_rows_with_missing_inputs_have_no_sparse_form(prepared):
    df, base = prepared
    holes = df.withColumn("Pressure", F.when(F.col("id") < 5, None).when(F.col("id") < 7, float("nan")).otherwise(F.col("Pressure")))
    kept = {r["id"] for r in ln.sparse_inputs(holes, base, SeriesSpec(), ["id"]).select("id").distinct().collect()}
    assert kept == set(range(7, 300))


def test_gradient_is_that_of_the_loss(prepared):
    """Against the formula in numpy, away from the optimum, and zero at the optimum."""
    df, base = prepared
    vectors = base.transform(df)
    model = LogisticRegression(labelCol="y", regParam=0.05, maxIter=200, tol=1e-10).fit(vectors)
    inputs = ln.sparse_inputs(df, base, SeriesSpec(), ["id"])
    weights = ln.coefficients(model, df)
    slopes = ln.logistic_gradient(inputs, df, weights, ["id"], "y", 0.05)
    assert max(abs(r["gradient"]) for r in slopes.collect()) < 1e-5
    x = np.array([r[0] for r in vectors.orderBy("id").select(vector_to_array("features")).collect()])
    y = np.array([r[0] for r in df.orderBy("id").select("y").collect()])
    w = np.linspace(-0.3, 0.3, x.shape[1])
    moved = df.sparkSession.createDataFrame([(-1, 0.1), *enumerate(map(float, w))], "at int, weight double")
    got = {r["at"]: r["gradient"] for r in ln.logistic_gradient(inputs, df, moved, ["id"], "y", 0.05).collect()}
    s = x.std(axis=0, ddof=1)
    error = 1 / (1 + np.exp(-(x @ w + 0.1))) - y
    want = np.where(s > 1e-9, error @ x / len(y) / np.where(s > 0, s, 1) + 0.05 * w * s, 0)
    assert got[-1] == pytest.approx(error.mean()) and [got[k] for k in range(len(w))] == pytest.approx(list(want))


# ---- areas -------------------------------------------------------------------------------------------------


def pairs_won(rows):
    ones, noes = [s for y, s in rows if y == 1], [s for y, s in rows if y == 0]
    if not ones or not noes:
        return None
    return sum((a > b) + (a == b) / 2 for a in ones for b in noes) / (len(ones) * len(noes))


@pytest.mark.parametrize("width", [1, 5])
def test_areas_of_groups_equal_all_pairs(spark, width):
    rng = random.Random(width)
    rows = [(rng.choice(["a", "b", None]), float(rng.random() < 0.4), float(rng.randrange(6))) for _ in range(300)]
    rows += [("one", 1.0, 0.5), ("one", 1.0, 0.7), ("none", 0.0, 0.1), ("a", 1.0, None), ("b", None, 3.0)]
    df = spark.createDataFrame(rows, "g string, label_clf double, s double")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", width)
    try:
        got = {r["g"]: r for r in ev.areas_under_roc(df, ["g"], score="s").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert set(got) == {"a", "b", None, "one", "none"}
    for g, row in got.items():
        of = [(y, s) for h, y, s in rows if h == g and s is not None and y is not None]
        assert row["AUC-ROC"] == (None if pairs_won(of) is None else pytest.approx(pairs_won(of)))
        assert (row["positives"], row["negatives"]) == (sum(y == 1 for y, _ in of), sum(y == 0 for y, _ in of))


def test_area_agrees_with_the_evaluator_and_takes_vectors(labelled):
    vectors = VectorAssembler(inputCols=["x"], outputCol="features").transform(labelled)
    scored = DecisionTreeClassifier(labelCol="y", maxDepth=3).fit(vectors).transform(vectors)
    exact = ev.area_under_roc(scored, "y")
    assert exact == pytest.approx(ev.area_under_roc(scored, "y", bins=0))


def test_area_of_one_class_and_of_nothing_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.3, 1.0)], "label_clf double, rawPrediction double, prediction double")
    assert ev.area_under_roc(df) is None and ev.area_under_roc(df.limit(0)) is None
    values = {r["metric"]: r["value"] for r in ev.evaluate_classification(df).collect()}
    assert values["AUC-ROC"] is None and values["Accuracy"] == 1.0


@pytest.mark.parametrize("task", ["classification", "regression"])
def test_grouped_metrics_equal_those_of_each_model(spark, task):
    rng = random.Random(7)
    said = (lambda: float(rng.random() < 0.3)) if task == "classification" else (lambda: rng.gauss(0, 2))
    rows = [(m, said(), said(), rng.random()) for m in ("one", "two") for _ in range(80)]
    rows += [("never", float(i % 2), 0.0, 0.0) for i in range(10)]
    df = spark.createDataFrame(rows, "model string, label double, prediction double, score double")
    got = {(r["model"], r["metric"]): r["value"] for r in ev.grouped_metrics(df, task).collect()}
    for name in ("one", "two", "never"):
        part = df.where(F.col("model") == name)
        want = ev.evaluate_classification(part, "label", "score") if task == "classification" else ev.evaluate_regression(part, "label")
        for r in want.collect():
            assert got[name, r["metric"]] == pytest.approx(r["value"])


# ---- index -------------------------------------------------------------------------------------------------


def test_index_equals_the_indexer(spark):
    rng = random.Random(8)
    names = [rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randrange(1, 4) for _ in range(400)] + [None, "Z", "é"]
    rows = spark.createDataFrame([(n,) for n in names], "k string").repartition(7)
    index = pp.label_index(rows, "k")
    known = rows.dropna()
    want = StringIndexer(inputCol="k", outputCol="i").fit(known).transform(known.distinct())
    assert same_rows(index.select("k", F.col("idx").cast("long").alias("i")), want.select("k", F.col("i").cast("long").alias("i")))
    odd = spark.createDataFrame([("Z",), ("new",), (None,)], "k string")
    got = {r["k"]: r["i"] for r in pp.with_label_index(odd, index, "k", "i").collect()}
    size = index.count()
    assert got["new"] == got[None] == size and got["Z"] < size
    assert pp.label_index(rows.limit(0), "k").collect() == []


# ---- boxes -------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("degrees", [0.5, 7.0])
def test_boxes_equal_all_pairs(spark, degrees):
    rng = random.Random(9)
    points = [(i, rng.choice([rng.uniform(-90, 90), float(rng.randrange(-9, 9))]), rng.uniform(-180, 180)) for i in range(200)]
    points += [(500, None, 1.0), (501, 0.0, 0.0), (502, -90.0, 180.0)]
    boxes = [(0, -90.0, 90.0, -180.0, 180.0), (1, 0.0, 0.0, 0.0, 0.0), (2, 5.0, 4.0, 0.0, 9.0), (3, None, 1.0, 1.0, 2.0)]
    for b in range(4, 60):
        south, west, size = rng.uniform(-90, 80), rng.uniform(-180, 170), 10 ** rng.uniform(-2, 2)
        boxes.append((b, south, south + size * rng.random(), west, west + size * rng.random()))
    p = spark.createDataFrame(points, "id long, latitude double, longitude double")
    b = spark.createDataFrame(boxes, "box long, south double, north double, west double, east double")
    got = sorted((r["id"], r["box"]) for r in rg.in_boxes(p, b, degrees).collect())
    want = sorted(
        (i, box) for i, y, x in points for box, s, n, w, e in boxes if None not in (y, s) and s <= y <= n and w <= x <= e
    )
    assert got == want
    assert rg.in_boxes(p, b.limit(0)).collect() == [] and rg.in_boxes(p.limit(0), b).collect() == []


def test_narrow_boxes_meet_few_points(spark):
    """A long and narrow box is compared with the points along it, not with those of a square as wide as it is long."""
    p = spark.range(3600).selectExpr("id", "cast(id div 60 as double) as latitude", "cast(id % 60 as double) as longitude")
    b = spark.createDataFrame([(0, 8.0, 8.0, 0.0, 59.0), (1, 0.0, 59.0, 8.0, 8.0)], "box long, south double, north double, west double, east double")
    sides = []
    plain = rg.broadcast_if_small
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(rg, "broadcast_if_small", lambda entered: sides.append(entered) or plain(entered))
        met = rg.in_boxes(p, b)
    assert met.groupBy("box").count().orderBy("box").collect() == [(0, 60), (1, 60)]
    # The area of all cells entered, in points: 64 by 1 for each box; square cells would take 64 by 64.
    assert sides[0].selectExpr("sum(power(2, _high + _wide)) as area").first()["area"] <= 2 * 64


def test_box_join_deals_few_points_to_many_tasks(spark):
    p = spark.range(0, 50, 1, 1).selectExpr("id", "cast(id as double) as latitude", "cast(id as double) as longitude")
    b = spark.createDataFrame([(0, 0.0, 90.0, 0.0, 90.0)], "box long, south double, north double, west double, east double")
    assert rg.in_boxes(p, b).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def _dealt(monkeypatch, **settings):
    """Boxes count as too many to send to every task."""
    monkeypatch.setattr(rg, "broadcast_if_small", lambda entered: entered)
    for name, value in settings.items():
        monkeypatch.setattr(rg, name, value)


@pytest.mark.parametrize("degrees, levels, most", [(0.5, 1, 10), (0.3, 3, 1000), (7.0, 8, 1000), (1.0, 8, 7)])
def test_dealt_boxes_equal_all_pairs(spark, monkeypatch, degrees, levels, most):
    _dealt(monkeypatch, TILE_LEVELS=levels, BOXES_A_TASK=most)
    test_boxes_equal_all_pairs(spark, degrees)


def test_dealt_boxes_keep_every_column(spark, monkeypatch):
    p = spark.createDataFrame([("a", 1, 2, {"k": 1}), ("a", 1, 2, {"k": 1}), (None, 9, 9, None)], "name string, latitude int, longitude int, m map<string, int>")
    b = spark.createDataFrame([(0, 5, 0, 5, "x", [1, None]), (1, 1, 2, 2, None, None)], "south int, north int, west int, east int, `a.note on it` string, list array<int>")
    want = rg.in_boxes(p, b)
    _dealt(monkeypatch)
    got = rg.in_boxes(p, b)
    assert got.schema.simpleString() == want.schema.simpleString()
    order = lambda rows: sorted(map(repr, rows))
    assert order(got.collect()) == order(want.collect()) and got.count() == 4
    bare = rg.in_boxes(p, b.select("south", "north", "west", "east"))
    assert bare.columns == p.columns and bare.count() == 4


def test_one_place_is_dealt_to_many_tasks(spark, monkeypatch):
    """Points and boxes of one place would be one task, with pairs that do not go through memory at once."""
    _dealt(monkeypatch, BOXES_A_TASK=100)
    p = spark.range(1500).selectExpr("id", "0.5D as latitude", "0.5D as longitude")
    b = spark.range(400).selectExpr("id as box", "0.0D as south", "1.0D as north", "0.0D as west", "1.0D as east")
    met = rg.in_boxes(p, b)
    assert met.distinct().count() == met.count() == 1500 * 400
    assert met.select(F.spark_partition_id()).distinct().count() >= 4


def test_points_are_not_shuffled_once_a_grid(spark, small, monkeypatch):
    _dealt(monkeypatch)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        met = q.QUERIES["b13_region_table"](spark, "/root/testdata/sf0.01")
        met._jdf.collectToPython()
        nodes, records = [met._jdf.queryExecution().executedPlan()], 0
        while nodes:
            node = nodes.pop()
            nodes += [node.children().apply(i) for i in range(node.children().size())]
            if "ShuffleExchange" in node.getClass().getName():
                records += node.metrics().get("shuffleRecordsWritten").get().value()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    # 1,500 points in 28 grids would be 42,000 rows.
    assert 1500 < records < 3 * (1500 + 1500)


def test_box_join_has_no_nested_loop(spark, small):
    text = plan(q.QUERIES["b13_region_table"](spark, small))
    assert "NestedLoop" not in text and "Cartesian" not in text and "HashJoin" in text


# ---- headers -----------------------------------------------------------------------------------------------


def test_files_with_odd_headers(spark, tmp_path):
    (tmp_path / "A b.csv").write_text('MASK,"DATE" ,TMP\n[1 1 1 1 1],2014-01-01 00:00:00,1.5\n')
    (tmp_path / "B.csv").write_text("DATE,NOTE,DEW\n2014-01-01 00:00:00,hi,2.5\n2014-01-01 01:00:00,,\n")
    (tmp_path / "C.csv").write_text("")
    (tmp_path / "D.csv").write_text("DATE,DEW,NOTE\n")
    (tmp_path / "E.txt").write_text("DATE\nx\n")
    rows = {(r["StationID"], r["DATE"]): r for r in ob.read_mixed_observations(spark, str(tmp_path)).collect()}
    assert set(rows) == {("A b", "2014-01-01 00:00:00"), ("B", "2014-01-01 00:00:00"), ("B", "2014-01-01 01:00:00")}
    a, b = rows["A b", "2014-01-01 00:00:00"], rows["B", "2014-01-01 00:00:00"]
    assert (a["TMP"], a["DEW"], a["MASK"], a["SLP"]) == (1.5, None, "[1 1 1 1 1]", None)
    assert (b["TMP"], b["DEW"], rows["B", "2014-01-01 01:00:00"]["DEW"]) == (None, 2.5, None)


def test_headers_that_cannot_be_read(spark, tmp_path):
    (tmp_path / "A.csv").write_text("DATE,TMP,TMP\nx,1,2\n")
    with pytest.raises(ValueError):
        ob.read_mixed_observations(spark, str(tmp_path))
    (tmp_path / "A.csv").write_text("")
    with pytest.raises(ValueError):
        ob.read_mixed_observations(spark, str(tmp_path))


ODD_FILES = {
    "A.csv": "DATE,TMP,MASK\r\n2014-01-01,1.5,[1 1]\r\n\r\n2014-01-02,x,\r\n  \r\n2014-01-03,2,a,b,c\r\n",
    "B b+.csv": 'MASK,"TMP",NOTE,DATE\n"q ""r"", s",NaN,,\n,,\n-,1e3,"open\n' + "".join(f"m{i},{i}.25,n,2014-02-{i:02d}\n" for i in range(1, 29)),
    "C.csv": "\nDATE,TMP\n2014-01-01,1\n",
    "D.csv": "\ufeffDATE,TMP\n2014-01-01,7\n",
    "E.csv": "TMP,DATE" + "\n5,2014-03-01" * 40,
    "F.csv": "DATE,TMP\n",
    "G.csv": "",
    "H.csv": "DATE , TMP\n" + "2014-04-01, 3 \n" * 3,
}


@pytest.mark.parametrize("split", ["32b", "128b", "1m"])
def test_mixed_files_equal_a_read_of_each_file(spark, tmp_path, split):
    """Whatever the files hold and wherever they are cut."""
    types = dict(f.split() for f in OBSERVATION_DDL.split(", "))
    want = []
    for name, text in ODD_FILES.items():
        (tmp_path / name).write_bytes(text.encode())
        names = [n.strip().strip('"').strip() for n in text.removeprefix("\ufeff").split("\n")[0].split(",")]
        schema = ", ".join(f"{n} {types[n]}" if n in types else f"`o{i}` string" for i, n in enumerate(names))
        rows = spark.read.schema(schema).option("header", True).csv(str(tmp_path / name))
        want += [(name.removesuffix(".csv"), *[str(r[c]) if c in names else "None" for c in types]) for r in rows.collect()]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        read = ob.read_mixed_observations(spark, str(tmp_path))
        got = [(r["StationID"], *[str(r[c]) for c in types]) for r in read.collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(got) == sorted(want) and len(got) == 79


def test_mixed_headers_take_one_scan_of_few_tasks(spark, tmp_path):
    """Neither the list of the files nor the tasks of their scan come once more for each header."""
    for i in range(600):
        (tmp_path / f"{i}.csv").write_text(("DATE,TMP\nx,1\n", "TMP,DATE\n1,x\n", "DATE,DEW,NOTE\nx,2,3\n")[i % 3])
    rows = ob.read_mixed_observations(spark, str(tmp_path))
    text = plan(rows)
    assert text.count("FileScan") == 1 and "(1 paths)" in text
    assert rows.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
    assert rows.count() == 600 and rows.where("TMP = 1").count() == 400 and rows.where("DEW = 2").count() == 200


def test_usual_headers_give_the_usual_rows(spark, tmp_path):
    columns = [f.split()[0] for f in OBSERVATION_DDL.split(", ")]
    line = "2014-01-01 00:00:00,1.0,2.0,3.0,4.0,5.0,6.0,7.0,[1 1 1 1 1],"
    (tmp_path / "A.csv").write_text(",".join(columns) + "\n" + line + "\n")
    assert same_rows(ob.read_mixed_observations(spark, str(tmp_path)), ob.read_observations(spark, str(tmp_path)))


# ---- buckets -----------------------------------------------------------------------------------------------


def test_bucketed_windows_do_not_shuffle(spark, small):
    filled = q.fj.preprocessed_series(q.bucketed_rows(spark, small), FEED, laid_out=True)
    text = plan(q.ft.with_history(filled).frame())
    assert shuffles(text) == 0 and text.count("Window [") == 2


@pytest.mark.parametrize("buckets", [1, 4])
def test_bucketed_rows_in_blocks_give_the_same(spark, small, tmp_path, buckets):
    rows = q.clean_rows(spark, small)
    table = tb.save_bucketed(rows, f"t_{buckets}_{random.getrandbits(40)}", str(tmp_path / "t"), "StationID", ("datetime", "event_id"), buckets)
    assert same_rows(table, rows)
    want = q.fj.feature_rows(rows, FEED)
    assert same_rows(q.fj.feature_rows(table, FEED, laid_out=True), want)
    assert same_rows(q.fj.feature_rows(table, FEED, laid_out=True, max_rows=40), want)


def test_series_counts_a_laid_out_table_too(spark, small):
    series = Series.of(q.bucketed_rows(spark, small), q.FEED_BY_TEXT, laid_out=True)
    assert series.counted == q.clean_rows(spark, small).count() and series.long is None
