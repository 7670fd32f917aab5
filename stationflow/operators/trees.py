"""Stored tree ensembles as tables, and their predictions by joins instead of by the fitted object."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationflow.operators.prepare import vector_entries, vector_value, vector_width
from stationflow.storage import broadcast_if_small


def tree_table(spark: SparkSession, path: str, uid: str) -> DataFrame:
    """Nodes of the ensemble ``uid`` in the pipeline stored at ``path``, one row each.

    Columns: tree, node, left, right (negative for a leaf), feature, cut (``x <= cut`` goes left), categories (those
    that go left; null where the input is a number), prediction, stats (class counts, or those of a value), weight.
    """
    folder = f"{path.rstrip('/')}/stages/*_{uid}"
    weights = spark.read.parquet(f"{folder}/treesMetadata").toDF("tree", "about", "weight").drop("about")
    nodes = spark.read.parquet(f"{folder}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    split = F.col("split")
    sides = split["leftCategoriesOrThreshold"]
    return nodes.join(F.broadcast(weights), "tree").select(
        "tree",
        F.col("id").alias("node"),
        F.col("leftChild").alias("left"),
        F.col("rightChild").alias("right"),
        split["featureIndex"].alias("feature"),
        F.when(split["numCategories"] < 0, F.get(sides, F.lit(0))).alias("cut"),
        F.when(split["numCategories"] >= 0, sides).alias("categories"),
        "prediction",
        F.col("impurityStats").alias("stats"),
        "weight",
    )


# Positions of a vector that rows hold as an array while they are walked; the others are looked for.
HEAD = 64


def _head_and_tail(vector: str) -> tuple[Column, Column]:
    """The first ``HEAD`` values of a vector as an array, and (at, x) of what it holds beyond them."""
    head = F.transform(F.sequence(F.lit(0), F.least(F.lit(HEAD), vector_width(vector)) - 1), lambda at: vector_value(vector, at))
    return head, F.filter(vector_entries(vector), lambda held: held["at"] >= HEAD)


def walked(
    rows: DataFrame, trees: DataFrame, depth: int, features: str = "features", keys: list[str] | None = None
) -> DataFrame:
    """Where every row ends in every tree: the columns of ``rows`` but the vector, tree, prediction, stats, weight.

    Each round joins (row, tree, node) with the nodes on (tree, node) and moves to a child; leaves stay. The node
    table has at most trees * 2 ** (depth + 1) rows, so it is broadcast and the rounds follow each other in one stage.
    A missing input (NaN) goes right, as it is not ``<= cut``. Rows are dealt by ``keys`` if given, so that what is
    grouped by them afterwards stays where it is, in all trees.
    """
    kept = [c for c in rows.columns if c != features]
    nodes = broadcast_if_small(trees)
    step = nodes.select("tree", "node", "left", "right", "feature", "cut", "categories")
    starts = trees.where("node = 0").agg(F.sort_array(F.collect_list("tree")).alias("trees"))
    # A row is walked in every tree, so few bytes are much work: they are dealt over more tasks than a scan of them has.
    spark = rows.sparkSession
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # The vector is opened once a row, not in every tree and round. A dense one would be as wide as there are entities.
    head, tail = _head_and_tail(features)
    now = rows.repartition(tasks, *(keys or [])).select(*kept, head.alias("_head"), tail.alias("_tail"))
    now = now.join(F.broadcast(starts))
    now = now.select(*kept, "_head", "_tail", F.explode("trees").alias("tree"), F.lit(0).alias("node"))
    # A lambda ends Spark's generated code. Without one in each round, all rounds are one method, and the JVM does
    # not compile methods of that length.
    far = F.aggregate("_tail", F.lit(0.0), lambda x, held: F.when(held["at"] == F.col("feature"), held["x"]).otherwise(x))
    value = F.when(F.col("feature") < HEAD, F.get("_head", F.col("feature"))).otherwise(far)
    goes_left = F.when(F.col("categories").isNull(), value <= F.col("cut")).otherwise(
        F.array_contains("categories", value)
    )
    child = F.when(F.col("left") < 0, F.col("node")).when(goes_left, F.col("left")).otherwise(F.col("right"))
    for _ in range(depth):
        now = now.join(step, ["tree", "node"]).select(*kept, "_head", "_tail", "tree", child.alias("node"))
    leaves = nodes.select("tree", "node", "prediction", "stats", "weight")
    return now.drop("_head", "_tail").join(leaves, ["tree", "node"]).drop("node")


def forest_votes(ends: DataFrame, keys: list[str], classes: int = 2) -> DataFrame:
    """(keys, walked): the class with most votes; a tree gives each class its share of the leaf. Ties: smallest."""
    total = F.aggregate("stats", F.lit(0.0), lambda s, x: s + x)
    shares = [F.sum(F.try_divide(F.get("stats", F.lit(c)), total)).alias(f"v{c}") for c in range(classes)]
    votes = ends.groupBy(*keys).agg(*shares)
    most = F.greatest(*[F.col(f"v{c}") for c in range(classes)])
    said = F.lit(None)
    for c in reversed(range(classes)):
        said = F.when(F.col(f"v{c}") == most, F.lit(float(c))).otherwise(said)
    return votes.select(*keys, said.alias("walked"))


def forest_means(ends: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, walked): the mean of the trees' values."""
    return ends.groupBy(*keys).agg(F.avg("prediction").alias("walked"))


def staged_margins(ends: DataFrame, keys: list[str]) -> DataFrame:
    """``ends`` with ``margin``: what the trees up to and with this one add up to."""
    upto = Window.partitionBy(*keys).orderBy("tree").rowsBetween(Window.unboundedPreceding, 0)
    return ends.withColumn("margin", F.sum(F.col("weight") * F.col("prediction")).over(upto))


def log_loss(label: Column, margin: Column) -> Column:
    """Loss of boosted classifiers: labels 0 and 1, margins on the scale of half log odds."""
    turned = F.when(label > 0, -2 * margin).otherwise(2 * margin)
    return 2 * (F.greatest(turned, F.lit(0.0)) + F.log1p(F.exp(-F.abs(turned))))


def squared_loss(label: Column, margin: Column) -> Column:
    return (label - margin) * (label - margin)


def staged_loss(margins: DataFrame, loss: Column) -> DataFrame:
    """(tree, rows, loss): the mean loss after each stage."""
    return margins.groupBy("tree").agg(F.count(F.lit(1)).alias("rows"), F.avg(loss).alias("loss"))
