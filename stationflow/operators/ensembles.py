"""Tree ensembles over numeric inputs and a one-hot entity, fitted without making the entity's positions dense.

The ensembles of Spark ML hold every row as a dense array of bins, one for each position of its vector, so their work
and memory grow with rows times entities. Here a row is its numeric bins and the one position of its entity, and the
trees are those of Spark ML otherwise: same split candidates of numeric inputs, gains, limits, losses, learning rate,
bagging and shares of inputs at a node. Every entity is a candidate, where Spark ML knows those of a sample only.

Each level of all trees is one pass: tasks add up statistics of their rows per (tree, node, input, bin), a shuffle adds
them up by tree, and the best split of each node goes back to the driver. Rows of an entity lie in one part, so that its
statistics are whole there and only the best one of a part leaves it; entities with a large share of the rows are spread
over all parts and added up like bins. What leaves a task grows with nodes, inputs and bins, not with rows or entities.
"""

from __future__ import annotations

import io
import json
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.storage import delete, reach_workers, stage, work_dir

ROWS_PER_BLOCK = 250_000
# An entity with more than this share of the rows is spread over all parts; there are fewer than 256 such.
HEAVY_SHARE = 1 / 256
# Statistics of a single tree's level, over all parts, up to which the driver adds them up itself: a stage less a level.
FEW_BYTES = 32 << 20
# Rows from which candidates of numeric inputs are taken, as in Spark ML: at least this many, and bins squared.
SPLIT_ROWS = 10_000
BINNED = "key long, hot int, scale double, label double, bins binary"
MODELS = {
    ("clf", "rf"): (RandomForestClassificationModel, "classification.DecisionTreeClassificationModel"),
    ("reg", "rf"): (RandomForestRegressionModel, "regression.DecisionTreeRegressionModel"),
    ("clf", "gbt"): (GBTClassificationModel, "regression.DecisionTreeRegressionModel"),
    ("reg", "gbt"): (GBTRegressionModel, "regression.DecisionTreeRegressionModel"),
}
NODES = (
    "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, "
    "rawCount: bigint, gain: double, leftChild: int, rightChild: int, "
    "split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"
)


@dataclass(frozen=True)
class Inputs:
    """Where candidates lie: cuts of each numeric input, and the spread entities as (position, scaled value)."""

    cuts: list[np.ndarray]
    width: int
    bins: int
    heavy: list[tuple[int, float]]

    @property
    def dense(self) -> int:
        return len(self.cuts)


class Tree:
    """Nodes in heap order: feature (-1 for a leaf), bin of the cut, threshold, and (rows, sum, squares) of labels."""

    def __init__(self, depth: int, root: np.ndarray):
        size = 2 ** (depth + 1) - 1
        self.feature = np.full(size, -1, np.int32)
        self.cut = np.zeros(size, np.uint8)
        self.threshold = np.zeros(size)
        self.gain = np.full(size, -1.0)
        self.stats = np.zeros((size, 3))
        self.stats[0] = root

    def ends(self, block: dict, rows: np.ndarray, depth: int) -> np.ndarray:
        """The node where each of the rows of a block is after ``depth`` steps."""
        node, bins, hot = np.zeros(len(rows), np.int32), block["bins"], block["hot"][rows]
        dense = len(bins)
        for _ in range(depth):
            feature = self.feature[node]
            numeric = (feature >= 0) & (feature < dense)
            right = np.where(numeric, bins[np.where(numeric, feature, 0), rows] > self.cut[node], feature == hot)
            node = np.where(feature < 0, node, 2 * node + 1 + right).astype(np.int32)
        return node

    def values(self) -> np.ndarray:
        return np.divide(self.stats[:, 1], self.stats[:, 0], out=np.zeros(len(self.stats)), where=self.stats[:, 0] > 0)


def fit(vectors: DataFrame, estimator, task: str, name: str, dense: int):
    """The fitted model of an unfitted tree estimator, over vectors of ``dense`` numeric positions and a one-hot rest."""
    label = estimator.getLabelCol()
    reach_workers(vectors.sparkSession)
    first = vectors.select(F.unwrap_udt(estimator.getFeaturesCol()).alias("v"))
    # A dense vector has no size of its own, its values show it.
    width, count = first.agg(F.max(F.coalesce("v.size", F.size("v.values"))), F.count(F.lit(1))).first()
    inputs, blocks = _blocks(vectors, estimator, label, dense, width, count)
    grow = _forest if name == "rf" else _boosted
    try:
        trees, weights = grow(blocks, inputs, estimator, task)
    finally:
        blocks.unpersist()
    return _model(vectors.sparkSession, estimator, task, name, inputs, trees, weights)


# ---- rows as blocks of bins ---------------------------------------------------------------------------


def _triples(batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, position and value of everything a batch of unwrapped vectors holds."""
    sparse = np.asarray(batch.column("sparse"))
    values, indices = batch.column("values"), batch.column("indices")
    lengths = np.diff(values.offsets.to_numpy())
    rows = np.repeat(np.arange(len(sparse)), lengths)
    places = np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    places[sparse[rows]] = indices.flatten().to_numpy(zero_copy_only=False)
    return rows, places, values.flatten().to_numpy(zero_copy_only=False)


def _unwrapped(vectors: DataFrame, features: str, label: str) -> DataFrame:
    v = F.unwrap_udt(features)
    empty = F.array().cast("array<int>")
    return vectors.select(
        F.xxhash64(v["indices"], v["values"], F.col(label)).alias("key"),
        (v["type"] == 0).alias("sparse"),
        F.when(v["type"] == 0, v["indices"]).otherwise(empty).alias("indices"),
        v["values"].alias("values"),
        F.col(label).cast("double").alias("label"),
    )


def _matrix(batch, dense: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numeric inputs (input by row), position of the entity (-1 without one) and its value."""
    rows, places, values = _triples(batch)
    numeric, hot = np.zeros((dense, batch.num_rows)), np.full(batch.num_rows, -1, np.int32)
    scale, low = np.zeros(batch.num_rows), places < dense
    numeric[places[low], rows[low]] = values[low]
    high = ~low & (values != 0)
    hot[rows[high]], scale[rows[high]] = places[high], values[high]
    return numeric, hot, scale


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    """Split candidates of a numeric input, as Spark ML takes them from a sample of its values."""
    distinct, counts = np.unique(values, return_counts=True)
    if len(distinct) <= bins:
        return (distinct[1:] + distinct[:-1]) / 2
    stride, found = len(values) / bins, []
    target, upto = stride, np.cumsum(counts)
    for at in range(1, len(distinct)):
        if abs(upto[at - 1] - target) < abs(upto[at] - target):
            found.append((distinct[at - 1] + distinct[at]) / 2)
            target += stride
    return np.array(found[: bins - 1])


def _blocks(vectors, estimator, label, dense, width, count):
    bins = min(estimator.getMaxBins(), count)
    rows = _unwrapped(vectors, estimator.getFeaturesCol(), label)
    share = min(1.0, max(bins * bins, SPLIT_ROWS) / count)
    sample = rows.where(F.pmod("key", F.lit(1_000_000)) < F.lit(math.ceil(share * 1_000_000)))

    def numeric(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(list(_matrix(batch, dense)[0].T), pa.list_(pa.float64()))], ["x"])

    seen = np.array([r["x"] for r in sample.mapInArrow(numeric, "x array<double>").collect()])
    cuts = [_cuts(seen[:, at], bins) for at in range(dense)]

    def binned(batches):
        for batch in batches:
            values, hot, scale = _matrix(batch, dense)
            places = np.array([np.searchsorted(c, v) for c, v in zip(cuts, values)], np.uint8).T
            packed = [row.tobytes() for row in np.ascontiguousarray(places)]
            columns = [batch.column("key"), pa.array(hot), pa.array(scale), batch.column("label"), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "hot", "scale", "label", "bins"])

    table = stage(rows.mapInArrow(binned, BINNED), "binned")
    heavy = table.where("hot >= 0").groupBy("hot").agg(F.count(F.lit(1)).alias("n"), F.max("scale").alias("scale"))
    heavy = sorted((r["hot"], r["scale"]) for r in heavy.where(F.col("n") > count * HEAVY_SHARE).collect())
    spread = F.col("hot").isin([-1, *[at for at, _ in heavy]])
    parts = max(vectors.sparkSession.sparkContext.defaultParallelism, math.ceil(count / ROWS_PER_BLOCK))
    place = F.when(spread, F.xxhash64("key")).otherwise(F.xxhash64("hot"))
    order = np.array([at for at, _ in heavy], np.int32)

    def packed(batches):
        found = [b for b in batches if b.num_rows]
        if not found:
            return
        part = pa.Table.from_batches(found)
        # Copies of a row are alike, so this order is the same whenever a part is computed again.
        part = part.take(pc.sort_indices(part, [("key", "ascending"), ("hot", "ascending"), ("label", "ascending")]))
        hot = part["hot"].to_numpy()
        place = np.searchsorted(order, hot) if len(order) else np.zeros(len(hot), np.int64)
        spread = (order[np.minimum(place, len(order) - 1)] == hot) if len(order) else np.zeros(len(hot), bool)
        names, own = np.unique(np.where(spread, -1, hot), return_inverse=True)
        scales = np.zeros(len(names))
        scales[own] = np.where(spread, 0, part["scale"].to_numpy())
        flat = np.frombuffer(b"".join(part["bins"].to_pylist()), np.uint8)
        arrays = io.BytesIO()
        np.savez(
            arrays,
            bins=np.ascontiguousarray(flat.reshape(len(hot), dense).T),
            hot=hot.astype(np.int32),
            spread=np.where(spread, place, len(order)).astype(np.int16),
            own=own.astype(np.int32),
            names=names.astype(np.int32),
            scales=scales,
            label=part["label"].to_numpy(),
        )
        yield pa.RecordBatch.from_arrays([pa.array([arrays.getvalue()], pa.binary())], ["block"])

    laid = table.repartition(parts, place).mapInArrow(packed, "block binary")
    blocks = laid.rdd.mapPartitionsWithIndex(_opened).persist(StorageLevel.MEMORY_AND_DISK)
    return Inputs(cuts, width, bins, heavy), blocks


def _opened(part: int, rows):
    for row in rows:
        with np.load(io.BytesIO(bytes(row["block"]))) as arrays:
            yield {"part": part, **arrays}


# ---- one level of all trees ---------------------------------------------------------------------------


def _by_node(cells: np.ndarray, nodes: int, size: int, weights) -> np.ndarray:
    """Sums (node, place, statistic) over rows of the cell ``node * size + place``; rows count once without a weight."""
    return np.stack([np.bincount(cells, w, nodes * size).reshape(nodes, size) for w in weights], -1)


def _gains(right: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Loss of variance, over rows, of putting ``right`` apart from ``total`` (statistics come last)."""
    left = total - right
    with np.errstate(divide="ignore", invalid="ignore"):
        rest = left[..., 1] ** 2 / left[..., 0] + right[..., 1] ** 2 / right[..., 0] - total[..., 1] ** 2 / total[..., 0]
        gains = rest / total[..., 0]
    return np.where((left[..., 0] > 0.5) & (right[..., 0] > 0.5), gains, -np.inf)


def _chance(seed: int, tree: int, nodes: np.ndarray, names: np.ndarray) -> np.ndarray:
    """A number from 0 to 1 for each (node, entity) of a tree, the same in every task."""
    mixed = (nodes.astype(np.uint64) + np.uint64(tree * 4096 + 1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = mixed + names.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03) + np.uint64(seed % 2**63)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    return (mixed ^ (mixed >> np.uint64(31))).astype(float) / 2.0**64


def _shares(inputs: Inputs, taken: int, seed: int, tree: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which numeric inputs each node may use, and the chance of an entity, for ``taken`` of all inputs a node."""
    allowed, chance = np.zeros((len(nodes), inputs.dense), bool), np.zeros(len(nodes))
    rest = inputs.width - inputs.dense
    for at, node in enumerate(nodes):
        draw = np.random.default_rng([seed, tree, int(node)])
        numeric = draw.hypergeometric(inputs.dense, rest, taken) if rest else taken
        allowed[at, draw.permutation(inputs.dense)[:numeric]] = True
        chance[at] = (taken - numeric) / rest if rest else 0.0
    return allowed, chance


def _statistics(block: dict, inputs: Inputs, tree: Tree, number: int, level: int, taken: int, seed: int, weight, label):
    """Statistics of a block for the nodes of one level: of bins, of spread entities, and the best entity of its own."""
    low, size = 2**level - 1, 2**level
    rows = np.arange(len(label)) if weight is None else np.flatnonzero(weight)
    node = tree.ends(block, rows, level) - low
    # In order of nodes, so that those of some nodes are a slice; inside a node they stay in the order of the block.
    order = np.argsort(node.astype(np.int16), kind="stable")
    order = order[np.searchsorted(node, 0, sorter=order) :]
    rows, node = rows[order], node[order].astype(np.int64)
    y = label[rows]
    w = None if weight is None else weight[rows].astype(float)
    wy = y if w is None else w * y
    weights = (w, wy, wy * y)
    nodes = np.arange(size) + low
    allowed, chance = _shares(inputs, taken, seed, number, nodes)
    dense = np.zeros((inputs.dense, size, inputs.bins, 3))
    bins, cells = block["bins"].take(rows, axis=1), node * inputs.bins
    for at in np.flatnonzero(allowed.any(0)):
        # Rows of other nodes are added up too: leaving them out takes longer.
        dense[at] = _by_node(cells + bins[at], size, inputs.bins, weights)
        dense[at][~allowed[:, at]] = 0
    spread = _by_node(node * (len(inputs.heavy) + 1) + block["spread"][rows], size, len(inputs.heavy) + 1, weights)[:, :-1]
    best, names, own = np.full((size, 6), -np.inf), block["names"], block["own"][rows]
    total = tree.stats[nodes]
    for start in range(0, size, 16):
        # A few nodes at a time: the entities of a block are many. Few of them are in any one node further down.
        few = min(16, size - start)
        a, b = np.searchsorted(node, [start, start + few])
        if a == b:
            continue
        cells = (node[a:b] - start) * len(names) + own[a:b]
        sums = [np.bincount(cells, None if x is None else x[a:b], few * len(names)) for x in weights]
        held = np.flatnonzero(sums[0])
        line, name = np.divmod(held, len(names))
        sums = np.stack([x[held] for x in sums], -1)
        gains = _gains(sums, total[start + line])
        gains[names[name] < 0] = -np.inf
        if (chance[start : start + few] < 1).any():
            some = np.flatnonzero(gains > 0)
            drawn = _chance(seed, number, nodes[start + line[some]], names[name[some]])
            gains[some[drawn >= chance[start + line[some]]]] = -np.inf
        edges = np.searchsorted(line, np.arange(few + 1))
        for at in np.flatnonzero(np.diff(edges)):
            top = edges[at] + gains[edges[at] : edges[at + 1]].argmax()
            # Gain, position, threshold, and the statistics on its right.
            best[start + at] = [gains[top], names[name[top]], block["scales"][name[top]] / 2, *sums[top]]
    return dense, spread, best


def _merged(one, two):
    better = (two[2][:, 0] > one[2][:, 0]) | ((two[2][:, 0] == one[2][:, 0]) & (two[2][:, 1] < one[2][:, 1]))
    return one[0] + two[0], one[1] + two[1], np.where(better[:, None], two[2], one[2])


def _chosen(found, inputs: Inputs, total: np.ndarray, allowed: np.ndarray, chances: np.ndarray):
    """For each node: gain, feature, bin of the cut, threshold, and the statistics of its right side."""
    dense, spread, best = found
    size = len(total)
    lines = np.arange(size)
    # Rows right of each cut: all of larger bins.
    right = dense[:, :, ::-1].cumsum(2)[:, :, ::-1][:, :, 1:]
    choice = np.hstack([best[:, :2], np.zeros((size, 1)), best[:, 2:]])
    for at, (place, scale) in enumerate(inputs.heavy):
        gains = np.where(chances[:, at], _gains(spread[:, at], total), -np.inf)
        line = np.hstack([np.array([gains, np.full(size, place), np.zeros(size), np.full(size, scale / 2)]).T, spread[:, at]])
        better = (gains > choice[:, 0]) | ((gains == choice[:, 0]) & (place < choice[:, 1]))
        choice = np.where(better[:, None], line, choice)
    for at in reversed(range(inputs.dense)):
        cuts = inputs.cuts[at]
        if not len(cuts):
            continue
        gains = _gains(right[at, :, : len(cuts)], total[:, None])
        gains[~allowed[:, at]] = -np.inf
        cut = gains.argmax(1)
        gains = gains[lines, cut]
        line = np.hstack([np.array([gains, np.full(size, at), cut, cuts[cut]]).T, right[at, lines, cut]])
        choice = np.where((gains >= choice[:, 0])[:, None] & np.isfinite(gains)[:, None], line, choice)
    return choice


def _grown(blocks, inputs: Inputs, trees: list[Tree], depth: int, taken: int, seed: int, share: float | None, labels):
    """Grow trees level by level; ``share`` is the rate of bagging (None: every row once), ``labels`` maps a block."""
    parts = min(len(trees), blocks.context.defaultParallelism)
    for level in range(depth):
        nodes = np.arange(2**level) + 2**level - 1
        live = {
            at: tree for at, tree in enumerate(trees) if (tree.stats[nodes, 0] > 1.5).any()
        }
        if not live:
            break

        def partial(block, live=live, level=level):
            y = labels(block)
            for number, tree in live.items():
                weight = _bagged(block, seed, number, share)
                yield number, _statistics(block, inputs, tree, number, level, taken, seed, weight, y)

        def choose(item, live=live, nodes=nodes):
            number, found = item
            allowed, chance = _shares(inputs, taken, seed, number, nodes)
            free = [_chance(seed, number, nodes, np.array([p])) < chance for p, _ in inputs.heavy]
            free = np.array(free).reshape(len(inputs.heavy), len(nodes)).T
            return number, _chosen(found, inputs, live[number].stats[nodes], allowed, free)

        found = blocks.flatMap(partial)
        if len(live) == 1 and blocks.getNumPartitions() * inputs.dense * len(nodes) * inputs.bins * 24 <= FEW_BYTES:
            number = next(iter(live))
            choices = [choose((number, found.values().reduce(_merged)))]
        else:
            choices = found.reduceByKey(_merged, parts).map(choose).collect()
        for number, choice in choices:
            tree = trees[number]
            for node, (gain, feature, cut, threshold, *right) in zip(nodes, choice):
                if not gain > 0 or tree.stats[node, 0] < 1.5:
                    continue
                tree.feature[node], tree.cut[node], tree.threshold[node], tree.gain[node] = feature, cut, threshold, gain
                tree.stats[2 * node + 2] = right
                tree.stats[2 * node + 1] = tree.stats[node] - right


def _bagged(block: dict, seed: int, tree: int, share: float | None):
    if share is None:
        return None
    return np.random.default_rng([seed, tree, block["part"]]).poisson(share, len(block["label"])).astype(np.uint8)


def _totals(y: np.ndarray, weight=None) -> np.ndarray:
    w = np.ones(len(y)) if weight is None else weight
    return np.array([w.sum(), (w * y).sum(), (w * y * y).sum()])


# ---- the two ensembles --------------------------------------------------------------------------------


def _forest(blocks, inputs, estimator, task):
    seed, share, count = estimator.getSeed(), estimator.getSubsamplingRate(), estimator.getNumTrees()
    taken = math.ceil(math.sqrt(inputs.width)) if task == "clf" else math.ceil(inputs.width / 3)
    roots = blocks.map(
        lambda b: np.array([_totals(b["label"], _bagged(b, seed, t, share)) for t in range(count)])
    ).treeReduce(np.add)
    trees = [Tree(estimator.getMaxDepth(), root) for root in roots]
    _grown(blocks, inputs, trees, estimator.getMaxDepth(), taken, seed, share, lambda b: b["label"])
    return trees, [1.0] * count


def _boosted(blocks, inputs, estimator, task):
    """The first tree learns the labels (-1 and 1 for classes), the others what the loss still asks for."""
    depth, seed, rate = estimator.getMaxDepth(), estimator.getSeed(), estimator.getStepSize()

    def started(block):
        y = 2 * block["label"] - 1 if task == "clf" else block["label"]
        return {**block, "label": y, "margin": np.zeros(len(y)), "target": y}

    def moved(block, tree, weight):
        ends = tree.ends(block, np.arange(len(block["label"])), depth)
        margin, y = block["margin"] + weight * tree.values()[ends], block["label"]
        # Minus the slopes of the two losses of Spark ML.
        target = 4 * y / (1 + np.exp(np.minimum(2 * y * margin, 700))) if task == "clf" else 2 * (y - margin)
        return {**block, "margin": margin, "target": target}

    state, trees, weights = blocks.map(started).persist(StorageLevel.MEMORY_AND_DISK), [], []
    before, root = None, None
    for number in range(estimator.getMaxIter()):
        if root is None:
            root = state.map(lambda b: _totals(b["target"])).reduce(np.add)
        tree = Tree(depth, root)
        _grown(state, inputs, [tree], depth, inputs.width, seed, None, lambda b: b["target"])
        if before is not None:
            # By now the rows are held in their new state.
            before.unpersist()
        trees.append(tree)
        weights.append(1.0 if number == 0 else rate)
        before, state = state, _next(state, moved, tree, weights[-1])
        # Slopes of the squared loss follow from the leaves, those of the other one need a pass over the rows.
        root = None if task == "clf" else _left_over(tree, 2.0 if number == 0 else 1.0, 2 * weights[-1])
    if before is not None:
        before.unpersist()
    state.unpersist()
    return trees, weights


def _left_over(tree: Tree, scale: float, step: float) -> np.ndarray:
    """(rows, sum, squares) of ``scale * y - step * value`` over the rows of a tree, from those of y in its leaves."""
    leaves = (tree.feature < 0) & (tree.stats[:, 0] > 0)
    n, total, squares = tree.stats[leaves].T
    by = step * total / n
    sums = scale * total - by * n
    return np.array([n.sum(), sums.sum(), (scale * scale * squares - 2 * scale * by * total + by * by * n).sum()])


def _next(state, moved, tree, weight):
    return state.map(lambda block: moved(block, tree, weight)).persist(StorageLevel.MEMORY_AND_DISK)


# ---- the stored form ----------------------------------------------------------------------------------


def _node_rows(tree: Tree, classes: bool) -> list[tuple]:
    """Rows (id, ...) in preorder. Leaves of one parent that name the same class become one, as in Spark ML."""
    values = tree.values()
    said = (values > 0.5).astype(float) if classes else values
    leaf = tree.feature < 0
    if classes:
        for node in reversed(range(len(leaf) // 2)):
            left, right = 2 * node + 1, 2 * node + 2
            if not leaf[node] and leaf[left] and leaf[right] and said[left] == said[right]:
                leaf[node] = True
    rows = []

    def visit(node: int) -> int:
        at = len(rows)
        rows.append(None)
        n, total, squares = map(float, tree.stats[node])
        mean = total / n if n else 0.0
        impurity = 2 * mean * (1 - mean) if classes else max(squares / n - mean * mean, 0.0) if n else 0.0
        stats = [n - total, total] if classes else [n, total, squares]
        left, right, gain, split = -1, -1, -1.0, (-1, [], -1)
        if not leaf[node]:
            left, right = visit(2 * node + 1), visit(2 * node + 2)
            gain = float(tree.gain[node]) * (2 if classes else 1)
            split = (int(tree.feature[node]), [float(tree.threshold[node])], -1)
        rows[at] = (at, float(said[node]), impurity, stats, int(round(n)), gain, left, right, split)
        return at

    visit(0)
    return rows


def _model(spark, estimator, task, name, inputs, trees, weights):
    """The trees in the stored form of Spark ML, loaded: scoring and keeping them is Spark's own again."""
    kind, inner = MODELS[task, name]
    path = f"{work_dir(spark)}/ensemble-{estimator.uid}"
    classes = (task, name) == ("clf", "rf")
    estimator.write().overwrite().save(f"{path}/estimator")
    about = json.loads(spark.read.text(f"{path}/estimator/metadata").first()["value"])
    about["class"] = f"org.apache.spark.ml.{'classification' if task == 'clf' else 'regression'}.{kind.__name__}"
    about |= {"numFeatures": inputs.width, "numTrees": len(trees)} | ({"numClasses": 2} if classes else {})
    known = ("maxBins", "maxDepth", "seed")
    single = {k: v for k, v in (about["defaultParamMap"] | about["paramMap"]).items() if k in known}
    texts = [
        {**{k: about[k] for k in ("timestamp", "sparkVersion")}, "class": f"org.apache.spark.ml.{inner}",
         "uid": f"{estimator.uid}_{at}", "paramMap": single, "defaultParamMap": {}}
        for at in range(len(trees))
    ]
    model = f"{path}/model"
    delete(spark, model)
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{model}/metadata")
    rows = [(at, json.dumps(text), weight) for at, (text, weight) in enumerate(zip(texts, weights))]
    spark.createDataFrame(rows, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{model}/treesMetadata")
    nodes = [(at, row) for at, tree in enumerate(trees) for row in _node_rows(tree, classes)]
    spark.createDataFrame(nodes, NODES).coalesce(1).write.parquet(f"{model}/data")
    loaded = kind.load(model)
    delete(spark, path)
    return loaded
