"""Linear models as relations: non-zero inputs and coefficients as rows, scores and gradients as grouped sums."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.spec import NUMERIC_FEATURES, SeriesSpec
from stationflow.storage import broadcast_if_small

# Where the intercept stands among the positions of a vector.
INTERCEPT = -1


def positions(base: PipelineModel, df: DataFrame) -> DataFrame:
    """(at, std) of every vector position of a fitted preparation: numeric inputs first, then the entities."""
    found = [(at, float(std)) for at, std in enumerate(base.stages[-1].std.toArray())]
    return df.sparkSession.createDataFrame(found, "at int, std double")


def entity_positions(base: PipelineModel, df: DataFrame) -> DataFrame:
    """(entity, at) of the entities a preparation was fitted on, from its index."""
    first = len(NUMERIC_FEATURES)
    found = [(name, first + at) for at, name in enumerate(base.stages[0].labelsArray[0])]
    return df.sparkSession.createDataFrame(found, "entity string, at int")


def sparse_inputs(rows: DataFrame, base: PipelineModel, spec: SeriesSpec, keys: list[str]) -> DataFrame:
    """(keys, at, x): scaled inputs that are not zero, and a one at ``INTERCEPT`` for every row.

    What indexer, encoder, assembler and scaler do to a row, as joins: a numeric input is divided by the scale of its
    position, the entity is one position, and positions that did not vary where they were fitted give nothing. Rows
    with a missing numeric input are left out, as the assembler skips them.
    """
    first, unseen = len(NUMERIC_FEATURES), len(base.stages[0].labelsArray[0])
    values = [F.col(name).cast("double") for name in NUMERIC_FEATURES]
    whole = rows.dropna(subset=list(NUMERIC_FEATURES))
    of = broadcast_if_small(entity_positions(base, rows))
    known = whole.withColumnRenamed(spec.entity, "entity").join(of, "entity", "left").withColumnRenamed("entity", spec.entity)
    entity = F.struct(F.coalesce("at", F.lit(first + unseen)).alias("at"), F.lit(1.0).alias("raw"))
    numeric = [F.struct(F.lit(at).alias("at"), value.alias("raw")) for at, value in enumerate(values)]
    one = F.struct(F.lit(INTERCEPT).alias("at"), F.lit(1.0).alias("raw"))
    tall = known.select(*keys, F.inline(F.array(one, *numeric, entity))).where("raw <> 0")
    scales = positions(base, rows).where("std > 0").unionByName(
        rows.sparkSession.createDataFrame([(INTERCEPT, 1.0)], "at int, std double")
    )
    return tall.join(broadcast_if_small(scales), "at").select(*keys, "at", (F.col("raw") / F.col("std")).alias("x"))


def coefficients(model, df: DataFrame) -> DataFrame:
    """(at, weight) of a fitted linear or binary logistic model, the intercept at ``INTERCEPT``."""
    found = [(at, float(w)) for at, w in enumerate(model.coefficients.toArray())]
    return df.sparkSession.createDataFrame([(INTERCEPT, float(model.intercept)), *found], "at int, weight double")


def dot_products(
    inputs: DataFrame, weights: DataFrame, keys: list[str], names: dict[str, str] | None = None
) -> DataFrame:
    """(keys, dot): the sum over a row's inputs of input times weight, by a join on the position.

    With ``names``, a sum for each column of weights it lists, under the name given there, in the same pass.
    """
    terms = inputs.join(broadcast_if_small(weights), "at")
    sums = [F.sum(F.col("x") * F.col(w)).alias(dot) for w, dot in (names or {"weight": "dot"}).items()]
    return terms.groupBy(*keys).agg(*sums)


def logistic_gradient(
    inputs: DataFrame, labels: DataFrame, weights: DataFrame, keys: list[str], label: str, l2: float
) -> DataFrame:
    """(at, gradient) of the mean logistic loss with an L2 penalty, for inputs brought to unit deviation.

    The loss is taken over standardised inputs x / s with weights w * s, where s is the deviation of the input over
    all rows, and the penalty acts on the latter; the intercept has none. Inputs that do not vary have gradient
    zero. Two grouped sums over the non-zero inputs, and one join by row between them.
    """
    scored = dot_products(inputs, weights, keys).join(labels.select(*keys, F.col(label).alias("_y")), keys)
    # The difference between probability and label, written so that it does not overflow.
    said = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("dot")))
    errors = scored.select(*keys, (said - F.col("_y")).alias("error"))
    sums = inputs.join(errors, keys).groupBy("at").agg(
        F.sum(F.col("error") * F.col("x")).alias("slope"),
        F.sum("x").alias("sx"),
        F.sum(F.col("x") * F.col("x")).alias("sxx"),
    )
    n = errors.agg(F.count(F.lit(1)).alias("n"))
    joined = weights.join(sums, "at", "left").join(F.broadcast(n))
    spread = F.sqrt(F.greatest((F.col("sxx") - F.col("sx") * F.col("sx") / F.col("n")) / (F.col("n") - 1), F.lit(0.0)))
    free = F.col("slope") / F.col("n")
    bound = F.when(spread > 1e-9, free / spread + l2 * F.col("weight") * spread).otherwise(F.lit(0.0))
    gradient = F.when(F.col("at") == INTERCEPT, free).otherwise(F.coalesce(bound, F.lit(0.0)))
    return joined.select("at", gradient.alias("gradient"))
