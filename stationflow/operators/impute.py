"""Median imputation with exact medians that never need all values in one place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationflow.operators.profile import value_counts
from stationflow.spec import MEASURES
from stationflow.storage import stage

MAX_DISTINCT = 1_000_000
CUTS = 64


def exact_medians(
    rows: DataFrame,
    columns: Sequence[str] = MEASURES,
    at_most: int | None = None,
    max_distinct: int = MAX_DISTINCT,
) -> dict[str, float]:
    """Median of each column over its present values; columns without any are left out.

    One pass reduces all columns to a count per distinct value, combined before and after a shuffle by value.
    The last step then sees distinct values only. A column with more than ``max_distinct`` of them is narrowed
    down by rank first. ``at_most`` is an upper bound of the row count, when one is known: if that is
    small enough, the counts need not be written in between.
    """
    counts = value_counts(rows, [], columns)
    if at_most is None or at_most > max_distinct:
        counts = stage(counts, "value-counts")
        widths = {r["measure"]: r["count"] for r in counts.groupBy("measure").count().collect()}
        wide = {c for c, width in widths.items() if width > max_distinct}
    else:
        wide = set()
    narrow = counts.filter(~F.col("measure").isin(*wide)) if wide else counts
    medians = narrow.groupBy("measure").agg(
        F.percentile("value", F.lit(0.5), F.col("rows")).alias("median")
    )
    found = {r["measure"]: r["median"] for r in medians.collect()}
    for c in wide:
        found[c] = _median_by_rank(counts.filter(F.col("measure") == c), max_distinct)
    return {c: found[c] for c in columns if c in found}


def approximate_medians(
    rows: DataFrame, columns: Sequence[str] = MEASURES, error: float = 0.05
) -> dict[str, float]:
    """Medians within a rank error, in one pass; results depend on the partitioning."""
    quantiles = rows.approxQuantile(list(columns), [0.5], error)
    return {c: q[0] for c, q in zip(columns, quantiles) if q}


def fill_missing(rows: DataFrame, medians: dict[str, float]) -> DataFrame:
    """Null and NaN measures replaced by the given values."""
    return rows.fillna(medians) if medians else rows


def _median_by_rank(counts: DataFrame, max_distinct: int) -> float:
    """Median of (value, rows) pairs: close in on the middle ranks until few values are left.

    Each round cuts the remaining values into about ``CUTS`` parts, counts the rows below every cut exactly, and
    keeps the parts that hold the middle ranks.
    """
    total = counts.agg(F.sum("rows")).first()[0]
    middle = ((total - 1) // 2, total // 2)
    left, below, width = counts, 0, counts.count()
    while width > max(max_distinct, CUTS):
        shares = [i / CUTS for i in range(1, CUTS)]
        cuts = sorted(set(left.agg(F.percentile_approx("value", shares, 10 * CUTS)).first()[0]))
        under = left.agg(
            *[F.coalesce(F.sum(F.when(F.col("value") < cut, F.col("rows"))), F.lit(0)) for cut in cuts]
        ).first()
        before = [below + n for n in under]
        low = max((i for i, n in enumerate(before) if n <= middle[0]), default=None)
        high = min((i for i, n in enumerate(before) if n > middle[1]), default=None)
        if low is not None:
            left, below = left.filter(F.col("value") >= cuts[low]), before[low]
        if high is not None:
            left = left.filter(F.col("value") < cuts[high])
        narrower = left.count()
        if narrower == width:
            raise RuntimeError(f"{width} distinct values cannot be cut any further")
        width = narrower
    # No more than max_distinct rows, or one round's cuts, reach this ordering.
    running = left.withColumn("upto", F.sum("rows").over(Window.orderBy("value")) + F.lit(below))
    row = running.agg(
        *[F.min(F.when(F.col("upto") > rank, F.col("value"))) for rank in middle]
    ).first()
    return (row[0] + row[1]) / 2
