"""Capped samples and train / test splits, both independent of the partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.functions.scalars import hash_32
from stationflow.spec import SEED, TEST_SHARE, SeriesSpec

EXPLORATION_ROWS = 500_000
# The border bucket is cut again until it holds no more rows than this, or its hash is used up.
ORDERED_ROWS = 100_000
DIGITS = 4


def smallest_hashes(rows: DataFrame, key: Column, count: int) -> DataFrame:
    """The ``count`` rows of smallest key hash; all if there are no more.

    A plain ordered limit would send ``count`` candidates from every task to one. Rows are counted by 16 bits of
    the hash instead: buckets that fit whole are kept by a filter, and the bucket on the border is counted by the
    next 16 bits, until few enough rows are left to order.
    """
    hashed = rows.withColumn("__hash", F.md5(key))
    border, taken, left = "", 0, hashed
    while len(border) < 32:
        digits = F.substring("__hash", len(border) + 1, DIGITS)
        sizes = left.groupBy(digits.alias("digits")).count().collect()
        for row in sorted(sizes):
            if taken + row["count"] > count:
                border, size = border + row["digits"], row["count"]
                break
            taken += row["count"]
        else:
            # Only at first: below a border the rows left never fit whole.
            return rows
        left = hashed.filter(F.col("__hash").startswith(border))
        if size <= ORDERED_ROWS:
            break
    rest = left.orderBy("__hash").limit(count - taken)
    return hashed.filter(F.col("__hash") < border).unionByName(rest).drop("__hash")


def capped_sample(
    rows: DataFrame, column: str, key: Column, count: int = EXPLORATION_ROWS
) -> DataFrame:
    """A sample of at most ``count`` rows in which ``column`` is present."""
    return smallest_hashes(rows.dropna(subset=[column]), key, count)


def split_column(
    spec: SeriesSpec, test_share: float = TEST_SHARE, seed: int | None = None
) -> Column:
    """``train`` or ``test`` from a 32-bit hash of the row's own key, so any share is met."""
    key = spec.row_id() if seed is None else F.concat_ws("|", spec.row_id(), F.lit(str(seed)))
    return F.when(hash_32(key) < F.lit(test_share * 2**32), "test").otherwise("train")


def with_split(rows: DataFrame, spec: SeriesSpec, **options) -> DataFrame:
    return rows.withColumn("split", split_column(spec, **options))


def split_rows(rows: DataFrame, spec: SeriesSpec, **options) -> tuple[DataFrame, DataFrame]:
    """(train, test): disjoint and complete whatever the partitioning."""
    marked = with_split(rows, spec, **options)
    return tuple(marked.filter(F.col("split") == part).drop("split") for part in ("train", "test"))


def random_split(
    rows: DataFrame, test_share: float = TEST_SHARE, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Spark's own random split; which rows fall where depends on the partitioning."""
    return tuple(rows.randomSplit([1 - test_share, test_share], seed))


def placed(train: DataFrame, test: DataFrame, partitions: int) -> tuple[DataFrame, DataFrame]:
    """Even partitions for iterative fitting: ``partitions`` for train, a quarter (8 at least) for test."""
    return train.repartition(partitions), test.repartition(max(8, partitions // 4))


def split_sizes(rows: DataFrame) -> DataFrame:
    """Rows per split and their percentage of all rows (0 for an empty input)."""
    sizes = rows.agg(
        F.count_if(F.col("split") == "train").alias("train"),
        F.count_if(F.col("split") == "test").alias("test"),
        F.count(F.lit(1)).alias("total"),
    ).unpivot("total", ["train", "test"], "split", "rows")
    return sizes.select("split", "rows", F.coalesce(F.try_divide(F.col("rows") * 100.0, "total"), F.lit(0.0)).alias("percent"))
