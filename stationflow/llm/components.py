"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.storage import stage

MOST_ROUNDS = 60


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of the links; the root is the smallest node of its component.

    Each round joins links with the smallest neighbour of each node, which is aggregated before the shuffle; a node
    with very many links is split by the adaptive skew join. Rounds are staged, so lineage stays short and a lost
    executor costs one round. Links with a null end are left out, loops and repeated links are harmless.
    """
    now = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    now = stage(now.where("u is not null and v is not null and u <> v").distinct(), "links")
    last = None
    for _ in range(MOST_ROUNDS):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.toDF("u", "v"))
        now = stage(small.where("u <> v").distinct(), "links")
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == last:
            root = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return root.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        last = mark
    raise RuntimeError(f"components have not settled in {MOST_ROUNDS} rounds")
