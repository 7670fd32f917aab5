"""Windows over series that stay within one task even when one entity holds most of the rows.

``Window.partitionBy(entity)`` sends a whole entity to one task. That is right, and cheapest, for
every entity of ordinary length; an entity above ``max_rows`` is cut along its own order instead:

1. rows of long entities are range-partitioned by (entity, time, tiebreak), which balances by rows,
   and written once with the partition number as ``block``, so blocks never change afterwards;
2. a row-based frame reaches at most ``back`` rows before and ``ahead`` rows after a row, so each block
   is given copies of exactly those neighbouring rows;
3. windows run per (entity, block) and the copies are dropped.

Copies are picked from block edges only (at most ``back`` or ``ahead`` rows per block, pruned before the
shuffle), and they may come from several earlier blocks when some are short: the result equals the plain
window for every input whose order is total.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from stationflow.spec import SeriesSpec
from stationflow.storage import partitioned_for, stage

BLOCK = "__block"
SOURCE = "__source_block"
MAX_ROWS_PER_TASK = 2_000_000


@dataclass(frozen=True)
class Series:
    """A frame in up to two parts: ordinary entities, and long ones already cut into blocks."""

    spec: SeriesSpec
    ordinary: DataFrame
    long: DataFrame | None = None
    counted: int = 0
    counted_long: int = 0

    @classmethod
    def of(
        cls,
        df: DataFrame,
        spec: SeriesSpec,
        max_rows: int = MAX_ROWS_PER_TASK,
        superset: DataFrame | None = None,
        laid_out: bool = False,
    ) -> Series:
        """Count rows per entity (one narrow, map-side combined job) and set long ones apart.

        ``laid_out`` says that ``df`` reads a table bucketed by the entity: its rows are where windows need them,
        so ordinary entities are not shuffled.

        ``superset`` may name a frame with at least these rows that is cheaper to count. ``counted`` keeps the
        number of rows found, i.e. an upper bound.
        """
        source = df if superset is None else superset
        hot = F.when(F.col("count") > max_rows, F.struct(spec.entity, "count"))
        sizes = source.groupBy(spec.entity).count().agg(F.sum("count"), F.collect_list(hot)).first()
        counted, hot = sizes[0] or 0, sizes[1]
        if not hot:
            return cls(spec, df if laid_out else partitioned_for(df, counted, spec.entity), counted=counted)
        # Each name listed stands for more than max_rows rows, so the list is at most rows / max_rows.
        names = df.sparkSession.createDataFrame(
            [(row[0],) for row in hot], df.select(spec.entity).schema
        )
        counted_long = sum(row["count"] for row in hot)
        long = (
            df.join(F.broadcast(names), spec.entity, "left_semi")
            .select(df.columns)
            .repartitionByRange(math.ceil(counted_long * 2 / max_rows), spec.entity, *spec.order)
            .withColumn(BLOCK, F.spark_partition_id())
        )
        rest = df.join(F.broadcast(names), spec.entity, "left_anti").select(df.columns)
        if not laid_out:
            rest = partitioned_for(rest, counted - counted_long, spec.entity)
        return cls(spec, rest, stage(long, "blocks"), counted, counted_long)

    def each(self, change: Callable[[DataFrame], DataFrame]) -> Series:
        """Apply a row-wise change to every part."""
        return replace(
            self,
            ordinary=change(self.ordinary),
            long=None if self.long is None else change(self.long),
        )

    def over(
        self,
        columns: Callable[[WindowSpec], dict[str, Column]],
        back: int = 0,
        ahead: int = 0,
    ) -> Series:
        """Add window columns whose frames reach ``back`` rows behind and ``ahead`` rows in front."""
        ordinary = self.ordinary.withColumns(columns(self.spec.window()))
        if self.long is None:
            return replace(self, ordinary=ordinary)
        spec = self.spec
        own = self.long.withColumn(SOURCE, F.col(BLOCK))
        framed = own
        if back:
            framed = framed.unionByName(_copies(own, spec, back, ascending=True))
        if ahead:
            framed = framed.unionByName(_copies(own, spec, ahead, ascending=False))
        framed = partitioned_for(framed, self.counted_long, spec.entity, BLOCK)
        within = Window.partitionBy(spec.entity, BLOCK).orderBy(*spec.order, SOURCE)
        long = (
            framed.withColumns(columns(within))
            .filter(F.col(BLOCK) == F.col(SOURCE))
            .drop(SOURCE)
        )
        return replace(self, ordinary=ordinary, long=long)

    def frame(self) -> DataFrame:
        """All parts as one frame."""
        if self.long is None:
            return self.ordinary
        return self.ordinary.unionByName(self.long.drop(BLOCK))


def _copies(own: DataFrame, spec: SeriesSpec, reach: int, ascending: bool) -> DataFrame:
    """Rows a block needs from its neighbours: those before it (ascending) or after it.

    With only block edges left, a row is needed by exactly the blocks met within the next ``reach`` rows.
    """
    order = (*spec.order, SOURCE)
    forward = [F.asc(c) if ascending else F.desc(c) for c in order]
    backward = [F.desc(c) if ascending else F.asc(c) for c in order]
    edge = Window.partitionBy(spec.entity, SOURCE).orderBy(*backward)
    following = Window.partitionBy(spec.entity).orderBy(*forward).rowsBetween(1, reach)
    return (
        own.withColumn("__rank", F.row_number().over(edge))
        .filter(F.col("__rank") <= reach)
        .drop("__rank")
        .withColumn("__near", F.collect_set(SOURCE).over(following))
        .withColumn(BLOCK, F.explode(F.array_remove("__near", F.col(SOURCE))))
        .drop("__near")
    )
