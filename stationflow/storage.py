"""Where intermediate tables go, and how small sides of joins are recognised."""

from __future__ import annotations

import math
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000
ROWS_PER_PARTITION = 1_000_000
_staged: list[str] = []


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, if the driver was not told by PYTHONPATH.

    On a cluster whose machines do not share that folder, send the package along with ``--py-files``.
    """
    root, environment = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([*known, root])


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a scratch folder only in local mode."""
    sc = spark.sparkContext
    found = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if found is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        found = tempfile.mkdtemp(prefix="stationflow-")
        sc.setCheckpointDir(found)
    return f"{found.rstrip('/')}/stationflow-{sc.applicationId}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and continue from the files: lineage is cut and the rows are fixed."""
    path = f"{work_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    _staged.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(dim: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting that ``dim`` stays within ``max_rows``.

    A larger side keeps its plain form, so Spark joins by shuffle and AQE splits skewed keys.
    """
    if dim.limit(max_rows + 1).count() > max_rows:
        return dim
    return F.broadcast(dim)


def partitioned_for(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """Hash-partition by ``keys`` into enough parts for ``rows`` rows.

    The number of parts of an ordinary shuffle is a session setting that does not grow with the data. Where
    it suffices, nothing is done here: the operator above shuffles by itself and AQE merges small parts.
    """
    parts = math.ceil(rows / ROWS_PER_PARTITION)
    if parts <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df
    return df.repartition(parts, *keys)


def _filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _filesystem(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _filesystem(spark, path)
    fs.delete(target, True)


def discard_work(spark: SparkSession) -> None:
    """Delete the tables this application staged; frames read from them cannot be used afterwards."""
    delete(spark, work_dir(spark))


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete on leaving what was staged inside; frames read from it are of no use outside."""
    first = len(_staged)
    try:
        yield
    finally:
        for path in _staged[first:]:
            delete(spark, path)
        del _staged[first:]
