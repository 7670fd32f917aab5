"""A station feed derived from an event table and a customer table.

Gives observation rows and a station dimension of any size without files of observations: each user is a
station, each event one reading. Some readings carry a bad date, a bad mask or a missing measure.
"""

from __future__ import annotations

import math
import uuid
from itertools import groupby

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.sources.observations import RAW_COLUMNS
from stationflow.spec import SeriesSpec
from stationflow.storage import work_dir

FEED = SeriesSpec(tiebreak=("event_id",))
STATIONS_PER_FILE = 10_000
# The name Spark gives the partition of a missing value.
NO_NAME = "__HIVE_DEFAULT_PARTITION__"
_written: dict[tuple[str, str, str], str] = {}


def observations(spark: SparkSession, folder: str) -> DataFrame:
    """Raw readings with the station name and the event id."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    return events.selectExpr(
        "concat('S', user_id) as StationID",
        "event_id",
        "case when event_id % 101 = 0 then 'not-a-date'"
        " else date_format(ts, 'yyyy-MM-dd HH:mm:ss') end as DATE",
        "value as TMP",
        "case when event_id % 29 = 0 then null"
        " else value - cast((event_id * 37) % 1000 as double) / 100 end as DEW",
        "cast((event_id * 53) % 360 as double) as WND_ANGLE",
        "cast((event_id * 11) % 300 as double) / 10 as WND_RATE",
        "case when event_id % 13 = 0 then null"
        " else 980 + cast((event_id * 7) % 600 as double) / 10 end as SLP",
        "case when event_id % 17 = 0 then '[1 1 0 1 1]' else '[1 1 1 1 1]' end as MASK",
    )


def stations(spark: SparkSession, folder: str) -> DataFrame:
    """One row per station."""
    customers = spark.read.parquet(f"{folder}/customer.parquet")
    return customers.selectExpr(
        "concat('S', c_custkey) as StationID",
        "cast((c_custkey * 37) % 181 - 90 as double) as latitude",
        "cast((c_custkey * 73) % 361 - 180 as double) as longitude",
        "c_acctbal as ELEVATION",
        "0.5D + cast((c_custkey * 7) % 51 as double) / 100 as valid_percent",
    )


def write_station_files(spark: SparkSession, folder: str) -> tuple[str, str]:
    """The feed as files in the layout the readers expect: (CSV folder, metadata folder).

    Written once per application and source folder, below the shared work folder.
    """
    return write_observation_files(spark, folder), write_metadata_files(spark, folder)


def _readings(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the observation files, and the station as ``name``."""
    placed = {"LONGITUDE": F.col("longitude"), "LATITUDE": F.col("latitude"), "TIME_DIFF": F.lit(None).cast("double")}
    rows = observations(spark, folder).join(stations(spark, folder), "StationID", "left")
    return rows.select(F.col("StationID").alias("name"), *[placed.get(c, F.col(c)).alias(c) for c in RAW_COLUMNS])


def write_observation_files(spark: SparkSession, folder: str) -> str:
    """One CSV file per station, as the input format asks for."""
    key = (spark.sparkContext.applicationId, folder, "csv")
    if key in _written:
        return _written[key]
    csv = f"{work_dir(spark)}/files-{uuid.uuid4().hex}/csv"
    _write_station_csv(_readings(spark, folder), RAW_COLUMNS, csv)
    _written[key] = csv
    return csv


def write_mixed_files(spark: SparkSession, folder: str) -> str:
    """One CSV file per station, with three kinds of header: the usual one, its columns turned round, and one without
    pressure and wind speed but with a column more."""
    root = f"{work_dir(spark)}/files-{uuid.uuid4().hex}"
    kind = F.pmod(F.substring("name", 2, 18).cast("bigint"), F.lit(3))
    rows = _readings(spark, folder).withColumns({"kind": kind, "NOTE": F.lit("x")})
    fewer = [c for c in RAW_COLUMNS if c not in ("SLP", "WND_RATE")]
    for at, columns in enumerate((RAW_COLUMNS, RAW_COLUMNS[::-1], ["NOTE", *fewer])):
        _write_station_csv(rows.where(F.col("kind") == at), columns, f"{root}/csv")
    return f"{root}/csv"


def write_metadata_files(spark: SparkSession, folder: str) -> str:
    """The station dimension as metadata files, one object in each; no observation is read."""
    key = (spark.sparkContext.applicationId, folder, "meta")
    if key in _written:
        return _written[key]
    meta = f"{work_dir(spark)}/files-{uuid.uuid4().hex}/meta"
    dim = stations(spark, folder)
    files = max(1, math.ceil(dim.count() / STATIONS_PER_FILE))
    info = F.struct("latitude", "longitude", "ELEVATION", "valid_percent")
    (
        dim.groupBy(F.pmod(F.xxhash64("StationID"), F.lit(files)).alias("part"))
        .agg(F.map_from_entries(F.collect_list(F.struct(F.concat("StationID", F.lit(".csv")), info))).alias("m"))
        .select("part", F.to_json("m").alias("value"))
        .write.partitionBy("part")  # one object per file
        .text(meta)
    )
    _written[key] = meta
    return meta


def _write_station_csv(rows: DataFrame, columns: list[str], folder: str) -> None:
    """A file ``<name>.csv`` with a header for each ``name`` of ``rows``, below ``folder``.

    One file per station is the input format itself, so the rows of a station meet in one writer. Spark makes the
    lines, and each task writes the files of its stations under their last names. A partitioned write names them itself:
    its commit and a renaming take the driver several calls a file, one after the other.
    """
    spark = rows.sparkSession
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(folder)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(target)
    uri = files.makeQualified(target).toUri()
    place = uri.getPath() if uri.getScheme() == "file" else uri.toString()
    header = ",".join(columns) + "\n"

    def write(batches):
        store, base = (fs.LocalFileSystem(), place) if place.startswith("/") else fs.FileSystem.from_uri(place)
        name, out, part, number = None, None, None, 0

        def close():
            if out is not None:
                out.close()
                # A repeated or second attempt writes the same rows under a name of its own first.
                store.move(part, f"{base}/{name}.csv")

        for batch in batches:
            names, lines = batch.column("name").to_pylist(), batch.column("line").to_pylist()
            for key, group in groupby(zip(names, lines), key=lambda pair: pair[0]):
                if key != name or out is None:
                    close()
                    name, part, number = key, f"{base}/_{uuid.uuid4().hex}", number + 1
                    out = store.open_output_stream(part)
                    out.write(header.encode())
                out.write("".join(f"{line}\n" for _, line in group).encode())
        close()
        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64())], ["files"])

    named = F.coalesce("name", F.lit(NO_NAME)).alias("name")
    lines = rows.select(named, F.to_csv(F.struct(*columns)).alias("line")).repartition("name").sortWithinPartitions("name")
    lines.mapInArrow(write, "files long").agg(F.sum("files")).collect()
