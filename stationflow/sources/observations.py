"""Observation CSV files, one per station."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.functions.scalars import strip_csv
from stationflow.sources.stations import read_stations, sample_stations, valid_stations
from stationflow.spec import MIN_VALID_SHARE, OBSERVATION_DDL, SEED, STATION_SAMPLE
from stationflow.storage import reach_workers

LISTED_FILES = 20_000
RAW_TYPES = dict(field.split() for field in OBSERVATION_DDL.split(", "))
RAW_COLUMNS = list(RAW_TYPES)


def _station(file_name: str) -> Column:
    """The station a file is named after; Spark gives names of files as parts of a URI."""
    return strip_csv(F.url_decode(F.replace(F.col(file_name), F.lit("+"), F.lit("%2B"))))


def read_observations(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """All observation files of a folder (or of the listed paths) in one scan.

    The station is the file name without ``.csv``. ``row_key`` tells rows of equal time apart: it hashes the
    fields with the file name and nothing else, so it does not depend on how files are listed or cut into input
    splits. Copies of a row share their key; they are interchangeable in a window and fall on one side of a split.
    """
    rows = (
        spark.read.schema(OBSERVATION_DDL)
        .option("header", True)
        .option("enforceSchema", False)
        .option("pathGlobFilter", "*.csv")
        .csv(paths)
    )
    return rows.select(
        _station("_metadata.file_name").alias("StationID"),
        *RAW_COLUMNS,
        F.xxhash64("_metadata.file_name", *RAW_COLUMNS).alias("row_key"),
    )


def _file_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Every line of the observation files with its file and split; many small files are one task.

    A scan deals some megabytes to a file however short it is, so that the driver would keep a task for a few files.
    """
    lines = spark.read.option("pathGlobFilter", "*.csv").text(paths)
    size = int(lines._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    a_task = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    least = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return lines.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("start"),
        (F.col("_metadata.file_block_length") < F.col("_metadata.file_size")).alias("cut"),
        "value",
    ).coalesce(max(least, math.ceil(size / a_task)))


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """Slices of rows of one split of a file, and whether its first line is in them; lines come in the order of files."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        turns = np.zeros(batch.num_rows, dtype=bool)
        for name in ("path", "start"):
            column = batch.column(name)
            turns[1:] |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
        ends = [*np.flatnonzero(turns).tolist(), batch.num_rows]
        for first, end in zip([0, *ends], ends):
            run = batch.slice(first, end - first)
            split = run.column("path")[0].as_py(), run.column("start")[0].as_py()
            yield split != last, run
            last = split


def _line(run: pa.RecordBatch, at: int = 0) -> bytes:
    return run.column("value").cast(pa.binary())[at].as_py()


def file_headers(lines: DataFrame) -> DataFrame:
    """(header, cut) of files that have a line: their first one, and the paths of those files that are in several splits.

    One pass over the text, in which the first split of a file gives a row per task and header; nothing is parsed.
    """

    def read(batches):
        found = {}
        for new, run in _runs(batches):
            if new and run.column("start")[0].as_py() == 0:
                cut = found.setdefault(_line(run), [])
                if run.column("cut")[0].as_py():
                    cut.append(run.column("path")[0].as_py())
        if found:
            columns = [pa.array(found, pa.binary()), pa.array(found.values(), pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, ["header", "cut"])

    reach_workers(lines.sparkSession)
    each = lines.mapInArrow(read, "header binary, cut array<string>")
    return each.groupBy("header").agg(F.flatten(F.collect_list("cut")).alias("cut"))


def _tagged(lines: DataFrame, kinds: dict[bytes, int], cut: dict[str, int]) -> DataFrame:
    """(file_name, kind, value) of every line but headers and blank ones, with the kind of its file's header.

    A line takes it from the header before it in its task, or by the path from ``cut`` in a later split of a file.
    """

    def read(batches):
        kind, inside = None, True
        for new, run in _runs(batches):
            text = run.column("value").cast(pa.binary())
            if new:
                inside = run.column("start")[0].as_py() > 0
                kind = cut[run.column("path")[0].as_py()] if inside else kinds[_line(run)]
            full = pc.match_substring_regex(text, "[^\\x00-\\x20]").to_numpy(zero_copy_only=False)
            if not inside and full.any():
                # The first line that is not blank is what the reader of CSV files skips.
                full = full.copy()
                full[full.argmax()], inside = False, True
            if full.any():
                some = run.select(["file_name", "value"]).filter(pa.array(full))
                tags = pa.array(np.full(some.num_rows, kind, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([some.column(0), tags, some.column(1)], ["file_name", "kind", "value"])

    reach_workers(lines.sparkSession)
    return lines.mapInArrow(lambda batches: _gathered(read(batches)), "file_name string, kind int, value string")


def _gathered(batches: Iterable[pa.RecordBatch], rows: int = 10_000) -> Iterator[pa.RecordBatch]:
    """Few batches of about so many rows in place of many short ones."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def read_mixed_observations(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """As ``read_observations``, for files that do not all have the same header.

    One scan of lines, each parsed with the columns in the order of its file's header. A column that a file lacks is
    null, one that is not an observation column is left out; names are compared without quotes and blanks around them. A
    header that names a column twice raises ``ValueError``, and so does a folder in which no file has a line. Besides
    Spark's list of the files the driver holds different headers and the names of files in several splits.
    """
    lines = _file_lines(spark, paths)
    kinds, cut, schemas = {}, {}, {}
    for row in file_headers(lines).collect():
        header = bytes(row["header"]).decode("utf-8", "replace")
        names = [name.strip().strip('"').strip() for name in header.removeprefix("\ufeff").split(",")]
        known = [name for name in names if name in RAW_TYPES]
        if len(set(known)) < len(known):
            raise ValueError(f"a column comes twice in {header!r}")
        # Columns bind by place; those of no interest get names that cannot clash.
        schema = ", ".join(
            f"{name} {RAW_TYPES[name]}" if name in RAW_TYPES else f"`other {at}` string" for at, name in enumerate(names)
        )
        kind = schemas.setdefault((schema, *sorted(known)), len(schemas))
        kinds[bytes(row["header"])] = kind
        cut.update(dict.fromkeys(row["cut"], kind))
    if not kinds:
        raise ValueError(f"no observation file with a header in {paths}")
    # An array of one row, so that a line is parsed once for all its columns.
    parsed = F.coalesce(*[F.when(F.col("kind") == kind, _rows(schema, known)) for (schema, *known), kind in schemas.items()])
    rows = _tagged(lines, kinds, cut).select("file_name", F.inline(parsed))
    return rows.select(
        _station("file_name").alias("StationID"),
        *RAW_COLUMNS,
        F.xxhash64("file_name", *RAW_COLUMNS).alias("row_key"),
    )


def _rows(schema: str, known: list[str]) -> Column:
    return F.transform(
        F.array(F.from_csv("value", schema)),
        lambda row: F.struct(
            *[(row[name] if name in known else F.lit(None).cast(kind)).alias(name) for name, kind in RAW_TYPES.items()]
        ),
    )


def list_observation_files(spark: SparkSession, folder: str) -> DataFrame:
    """Path and station of every CSV file in a folder; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.csv")
        .load(folder)
        .select("path", strip_csv(F.element_at(F.split("path", "/"), -1)).alias("StationID"))
    )


def missing_files(stations: DataFrame, files: DataFrame) -> DataFrame:
    """Stations that have no observation file."""
    return stations.join(files, "StationID", "left_anti")


def load_observations(
    spark: SparkSession,
    folder: str,
    metadata: str,
    stations: int | None = STATION_SAMPLE,
    minimum: float = MIN_VALID_SHARE,
    seed: int = SEED,
) -> DataFrame:
    """Observations of a seeded sample of valid stations, or of all of them for ``stations=None``.

    Stations without a file are skipped. Only the files of chosen stations are opened while the choice is short
    enough to list; a longer choice reads the folder and keeps its stations by semi join. Rows and keys are equal.
    """
    files = list_observation_files(spark, folder)
    chosen = valid_stations(read_stations(spark, metadata), minimum)
    if stations is not None:
        chosen = sample_stations(chosen, stations, seed)
    found = files.join(chosen, "StationID", "left_semi")
    paths = [row["path"] for row in found.select("path").limit(LISTED_FILES + 1).collect()]
    if not paths:
        raise ValueError(f"no observation file of a chosen station in {folder}")
    if len(paths) <= LISTED_FILES:
        return read_observations(spark, sorted(paths))
    return read_observations(spark, folder).join(chosen, "StationID", "left_semi")
