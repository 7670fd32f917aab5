from __future__ import annotations

from pyspark.sql import functions as F

from stationflow.spec import SeriesSpec

ROW = SeriesSpec(tiebreak=("row_key",))
CLEAN_DDL = (
    "StationID string, datetime string, Temperature double, DewPoint double, WindDirection double, "
    "WindSpeed double, Pressure double, row_key bigint"
)


def hourly(spark, values, station="A", dew=None, hours=None):
    """Clean rows of one station: temperatures at consecutive (or given) hours of January 2014."""
    hours = hours or range(len(values))
    dew = dew or [v if v is None else v - 5.0 for v in values]
    rows = [
        (station, f"2014-01-{1 + h // 24:02d} {h % 24:02d}:00:00", t, d, 90.0, 3.0, 1000.0, i)
        for i, (h, t, d) in enumerate(zip(hours, values, dew))
    ]
    return spark.createDataFrame(rows, CLEAN_DDL)


def by_key(df, *columns):
    return {r["row_key"]: tuple(r[c] for c in columns) for r in df.select("row_key", *columns).collect()}


def same_rows(one, two) -> bool:
    columns = [F.col(f"`{c}`") for c in sorted(one.columns)]
    a, b = one.select(columns), two.select(columns)
    return one.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
