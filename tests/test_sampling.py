import hashlib

import pytest
from pyspark.sql import functions as F

from helpers import ROW, same_rows
from stationflow.operators import sampling as sp


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(3000).select(
        F.concat(F.lit("S"), F.col("id") % 7).alias("StationID"),
        F.col("id").alias("row_key"),
        F.when(F.col("id") % 5 != 0, F.col("id") / 3).alias("value"),
    )


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_split_does_not_depend_on_the_partitioning(rows, partitions):
    train, test = sp.split_rows(rows, ROW)
    again, other = sp.split_rows(rows.repartition(partitions), ROW)
    assert same_rows(train, again) and same_rows(test, other)
    assert train.count() + test.count() == 3000 and train.intersect(test).isEmpty()
    assert 0.15 < test.count() / 3000 < 0.25


def test_seed_and_share_change_the_split(rows):
    _, test = sp.split_rows(rows, ROW)
    _, seeded = sp.split_rows(rows, ROW, seed=7)
    _, half = sp.split_rows(rows, ROW, test_share=0.5)
    assert not same_rows(test, seeded)
    assert 0.45 < half.count() / 3000 < 0.55 and test.exceptAll(half).isEmpty()


def test_random_split_is_complete(rows):
    train, test = sp.random_split(rows)
    assert train.count() + test.count() == 3000


@pytest.mark.parametrize("count", [0, 1, 100, 2399, 2400, 9000])
def test_capped_sample_is_the_smallest_hashes(rows, count):
    def digest(r):
        return hashlib.md5(f"{r['StationID']}|{r['row_key']}".encode()).hexdigest()

    expected = sorted((r for r in rows.collect() if r["value"] is not None), key=digest)[:count]
    found = sp.capped_sample(rows, "value", ROW.row_id(), count).collect()
    assert sorted(r["row_key"] for r in found) == sorted(r["row_key"] for r in expected)


def test_placement(rows):
    train, test = sp.placed(*sp.split_rows(rows, ROW), partitions=40)
    assert (train.rdd.getNumPartitions(), test.rdd.getNumPartitions()) == (40, 10)


def test_split_sizes(rows):
    found = {r["split"]: (r["rows"], r["percent"]) for r in sp.split_sizes(sp.with_split(rows, ROW)).collect()}
    assert found["train"][0] + found["test"][0] == 3000
    assert found["train"][1] + found["test"][1] == pytest.approx(100.0)
