import statistics

import pytest
from pyspark.sql import functions as F

from stationflow.operators.impute import approximate_medians, exact_medians, fill_missing

CASES = {
    "spread": "pmod(xxhash64(id), 1000003) / 7D",
    "ties": "case when id % 3 = 0 then 5D else cast(id as double) end",
    "two_heaps": "case when id % 2 = 0 then id * 1e-9D else 1e9D + id end",
    "constant": "4D",
    "signs": "power(-1D, id) * id",
}


@pytest.mark.parametrize("count, limit", [(1, 1), (2, 1), (999, 3), (5000, 50), (5000, 1_000_000)])
def test_medians_are_exact_whatever_the_distinct_limit(spark, count, limit):
    rows = spark.range(count).selectExpr(*[f"cast({v} as double) as {c}" for c, v in CASES.items()])
    found = exact_medians(rows, list(CASES), max_distinct=limit)
    pdf = rows.toPandas()
    for c in CASES:
        assert found[c] == pytest.approx(statistics.median(pdf[c]), rel=1e-12), c


def test_missing_values_do_not_count(spark):
    rows = spark.createDataFrame([(1.0, None), (float("nan"), None), (None, None), (3.0, None)], "a double, b double")
    medians = exact_medians(rows, ["a", "b"])
    assert medians == {"a": 2.0}
    assert exact_medians(rows, ["a", "b"], max_distinct=0) == {"a": 2.0}
    assert [tuple(r) for r in fill_missing(rows, medians).collect()] == [(1.0, None), (2.0, None), (2.0, None), (3.0, None)]


def test_approximate_medians_are_close(spark):
    rows = spark.range(10_000).select(F.col("id").cast("double").alias("a"), F.lit(None).cast("double").alias("b"))
    found = approximate_medians(rows, ["a", "b"])
    assert set(found) == {"a"} and abs(found["a"] - 5000) <= 501
