"""Both cuts of a run from one pass, against the two cuts one after the other."""

import random

import pytest
from pyspark.sql import functions as F

from abode.operators import churn


def one_by_one(table, s1, p1, s2, p2):
    first = churn.sample_cut(table, s1, p1)
    return first, churn.sample_cut(table.filter(~first.predicate()), s2, p2)


@pytest.mark.parametrize(
    "n, p1, p2",
    [(0, "0.02", "0.02"), (1, "0.6", "0.5"), (25, "0.02", "0.03"), (49, "0.03", "0.03"), (75, "0.01", "0.03"), (300, "0", "0.03"),
     (300, "0.03", "0"), (300, "0.6", "0.5"), (300, "1", "0.5"), (20_000, "0.01", "0.03"), (20_000, "0.02", "0.02")],
)
def test_same_cuts(spark, n, p1, p2):
    table = spark.range(n).selectExpr("id * 3 + 1 as listing_id", "id as x")
    assert churn.churn_cuts(table, 88, p1, 89, p2) == one_by_one(table, 88, p1, 89, p2)


def test_a_sample_beyond_its_candidates_is_cut_from_the_table(spark, monkeypatch):
    monkeypatch.setattr(churn, "CANDIDATE_MARGIN", 0)
    table = spark.range(500).withColumnRenamed("id", "listing_id")
    assert churn.churn_cuts(table, 1, "0.05", 2, "0.05") == one_by_one(table, 1, "0.05", 2, "0.05")


def test_null_and_repeated_keys(spark):
    table = spark.createDataFrame([(i if i % 3 else None,) for i in range(300)], "listing_id long")
    for seeds in random.Random(1).sample(range(100), 4):
        got = churn.churn_cuts(table, seeds, "0.03", seeds + 1, "0.02")
        assert got == one_by_one(table, seeds, "0.03", seeds + 1, "0.02")
    twice = spark.range(300).withColumnRenamed("id", "listing_id")
    with pytest.raises(ValueError, match="occurs 2 times"):
        churn.churn_cuts(twice.unionByName(twice), 1, "0.6", 2, "0.02")


def test_the_table_is_read_once(spark, scratch):
    """Rows the scans of the table put out, as a counter in the plan's data sees them."""
    path = scratch("keys")
    spark.range(50_000).withColumnRenamed("id", "listing_id").write.parquet(path)
    read = spark.sparkContext.accumulator(0)
    count = F.udf(lambda i: (read.add(1), i)[1], "bigint").asNondeterministic()
    table = spark.read.parquet(path).select(count("listing_id").alias("listing_id"))
    churn.churn_cuts(table, 88, "0.02", 89, "0.02")
    assert read.value == 50_000
    read.value = 0
    one_by_one(table, 88, "0.02", 89, "0.02")
    assert read.value >= 4 * 50_000
