"""Positions by ranges against a plain window."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlark.plans.ranged import ranks_by_range


def plain(df, keys, order):
    return df.withColumn("pos", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("bigint"))


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.select(a.columns).collect()))


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_hot_key_null_keys_and_equal_values(spark, partitions):
    i = F.col("id")
    df = spark.range(4000).select(
        F.when(i % 3 == 0, "hot").when(i % 41 == 0, None).otherwise((i % 300).cast("string")).alias("k"),
        F.when(i % 17 == 0, None).otherwise(i % 5).alias("v"),
        "id",
    )
    order = [F.desc("v"), F.asc("id")]
    got = ranks_by_range(df, ["k"], order, "pos", partitions)
    assert same(got, plain(df, ["k"], order))
    assert dict(got.dtypes)["pos"] == "bigint"


def test_hot_key_is_cut(spark):
    """One key with all rows, one value for all: every range gets a share of it."""
    df = spark.range(0, 20_000, 1, 8).select(F.lit("k").alias("k"), F.lit(1.0).alias("v"), "id")
    got = ranks_by_range(df, ["k"], [F.desc("v"), F.asc("id")], "pos", 8)
    sizes = [spark.read.parquet(f).count() for f in got.inputFiles()]
    assert sum(sizes) == 20_000 and len(sizes) >= 6 and max(sizes) < 6_000
    assert got.filter(F.col("pos") != F.col("id") + 1).count() == 0


def test_several_keys_no_key_and_no_rows(spark):
    i = F.col("id")
    df = spark.range(500).select((i % 3).alias("a"), (i % 2).cast("string").alias("b"), "id", F.lit(0).alias("pos"))
    got = ranks_by_range(df, ["a", "b"], [F.desc("id")], "pos", 4)
    assert same(got, plain(df.drop("pos"), ["a", "b"], [F.desc("id")]))
    assert same(ranks_by_range(df, [], [F.desc("id")], "pos", 4), plain(df.drop("pos"), [], [F.desc("id")]))
    assert ranks_by_range(df.limit(0), ["a"], [F.asc("id")], "pos").count() == 0
