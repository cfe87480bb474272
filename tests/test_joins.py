"""Joins with split keys equal plain joins, and no part holds much more than its share."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tallyloom.functions.joins import split_join


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(4)
    keys = ["hot"] * 3000 + [f"k{rng.randrange(200)}" for _ in range(5000)] + [None] * 300 + ["alone"] * 900
    many = [(k, i % 3, i // 2) for i, k in enumerate(keys)]  # rows repeat
    few = [("hot", 0, "a"), ("hot", 1, "b"), ("hot", 1, "c"), (None, 0, "n"), ("absent", 0, "x")]
    few += [(f"k{i}", i % 3, f"v{i}") for i in range(0, 200, 2)]
    return (
        spark.createDataFrame(many, "k string, s int, n int").repartition(7).persist(),
        spark.createDataFrame(few, "k string, s int, v string").persist(),
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("keys", [["k"], ["k", "s"]])
@pytest.mark.parametrize("hot_rows", [20, 500, 1_000_000])
def test_rows_are_those_of_the_plain_join(sides, how, keys, hot_rows):
    many, few = sides
    few = few if len(keys) == 2 else few.drop("s")
    plain, split = many.join(few, keys, how), split_join(many, few, keys, how, hot_rows=hot_rows)
    assert plain.columns == split.columns
    rows = [sorted((tuple(r) for r in df.collect()), key=repr) for df in (plain, split)]
    assert rows[0] == rows[1] and rows[0]


def test_a_hot_key_is_dealt_over_tasks(spark, sides):
    many, few = sides
    few = few.drop("s").dropDuplicates(["k"])
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)

        def largest(joined):
            return joined.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

        hot = many.where("k in ('hot', 'alone')")
        counts = many.groupBy("k").agg(F.count("*").alias("_n"))
        assert largest(hot.join(few, ["k"])) == 3000
        assert largest(split_join(hot, few, ["k"], counts=counts, hot_rows=100)) < 1000
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_other_joins_are_refused(sides):
    with pytest.raises(ValueError, match="not split"):
        split_join(*sides, ["k"], "full")


def test_no_rows(sides):
    many, few = sides
    assert split_join(many.limit(0), few.drop("s"), ["k"]).count() == 0
    assert split_join(many, few.drop("s").limit(0), ["k"], "left", hot_rows=10).count() == many.count()
