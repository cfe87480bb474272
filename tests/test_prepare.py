"""Exact ranks, splits, samples and scaling."""

from __future__ import annotations

import datetime as dt
import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.functions import ranks
from tallyloom.operators import complaints as C
from tallyloom.operators import prepare as P

PROBABILITIES = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


def values(kind, n, rng):
    if kind == "spread":
        return [rng.gauss(0, 100) for _ in range(n)]
    if kind == "ties":
        return [float(rng.choice([1, 1, 1, 2, 3, 50])) for _ in range(n)]
    return [7.0] * n


@pytest.mark.parametrize("accuracy", [10_000, 20, 1])
@pytest.mark.parametrize("kind", ["spread", "ties", "constant"])
def test_quantiles_whatever_the_sketch(spark, monkeypatch, kind, accuracy):
    monkeypatch.setattr(ranks, "SKETCH_ACCURACY", accuracy)
    rng = random.Random(5)
    groups = {"hot": values(kind, 3000, rng), "few": values(kind, 3, rng), "one": values(kind, 1, rng), "mid": values(kind, 400, rng)}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("hot", None), (None, 1.0)]
    frame = spark.createDataFrame(rows, "g string, v double").repartition(7)
    found = {r["g"]: r for r in ranks.exact_quantiles(frame, "v", PROBABILITIES, ["g"]).collect()}
    assert set(found) == set(groups)
    for name, vs in groups.items():
        assert found[name]["n"] == len(vs)
        assert found[name]["q"] == pytest.approx(list(np.quantile(vs, PROBABILITIES)), abs=1e-9)
    whole = ranks.exact_quantiles(frame.where("g = 'hot'"), "v", PROBABILITIES).first()
    assert whole["q"] == pytest.approx(list(np.quantile(groups["hot"], PROBABILITIES)), abs=1e-9)


def test_sketch_that_misses_is_corrected(spark, monkeypatch):
    """Brackets that lie wholly beside the rank still give the exact value."""
    real = F.percentile_approx
    monkeypatch.setattr(ranks.F, "percentile_approx", lambda c, ps, a: real(c, [0.9 for _ in ps], a))
    frame = spark.createDataFrame([(float(v),) for v in range(1001)], "v double")
    assert ranks.exact_quantiles(frame, "v", [0.25, 0.5, 0.95]).first()["q"] == pytest.approx([250.0, 500.0, 950.0])


def test_no_values_no_quantiles(spark):
    frame = spark.createDataFrame([(None,)], "v double")
    assert P.impute_median(frame, "v").first()["v"] is None


def test_cut_finds_the_kth_key(spark):
    keys = [hashlib.md5(str(n).encode()).hexdigest() for n in range(500)]
    frame = spark.createDataFrame([(k,) for k in keys] * 2, "k string")
    for k in (1, 2, 499, 500, 1000):
        row = ranks.ordered_cut(frame, "k", F.lit(k), first=1, most=2).first()
        assert row["cut_key"] == sorted(keys * 2)[k - 1]
        assert row["copies_wanted"] == (k - 1) % 2 + 1


def test_sample_size_is_exact_with_copies(spark):
    frame = spark.createDataFrame([("same", 1)] * 700 + [(f"n{i}", i) for i in range(1300)], "t string, v int")
    sample = P.hash_sample(frame, 0.05).collect()
    assert len(sample) == 100
    assert not Counter(map(tuple, sample)) - Counter(map(tuple, frame.collect()))
    assert sorted(map(tuple, P.hash_sample(frame.repartition(3), 0.05).collect())) == sorted(map(tuple, sample))
    tied = spark.createDataFrame([("k", n % 7) for n in range(200)], "t string, v int")
    assert P.hash_sample(tied, 0.3, ["t"]).count() == 60
    copies = spark.createDataFrame([("same", 1)] * 200, "t string, v int")
    assert P.hash_sample(copies, 0.05).count() == 10
    assert P.hash_sample(copies.limit(0), 0.05).count() == 0


def test_chronological_split_keeps_time_order(spark):
    rng = random.Random(8)
    rows = [(f"o{n}", dt.date(2020, 1, 1) + dt.timedelta(days=rng.choice([0, 1, 2, 2, 2, 2, 3]))) for n in range(333)]
    split = P.chronological_split(spark.createDataFrame(rows, "order_id string, day date"), "day", "order_id").collect()
    train, test = [r for r in split if r["is_train"]], [r for r in split if not r["is_train"]]
    assert len(train) == int(333 * 0.8) and max(r["day"] for r in train) <= min(r["day"] for r in test)


def test_stratified_split_keeps_shares(spark):
    rows = [(n, "big" if n % 3 else ("mid" if n % 2 else "small")) for n in range(600)]
    split = P.stratified_split(spark.createDataFrame(rows, "id long, label string"), "label", "id").collect()
    sizes, tests = Counter(r["label"] for r in split), Counter(r["label"] for r in split if r["is_test"])
    assert {k: round(n * 0.2) for k, n in sizes.items()} == tests


def test_constant_columns_do_not_divide_by_zero(spark):
    frame = spark.createDataFrame([(3.0, 1.0), (3.0, 2.0)], "c double, v double")
    assert [r["c_scaled"] for r in P.min_max_scale(frame, ["c", "v"]).collect()] == [0.0, 0.0]
    assert [r["c"] for r in P.zscore(frame, ["c", "v"]).collect()] == [0.0, 0.0]
    assert sorted(r["v"] for r in P.zscore(frame, ["c", "v"]).collect()) == [-1.0, 1.0]


def test_bins_with_equal_edges_merge(spark):
    frame = spark.createDataFrame([(1.0,)] * 8 + [(2.0,), (3.0,)], "v double")
    found = {r["v"]: (r["v_bin"], r["v_smoothed"]) for r in P.smooth_by_bin_mean(frame, "v").collect()}
    assert found[1.0][1] == 1.0 and found[2.0][0] < found[3.0][0] and found[3.0][1] == 3.0


def test_levels_are_bounded(spark):
    frame = spark.range(50).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError):
        P.levels_of(frame, ["c"], most=10)
    assert len(P.levels_of(frame, ["c"], most=50)["c"]) == 50


def test_box_and_histogram(spark):
    rows = [("a", float(v)) for v in [*range(1, 12), 100]] + [("b", 5.0)]
    frame = spark.createDataFrame(rows, "g string, v double")
    box = {r["g"]: r for r in C.box_stats(frame, "g", "v").collect()}
    assert (box["a"]["median"], box["a"]["whisker_high"], box["a"]["outliers"]) == (6.5, 11.0, 1)
    assert (box["b"]["q1"], box["b"]["whisker_low"], box["b"]["outliers"]) == (5.0, 5.0, 0)
    data = [v for g, v in rows if g == "a"]
    bins = C.rating_histogram(frame.where("g = 'a'"), "v").orderBy("bin").collect()
    counts, edges = np.histogram(data, bins=5)
    assert [b["reviews"] for b in bins] == list(counts) and [b["low"] for b in bins] == pytest.approx(list(edges[:-1]))
    single = C.rating_histogram(frame.where("g = 'b'"), "v").orderBy("bin").collect()
    assert [b["reviews"] for b in single] == list(np.histogram([5.0], bins=5)[0])


def test_splits_are_exact_when_keys_repeat(spark):
    rows = [("a" if n % 4 else "b", n % 7, n % 3, "2020-01-0" + str(1 + n % 5)) for n in range(100)]
    frame = spark.createDataFrame(rows, "label string, key int, other int, day string").withColumn("day", F.to_date("day"))
    marked = P.stratified_split(frame, "label", "key", 0.2)
    counts = {r["label"]: (r["n"], r["t"]) for r in marked.groupBy("label").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect()}
    assert counts == {"a": (75, 15), "b": (25, 5)}
    split = P.chronological_split(frame, "day", "key", 0.8)
    assert split.where("is_train").count() == 80 and split.count() == 100
    assert split.where("is_train").agg(F.max("day")).first()[0] <= split.where("not is_train").agg(F.min("day")).first()[0]
    alike = spark.createDataFrame([("x", 1)] * 30, "label string, key int")
    assert P.stratified_split(alike, "label", "key", 0.2).where("is_test").count() == 6


def test_quantiles_narrow_in_several_rounds(spark):
    values = [float(n * n % 10007) for n in range(9000)] + [5.0] * 3000
    frame = spark.createDataFrame([(g, v) for g in ("p", "q") for v in values], "g string, v double")
    found = {r["g"]: r["q"] for r in ranks.exact_quantiles(frame, "v", [0.1, 0.5, 0.9], ["g"], most=3).collect()}
    wanted = [float(x) for x in np.quantile(values, [0.1, 0.5, 0.9])]
    assert found["p"] == pytest.approx(wanted) and found["q"] == pytest.approx(wanted)


def test_labels_of_many_classes(spark):
    frame = spark.range(2500).select(F.format_string("c%05d", "id").alias("c"))
    coded = P.label_encode(frame, "c", "code")
    assert coded.where(F.col("code") != F.substring("c", 2, 5).cast("int")).count() == 0 and coded.count() == 2500
