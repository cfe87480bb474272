"""Baskets, rules, sequences and customer features against plain counting."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter, defaultdict
from itertools import combinations

import pytest
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import functions as F

from tallyloom.operators import baskets as B
from tallyloom.operators import customers as K
from tallyloom.operators import rules as U
from tallyloom.operators import sequences as Q


def orders(seed=1):
    rng = random.Random(seed)
    items = [f"i{n:02d}" for n in range(25)]
    rows = []
    for order in range(80):
        for item in rng.choices(items, weights=range(1, 26), k=rng.choice([1, 1, 2, 3, 4, 6])):
            rows.append((f"o{order}", item))
    for big in range(3):  # orders that hold most items
        rows += [(f"big{big}", item) for item in items if rng.random() < 0.8] * 2
    rows += [("hot", f"only{n}") for n in range(150)]  # one order with a third of all rows
    rows += [("o1", None), (None, "i01")]
    return rows


def counted(rows, least):
    held = defaultdict(set)
    for order, item in rows:
        if order and item:
            held[order].add(item)
    held = {o: sorted(s) for o, s in held.items() if len(s) >= 2}
    items, pairs, triples = Counter(), Counter(), Counter()
    for s in held.values():
        items.update(s)
        pairs.update(combinations(s, 2))
        triples.update(combinations(s, 3))
    keep = lambda c: {k: n for k, n in c.items() if n >= least(len(held))}
    return held, items, keep(pairs), keep(triples)


@pytest.fixture(scope="module")
def rows(spark):
    data = orders()
    return data, B.baskets(spark.createDataFrame(data, "o string, i string"), "o", "i").persist()


@pytest.mark.parametrize("wide", [2, 4, 10, 1000])
@pytest.mark.parametrize("support", [0.0, 0.06])
def test_itemsets_at_any_order_width(rows, wide, support):
    data, baskets = rows
    held, items, pairs, triples = counted(data, lambda n: max(2, int(n * support)))
    n = len(held)
    found = {(r["item_a"], r["item_b"]): r for r in B.frequent_pairs(baskets, support, wide).collect()}
    assert {k: r["orders_together"] for k, r in found.items()} == pairs
    for (a, b), r in found.items():
        assert r["support"] == pytest.approx(pairs[a, b] / n)
        assert r["confidence_a_to_b"] == pytest.approx(pairs[a, b] / items[a])
        assert r["support"] <= min(r["confidence_a_to_b"], r["confidence_b_to_a"]) + 1e-12
        assert r["lift"] == pytest.approx(pairs[a, b] * n / items[a] / items[b])
    found = B.frequent_triples(baskets, support, wide).collect()
    assert {(r["item_1"], r["item_2"], r["item_3"]): r["orders_together"] for r in found} == triples


def test_baskets_leave_out_single_items(spark):
    frame = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "x"), ("b", "y"), ("b", "x")], "o string, i string")
    found = sorted(tuple(r) for r in B.baskets(frame, "o", "i").collect())
    assert found == [("b", "x", 2), ("b", "y", 2)]


def test_same_sets_as_fp_growth(rows):
    _, baskets = rows
    n, _ = B._profile(baskets, 500)
    lists = baskets.groupBy("order_id").agg(F.collect_list("item").alias("items"))
    least = B.min_count(n, 0.1)
    model = FPGrowth(itemsCol="items", minSupport=least / n).fit(lists)
    expected = {tuple(sorted(r["items"])): r["freq"] for r in model.freqItemsets.where(F.size("items") == 2).collect()}
    found = {(r["item_a"], r["item_b"]): r["orders_together"] for r in B.frequent_pairs(baskets, 0.1).collect()}
    assert found == expected


def test_top_n_breaks_ties_by_name(spark):
    frame = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2)], "k string, n int")
    assert [r["k"] for r in B.top_n(frame, ["n"], ["k"], 2).collect()] == ["c", "a"]


def test_rules_drop_missing_keys_and_small_groups(spark):
    rows = [("a", "p", True)] * 3 + [("a", None, False)] * 2 + [("b", "p", False)] * 4 + [("c", "q", False)]
    frame = spark.createDataFrame(rows, "category string, discount_band string, is_loss boolean").select(
        "*",
        F.lit(1).cast("decimal(15,4)").alias("sales"),
        F.lit(1).cast("decimal(15,4)").alias("profit"),
        F.lit(0).cast("decimal(15,4)").alias("discount"),
        F.lit(0.5).alias("profit_margin"),
    )
    sets = [("category",), ("discount_band",), ("discount_band", "category")]
    found = {r["if_condition"]: r for r in U.decision_rules(frame, sets, min_rows=2).collect()}
    assert set(found) == {
        "category = a", "category = b", "discount_band = p", "discount_band = p AND category = a", "discount_band = p AND category = b",
    }
    sure = found["discount_band = p AND category = a"]
    assert (sure["then_decision"], sure["confidence"], sure["support_rows"]) == (U.REVIEW, 1.0, 3)
    assert sure["lift_vs_baseline"] == pytest.approx(1 / 0.3)
    good = found["category = b"]
    assert (good["then_decision"], good["confidence"]) == (U.PROMOTE, 1.0)
    assert good["lift_vs_baseline"] == pytest.approx(1 / 0.7) and good["support_pct"] == pytest.approx(0.4)


def test_sequences_with_one_customer_holding_most_orders(spark):
    rng = random.Random(3)
    rows = []
    for n in range(400):
        who = "guest" if n < 250 else f"c{n % 23}"
        day = dt.date(2020, 1, 1) + dt.timedelta(days=rng.choice([0, 0, 0, 1, 2, 5, rng.randrange(60)]))
        for item in rng.choices("dcbae", k=rng.choice([1, 2, 4, 7])):
            rows.append((who, f"o{n:03d}", day, item))
    rows += [(None, "o999", dt.date(2020, 1, 1), "a"), ("guest", "o998", None, "a")]
    frame = spark.createDataFrame(rows, "customer string, oid string, day date, item string")
    baskets = defaultdict(set)
    for who, order, day, item in rows:
        if who and day:
            baskets[who, day, order].add(item)
    lanes = defaultdict(list)
    for (who, day, order), items in sorted(baskets.items()):
        lanes[who].append(" + ".join(sorted(items)[:3]))
    pairs, triples = Counter(), Counter()
    for states in lanes.values():
        pairs.update(zip(states, states[1:]))
        triples.update(zip(states, states[1:], states[2:]))
    steps = Q.next_step(Q.order_sequences(frame, "customer", "oid", "day", "item"))
    assert steps.count() == len(baskets)
    found = Q.transitions(steps).collect()
    assert {(r["from"], r["to"]): r["times_seen"] for r in found} == pairs
    shares = defaultdict(float)
    for r in found:
        shares[r["from"]] += r["probability_next"]
    assert all(v == pytest.approx(1.0) for v in shares.values())
    found = Q.three_step_patterns(steps).collect()
    assert {(r["step_1"], r["step_2"], r["step_3"]): r["times_seen"] for r in found} == triples


def test_cluster_labels(spark):
    rows = [(0, -0.1, 9.0, 10.0, 900.0), (1, 0.1, 8.0, 180.0, 1.0), (2, 0.1, 7.0, 10.0, 800.0), (3, 0.0, 9.0, 181.0, 799.0)]
    summary = spark.createDataFrame(
        rows, "cluster int, avg_profit_margin double, avg_orders double, avg_recency_days double, avg_order_value double"
    )
    labels = [r["business_label"].split(" ")[0] for r in K.cluster_label(summary).orderBy("cluster").collect()]
    assert labels == ["Loss-making", "Loyal", "High-value", "Standard"]
