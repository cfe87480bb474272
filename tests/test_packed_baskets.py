"""Baskets are counted row by row: the pairs of every order are not shuffled."""

from __future__ import annotations

from itertools import combinations

from tallyloom.operators import baskets as B


def test_orders_are_not_joined_with_themselves(spark):
    orders = {f"o{n}": [f"i{k}" for k in range(1, 8) if (n * k + n // 3) % 3] for n in range(40)}
    orders["same"] = ["i1", "i1"]
    frame = spark.createDataFrame([(o, i) for o, items in orders.items() for i in items], "o string, i string")
    rows = B.baskets(frame, "o", "i")
    packed, wide = B._kept(rows, B.item_supports(rows), 1, 500)
    assert packed.columns == ["items"] and wide.count() == 0
    sets = [sorted({*items}) for items in orders.values() if len({*items}) > 1]
    assert sorted(r["items"] for r in packed.collect()) == sorted(sets)
    pairs = B._count_pairs(packed, wide, 3, 0)
    assert "Join" not in pairs._jdf.queryExecution().optimizedPlan().toString()
    total = len(sets)
    for size, found in ((2, B.frequent_pairs(rows, 0.3)), (3, B.frequent_triples(rows, 0.3))):
        least = B.min_count(total, 0.3)
        expected = {}
        for items in sets:
            for group in combinations(items, size):
                expected[group] = expected.get(group, 0) + 1
        expected = {group: n for group, n in expected.items() if n >= least}
        assert {tuple(r)[:size]: r["orders_together"] for r in found.collect()} == expected and expected
