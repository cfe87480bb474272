"""Stored roll-ups against the flat rows, in every direction, grown by batches, with quantiles within their bound."""

from __future__ import annotations

import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import olap as O
from tallyloom.operators import rollups as L

WANTED = {
    "places": L.Wanted(("year", "country", "state")),
    "countries": L.Wanted(("country",)),
    "years": L.Wanted(("year",)),
    "days": L.Wanted(("day", "kind"), ("amount",)),
    "kinds": L.Wanted(("kind",), ("amount",)),
}
SCHEMA = "year int, country string, state string, day int, kind string, amount decimal(15,4), pieces int"


def flat_rows(count=3000, seed=3):
    rng = random.Random(seed)
    rows = []
    for n in range(count):
        country = None if rng.random() < 0.02 else f"c{0 if n % 3 == 0 else rng.randrange(6)}"
        amount = None if rng.random() < 0.05 else Decimal(str(round(rng.paretovariate(0.7), 4)))
        kind = "empty" if n % 500 == 7 else f"k{rng.randrange(3)}"
        rows.append((1990 + n % 4, country, f"s{rng.randrange(20)}", n % 30, kind, None if kind == "empty" else amount, n % 7))
    return rows


@pytest.fixture(scope="module")
def flat(spark):
    return spark.createDataFrame(flat_rows(), SCHEMA).persist()


@pytest.fixture(scope="module")
def built(flat, tmp_path_factory):
    return L.build_rollups(lambda _: flat, WANTED, ["amount", "pieces"], str(tmp_path_factory.mktemp("rollups")))


def as_set(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def test_a_grouping_is_made_from_the_smallest_that_holds_it(built):
    assert {name: g.source for name, g in built.groupings.items()} == {
        "places": None, "countries": "places", "years": "places", "days": None, "kinds": "days",
    }
    assert built.holding(["country"]) == "countries"
    assert built.holding(["country", "year"]) == "places"
    assert built.holding(["kind"], ["amount"]) == "kinds"
    assert built.holding(["kind", "country"]) is None


@pytest.mark.parametrize("keys", [["year"], ["country"], ["year", "country"], ["country", "state"], ["kind"], []])
def test_parts_equal_those_of_the_rows(built, flat, keys):
    asked = {
        "n": L.lines(), "total": L.total("amount"), "known": L.values("amount"), "low": L.least("amount"),
        "high": L.most("amount"), "pieces": L.total("pieces"), "mean": F.round(L.mean("amount"), 6),
    }
    direct = flat.groupBy(*keys).agg(
        F.count("*"), F.sum("amount"), F.count("amount"), F.min("amount"), F.max("amount"), F.sum("pieces"),
        F.round(F.try_divide(F.sum("amount").cast("double"), F.count("amount").cast("double")), 6),
    )
    assert as_set(L.answer(built, keys, asked)) == as_set(direct)


def test_selections_choose_a_grouping_that_holds_them(built, flat):
    found = L.answer(built, ["country"], {"total": L.total("amount")}, {"year": [1990, 1992], "state": None})
    assert as_set(found) == as_set(flat.where("year in (1990, 1992)").groupBy("country").agg(F.sum("amount")))
    assert as_set(L.answer(built, ["country"], {"n": L.lines()}, {"year": []})) == []


def test_a_question_no_grouping_holds_is_an_error(built):
    with pytest.raises(ValueError, match="kind"):
        L.answer(built, ["kind", "country"], {"n": L.lines()})
    with pytest.raises(ValueError, match="sketches"):
        L.answer(built, ["country"], {"q": L.quantile("amount", 0.5)}, sketches=["amount"])


def test_drilling_and_hierarchies_read_no_flat_row(built, flat):
    levels = ["year", "country", "state"]
    rows = L.as_flat(built, levels)
    assert as_set(O.product_hierarchy(rows, levels, "amount")) == as_set(O.product_hierarchy(flat, levels, "amount"))
    for level in range(3):
        stored = O.drill(L.as_flat(built, levels[: level + 1]), levels, level, "amount", None, by_parent=True)
        assert as_set(stored) == as_set(O.drill(flat, levels, level, "amount", None, by_parent=True))
        assert all("/rollups" in path for path in stored.inputFiles()) and stored.inputFiles()


@pytest.mark.parametrize("keys", [["kind"], ["day"], []])
def test_sketched_quantiles_are_within_their_bound(built, keys):
    shares = (0.01, 0.25, 0.5, 0.9, 0.99)
    asked = {f"q{n}": L.quantile("amount", share) for n, share in enumerate(shares)}
    found = L.answer(built, keys, asked, sketches=["amount"]).collect()
    held = defaultdict(list)
    for row in flat_rows():
        held[tuple({"kind": row[4], "day": row[3]}[k] for k in keys)].append(row[5])
    assert len(found) == len(held)
    for row in found:
        amounts = [float(v) for v in held[tuple(row[k] for k in keys)] if v is not None]
        for n, share in enumerate(shares):
            if not amounts:
                assert row[f"q{n}"] is None
                continue
            below = sum(v < row[f"q{n}"] for v in amounts) / len(amounts)
            upto = sum(v <= row[f"q{n}"] for v in amounts) / len(amounts)
            slack = 2 * L.rank_error() + 1 / len(amounts)
            assert below - slack <= share <= upto + slack


def test_batches_add_up_to_one_load(spark, built, flat, tmp_path):
    first, second = flat.where("day < 11"), flat.where("day >= 11")
    half = L.build_rollups(lambda _: first, WANTED, ["amount", "pieces"], f"{tmp_path}/first")
    whole = L.build_rollups(lambda _: second, WANTED, ["amount", "pieces"], f"{tmp_path}/second", earlier=half)
    for name, grouping in built.groupings.items():
        columns = [c for c in grouping.table.columns if not c.endswith("_sketch")]
        assert as_set(whole.groupings[name].table.select(columns)) == as_set(grouping.table.select(columns))
    low = L.answer(whole, [], {"q": L.quantile("amount", 0.0)}, sketches=["amount"]).first()["q"]
    assert low == float(min(r[5] for r in flat_rows() if r[5] is not None))


def test_no_rows(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    built = L.build_rollups(lambda _: none, WANTED, ["amount"], str(tmp_path))
    assert L.answer(built, ["kind"], {"n": L.lines()}).collect() == []
    asked = {"n": L.lines(), "q": L.quantile("amount", 0.5)}
    assert tuple(L.answer(built, [], asked, sketches=["amount"]).first()) == (0, None)
