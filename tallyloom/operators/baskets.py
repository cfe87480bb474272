"""Market baskets: distinct items per order, frequent pairs and frequent triples.

Baskets stay in long form (order, item), so an order of any size is spread over rows.  Just for counting, the items of an
order with at most `wide` of them are packed into one row, once: pairs and triples are then listed row by row, and only
counts are shuffled, not the pairs of every order.

Pair counting is quadratic in the size of an order.  Three things keep that in hand, and all keep the result exact:
items below the support threshold are removed first (a pair cannot be more frequent than its rarer item); the pairs of
an order with at most `wide` items are listed; a wider order is never paired up as a whole.  For wide orders, pairs seen
in other orders are looked up, and only items found in enough wide orders to be frequent by those alone are paired.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.joins import HOT_ROWS, split_join
from tallyloom.session import stored

WIDE_ORDER = 500
WIDE_SALTS = 64


def baskets(df: DataFrame, order_key: str, item: str) -> DataFrame:
    """Distinct items of orders with at least two of them: order_id, item, basket_size.

    The distinct items are stored, as they are read twice.
    """
    lines = stored(df.select(F.col(order_key).alias("order_id"), F.col(item).alias("item")).na.drop().distinct(), "items")
    sizes = lines.groupBy("order_id").agg(F.count("*").alias("basket_size")).where("basket_size >= 2")
    return lines.join(sizes, "order_id")


def min_count(basket_total: int, min_support: float) -> int:
    """Orders an itemset must be in."""
    return max(2, int(basket_total * min_support))


def item_supports(basket_rows: DataFrame) -> DataFrame:
    """Baskets each item is in."""
    return basket_rows.groupBy("item").agg(F.count("*").alias("item_orders"))


def frequent_pairs(basket_rows: DataFrame, min_support: float, wide: int = WIDE_ORDER) -> DataFrame:
    """Item pairs in enough orders: counts, support, confidence both ways, lift.

    `basket_rows` is read several times: pass a stored table.
    """
    total, wide_orders = _profile(basket_rows, wide)
    least = min_count(total, min_support)
    supports = stored(item_supports(basket_rows), "item_supports")
    packed, wide_kept = _kept(basket_rows, supports, least, wide)
    pairs = _count_pairs(packed, wide_kept, least, wide_orders)
    of_a = supports.select(F.col("item").alias("item_a"), F.col("item_orders").alias("_a"))
    of_b = supports.select(F.col("item").alias("item_b"), F.col("item_orders").alias("_b"))
    together = F.col("orders_together")
    return (
        pairs.join(of_a, "item_a")
        .join(of_b, "item_b")
        .select(
            "item_a",
            "item_b",
            "orders_together",
            (together / total).alias("support"),
            (together / F.col("_a")).alias("confidence_a_to_b"),
            (together / F.col("_b")).alias("confidence_b_to_a"),
            (together * total / (F.col("_a") * F.col("_b"))).alias("lift"),
        )
    )


def frequent_triples(basket_rows: DataFrame, min_support: float, wide: int = WIDE_ORDER) -> DataFrame:
    """Item triples in enough orders, grown from the frequent pairs: counts and support.

    The pairs are stored between the two steps.
    """
    total, wide_orders = _profile(basket_rows, wide)
    least = min_count(total, min_support)
    supports = stored(item_supports(basket_rows), "item_supports")
    packed, wide_kept = _kept(basket_rows, supports, least, wide)
    counts = _count_pairs(packed, wide_kept, least, wide_orders)
    pairs = stored(counts.select("item_a", "item_b"), "frequent_pairs")
    triples = _triples(packed, pairs)
    _, wide_rows = _split(basket_rows, wide)
    if wide_orders:
        in_wide = _occurrences(wide_rows, pairs)
        repeated = in_wide.groupBy("item_a", "item_b").agg(F.count("*").alias("_w")).where(F.col("_w") >= least)
        from_wide = _grow(in_wide.join(repeated.drop("_w"), ["item_a", "item_b"]), pairs)
        triples = _add_wide(triples, from_wide, wide_rows, wide_orders, least)
    return triples.where(F.col("orders_together") >= least).select(
        F.col("item_a").alias("item_1"),
        F.col("item_b").alias("item_2"),
        F.col("item_c").alias("item_3"),
        "orders_together",
        (F.col("orders_together") / total).alias("support"),
    )


def _profile(basket_rows: DataFrame, wide: int) -> tuple[int, int]:
    """Number of baskets, and of those with more than `wide` items: decides the threshold and the plan."""
    sizes = basket_rows.groupBy("order_id").agg(F.max("basket_size").alias("size"))
    found = sizes.agg(F.count("*").alias("all"), F.count_if(F.col("size") > wide).alias("wide")).first()
    return found["all"], found["wide"]


def _kept(basket_rows: DataFrame, supports: DataFrame, least: int, wide: int) -> tuple[DataFrame, DataFrame]:
    """What is left of orders without their rare items: narrow orders packed and stored, rows of wide ones."""
    kept = _only(basket_rows, supports.where(F.col("item_orders") >= least).select("item"), supports)
    narrow, wide_rows = _split(kept, wide)
    packed = narrow.groupBy("order_id").agg(F.array_sort(F.collect_list("item")).alias("items")).where(F.size("items") > 1)
    return stored(packed.select("items"), "packed_orders"), wide_rows


def _count_pairs(packed: DataFrame, wide_rows: DataFrame, least: int, wide_orders: int) -> DataFrame:
    pairs = _first_and_after(packed).select("item_a", F.explode("after").alias("item_b"))
    pairs = pairs.groupBy("item_a", "item_b").agg(F.count("*").alias("orders_together"))
    if wide_orders:
        repeated = wide_rows.groupBy("item").agg(F.count("*").alias("_w")).where(F.col("_w") >= least)
        repeated = stored(repeated, "wide_items")
        counted = repeated.withColumnRenamed("_w", "_n")
        from_wide = _pair_up(split_join(wide_rows, repeated.select("item"), ["item"], "left_semi", counted), salts=WIDE_SALTS)
        pairs = _add_wide(pairs, from_wide, wide_rows, wide_orders, least)
    return pairs.where(F.col("orders_together") >= least)


def _after(place: str, items: str) -> Column:
    """The items behind a place (from 0) of an array."""
    return F.slice(items, F.col(place) + 2, F.size(items))


def _first_and_after(packed: DataFrame) -> DataFrame:
    """Each item of a packed order, with the items after it."""
    each = packed.select("items", F.posexplode("items").alias("_at", "item_a"))
    return each.select("item_a", _after("_at", "items").alias("after"))


def _triples(packed: DataFrame, pairs: DataFrame) -> DataFrame:
    """Counts of triples in packed orders whose three pairs are all frequent: an item meets the list of its partners, two
    partners after it in an order must be a frequent pair too."""
    partners = stored(pairs.groupBy("item_a").agg(F.collect_list("item_b").alias("_partners")), "partners")
    near = _first_and_after(packed).where(F.size("after") > 1).join(partners, "item_a")
    near = near.select("item_a", F.array_intersect("after", "_partners").alias("after")).where(F.size("after") > 1)
    second = near.select("item_a", "after", F.posexplode("after").alias("_at", "item_b"))
    third = second.select("item_a", "item_b", F.explode(_after("_at", "after")).alias("item_c"))
    bc = pairs.select(F.col("item_a").alias("item_b"), F.col("item_b").alias("item_c"))
    return third.join(bc, ["item_b", "item_c"]).groupBy("item_a", "item_b", "item_c").agg(F.count("*").alias("orders_together"))


def _only(rows: DataFrame, items: DataFrame, supports: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The rows of some items.  An item of very many orders is split."""
    return split_join(rows, items, ["item"], "left_semi", supports.withColumnRenamed("item_orders", "_n"), hot_rows)


def _split(rows: DataFrame, wide: int) -> tuple[DataFrame, DataFrame]:
    is_wide = F.col("basket_size") > wide
    return rows.where(~is_wide).select("order_id", "item"), rows.where(is_wide).select("order_id", "item")


def _named(rows: DataFrame, name: str) -> DataFrame:
    return rows.select("order_id", F.col("item").alias(name))


def _pairs_in_orders(rows: DataFrame, salts: int = 1) -> DataFrame:
    """The item pairs of each order.  With `salts`, one order's pairs are made by that many tasks."""
    left, right = _named(rows, "item_a"), _named(rows, "item_b")
    keys = ["order_id"]
    if salts > 1:
        left = left.withColumn("_salt", F.pmod(F.xxhash64("item_a"), F.lit(salts)).cast("int"))
        right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        keys.append("_salt")
    return left.join(right, keys).where("item_a < item_b").select("order_id", "item_a", "item_b")


def _pair_up(rows: DataFrame, salts: int = 1) -> DataFrame:
    return _pairs_in_orders(rows, salts).groupBy("item_a", "item_b").agg(F.count("*").alias("orders_together"))


def _occurrences(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """The wide orders that hold all items of each given set.

    Only items of a set are paired up inside an order, by salted tasks, and only pairs of a set go on: no join is on an
    item alone, so an item of most orders and sets is no hot key.
    """
    names = [name for name in sets.columns if name.startswith("item_")]
    members = sets.select(F.explode(F.array(*names)).alias("item")).distinct()
    pairs = _pairs_in_orders(rows.join(members, "item", "left_semi"), WIDE_SALTS)
    found = pairs.join(sets.select("item_a", "item_b").distinct(), ["item_a", "item_b"], "left_semi")
    if "item_c" in names:
        ends = sets.select("item_a", "item_c").distinct()
        third = pairs.withColumnRenamed("item_b", "item_c").join(ends, ["item_a", "item_c"], "left_semi")
        found = found.join(third, ["order_id", "item_a"])
    return found.join(sets, names)


def _grow(occurrences: DataFrame, pairs: DataFrame) -> DataFrame:
    """Triples whose three pairs are all frequent, from the pairs that share their first item in an order."""
    ab = occurrences.select("order_id", "item_a", "item_b")
    ac = occurrences.select("order_id", "item_a", F.col("item_b").alias("item_c"))
    bc = pairs.select(F.col("item_a").alias("item_b"), F.col("item_b").alias("item_c"))
    grown = ab.join(ac, ["order_id", "item_a"]).where("item_b < item_c").join(bc, ["item_b", "item_c"])
    return grown.groupBy("item_a", "item_b", "item_c").agg(F.count("*").alias("orders_together"))


def _add_wide(counted: DataFrame, from_wide: DataFrame, wide_rows: DataFrame, wide_orders: int, least: int) -> DataFrame:
    """Counts over narrow and wide orders together, for every itemset that may reach the threshold."""
    names = [name for name in counted.columns if name.startswith("item_")]
    hopeful = stored(counted.where(F.col("orders_together") >= least - wide_orders), "hopeful_itemsets")
    looked_up = _occurrences(wide_rows, hopeful.select(*names)).groupBy(*names).agg(F.count("*").alias("_w"))
    seen = hopeful.join(looked_up, names, "left").select(
        *names, (F.col("orders_together") + F.coalesce("_w", F.lit(0))).alias("orders_together")
    )
    only_wide = from_wide.join(hopeful.select(*names), names, "left_anti")
    return seen.unionByName(only_wide.select(*names, "orders_together"))


def top_n(df: DataFrame, keys: list[str], tie_breakers: list[str], n: int) -> DataFrame:
    """The n rows highest by `keys`; ties go by `tie_breakers` so the result is repeatable."""
    return df.orderBy(*[F.col(k).desc() for k in keys], *tie_breakers).limit(n)
