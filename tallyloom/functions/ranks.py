"""Exact order statistics without sorting a whole table, or a whole group, in one task.

`exact_quantiles` brackets each wanted rank with a mergeable sketch, counts what lies outside the bracket, and narrows
the values inside it by counting them in ranges, round by round, until few enough are left to order.  The sketch decides
how many rounds that takes, never the answer: if a bracket misses, the side that holds the rank is narrowed instead.

`ordered_cut` finds the k-th smallest text key by counting key prefixes, level by level, until few enough keys are left.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tallyloom.functions.columns import hash_key
from tallyloom.session import stored

SKETCH_ACCURACY = 10_000
#: Distinct values that one task orders, ranges of a narrowing round, and digits a level adds to a prefix.
MOST_ORDERED = 100_000
RANGES = 4_096
DIGITS = 3


def exact_quantiles(
    df: DataFrame, value: str, probabilities: Sequence[float], groups: Sequence[str] = (), most: int = MOST_ORDERED
) -> DataFrame:
    """Linearly interpolated quantiles per group: columns *groups, n, q (array in the order of `probabilities`).

    Missing values and missing group keys are left out.
    """
    groups = list(groups)
    probabilities = [float(p) for p in probabilities]
    rows = df.select(*groups, F.col(value).cast("double").alias("_v")).na.drop()

    slack = 2.0 / SKETCH_ACCURACY
    low_p = [max(p - slack, 0.0) for p in probabilities]
    high_p = [min(p + slack, 1.0) for p in probabilities]
    brackets = rows.groupBy(*groups).agg(
        F.percentile_approx("_v", low_p, SKETCH_ACCURACY).alias("_lo"),
        F.percentile_approx("_v", high_p, SKETCH_ACCURACY).alias("_hi"),
    )

    outside = [F.count("*").alias("n")]
    for i in range(len(probabilities)):
        outside.append(F.count_if(F.col("_v") < F.col("_lo")[i]).alias(f"_below{i}"))
        outside.append(F.count_if(F.col("_v") <= F.col("_hi")[i]).alias(f"_upto{i}"))
    counted = (
        _with_group_facts(rows, _settled(brackets, groups), groups)
        .groupBy(*groups)
        .agg(*outside, F.min("_lo").alias("_lo"), F.min("_hi").alias("_hi"))
    )

    plans = []
    for i, p in enumerate(probabilities):
        position = (F.col("n") - 1) * F.lit(p)
        first, last = F.floor(position), F.ceil(position)
        holds_first, holds_last = first >= F.col(f"_below{i}"), last < F.col(f"_upto{i}")
        plans.append(
            F.struct(
                F.lit(i).alias("i"),
                F.when(holds_first, F.col("_lo")[i]).otherwise(F.lit(float("-inf"))).alias("lo"),
                F.when(holds_last, F.col("_hi")[i]).otherwise(F.lit(float("inf"))).alias("hi"),
                F.when(holds_first, F.col(f"_below{i}")).otherwise(F.lit(0)).alias("skipped"),
                first.alias("first"),
                last.alias("last"),
                (position - first).alias("share"),
            )
        )
    wanted = _settled(counted.select(*groups, "n", F.array(*plans).alias("_plans")), groups)

    inside = (
        _with_group_facts(rows, wanted, groups)
        .select(*groups, "n", "_v", F.explode(F.filter("_plans", lambda w: F.col("_v").between(w["lo"], w["hi"]))).alias("_w"))
        .groupBy(*groups, "n", "_w", "_v")
        .agg(F.count("*").alias("_copies"))
    )
    inside = _narrowed(inside, groups, most)
    running = Window.partitionBy(*groups, "_w.i").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = inside.withColumn("_upto", F.sum("_copies").over(running) + F.col("_w.skipped"))
    at_first = F.min(F.when(F.col("_upto") > F.col("_w.first"), F.col("_v")))
    at_last = F.min(F.when(F.col("_upto") > F.col("_w.last"), F.col("_v")))
    points = ranked.groupBy(*groups, "n", "_w").agg(at_first.alias("_a"), at_last.alias("_b")).select(
        *groups,
        "n",
        F.col("_w.i").alias("_i"),
        (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_w.share")).alias("_q"),
    )
    slots = [F.max(F.when(F.col("_i") == i, F.col("_q"))) for i in range(len(probabilities))]
    return points.groupBy(*groups, "n").agg(F.array(*slots).alias("q"))


def _narrowed(inside: DataFrame, groups: list[str], most: int) -> DataFrame:
    """Values (with copies) that hold the wanted ranks, at most `most` of them per group and rank: counted in equal ranges
    between their ends, all but the ranges that hold a rank go, and what was below counts as skipped."""
    names = [*groups, "n", "_w", "_v", "_copies"]
    keys = [*groups, "_i"]
    left = None
    while True:
        inside = stored(inside.select(*names).withColumn("_i", F.col("_w.i")), "bracketed")
        sizes = inside.groupBy(*keys).agg(F.count("*").alias("_size"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
        largest = sizes.agg(F.max("_size").alias("m")).first()["m"] or 0
        if largest <= most or largest == left:  # no ranges part values such as infinities
            return inside
        left = largest
        width = F.col("_most") - F.col("_least")
        place = F.least(F.floor((F.col("_v") - F.col("_least")) / width * RANGES), F.lit(RANGES - 1))
        apart = (width > 0) & (width < F.lit(float("inf")))
        placed = inside.join(stored(sizes, "ends"), keys).withColumn("_range", F.when(apart, place).otherwise(0))
        counts = placed.groupBy(*keys, "_range").agg(F.sum("_copies").alias("_c"), F.first("_w").alias("_own"))
        order = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)  # RANGES rows
        counts = counts.withColumn("_to", F.sum("_c").over(order) + F.col("_own.skipped"))
        from_ = F.col("_to") - F.col("_c")
        kept = counts.where((F.col("_to") > F.col("_own.first")) & (from_ <= F.col("_own.last")))
        below = F.min(from_).over(Window.partitionBy(*keys)).alias("_skipped")
        kept = kept.select(*keys, "_range", below)
        inside = placed.join(stored(kept, "ranges"), [*keys, "_range"]).withColumn(
            "_w", F.col("_w").withField("skipped", F.col("_skipped"))
        )


def _settled(facts: DataFrame, groups: list[str]) -> DataFrame:
    """Per-group facts computed once: a stored table, or a local row when there is one group only."""
    if groups:
        return stored(facts, "group_facts")
    return facts.sparkSession.createDataFrame(facts.collect(), facts.schema)


def _with_group_facts(rows: DataFrame, facts: DataFrame, groups: list[str]) -> DataFrame:
    """Attach settled facts.  Grouped ones are joined by key, and their stored size decides how."""
    if groups:
        return rows.join(facts, groups)
    single = facts.first()
    if single is None:
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in facts.schema.fields]
        return rows.where(F.lit(False)).select("*", *nothing)
    return rows.select("*", *[_literal(single[f.name]).cast(f.dataType).alias(f.name) for f in facts.schema.fields])


def _literal(value: object) -> Column:
    if isinstance(value, Row):
        return F.struct(*[_literal(part).alias(name) for name, part in value.asDict().items()])
    if isinstance(value, list):
        return F.array(*[_literal(part) for part in value])
    return F.lit(value)


def ordered_cut(
    df: DataFrame, key: str, rank: Column, first: int = DIGITS, groups: Sequence[str] = (), most: int = MOST_ORDERED
) -> DataFrame:
    """The key at 1-based position `rank` of each group: columns *groups, cut_key, copies_wanted, copies, n.

    `rank` is an expression over the group's row count `n`.  Keys are counted by their first characters, then by
    `DIGITS` more in each level, and only those that share the prefix that holds the rank go on, until no group has more
    than `most` rows left; `copies_wanted` of the `copies` rows equal to `cut_key` are inside the cut.
    """
    groups = list(groups)
    inside = df.select(*groups, F.col(key).alias("_k")).na.drop()
    whole = Window.partitionBy(*(groups or [F.lit(0)]))
    ordering = whole.orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)
    chosen, length = None, first
    while True:
        prefix = F.col("_k") if length is None else F.substring("_k", 1, length)
        counts = inside.groupBy(*groups, prefix.alias("_p")).agg(F.count("*").alias("_c"))
        running = counts.withColumn("_upto", F.sum("_c").over(ordering))
        if chosen is None:
            ranked = running.withColumn("n", F.sum("_c").over(whole)).withColumn("_rank", rank.cast("long"))
        else:
            ranked = _with_group_facts(running, chosen.select(*groups, "n", "_rank"), groups)
        holds = (F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_c") < F.col("_rank"))
        within = (F.col("_rank") - F.col("_upto") + F.col("_c")).alias("_rank")
        chosen = _settled(ranked.where(holds).select(*groups, "n", "_p", within, "_c"), groups)
        if length is None:
            break
        known = _with_group_facts(inside, chosen.select(*groups, F.col("_p").alias("_in")), groups)
        inside = stored(known.where(F.startswith("_k", F.col("_in"))).select(*groups, "_k"), "sharing_prefix")
        facts = chosen.agg(F.max("_c").alias("rows"), F.max(F.length("_p")).alias("reached")).first()
        # One key of many rows is no longer than itself: then its rows are all that is left.
        length = length + DIGITS if (facts["rows"] or 0) > most and facts["reached"] == length else None
    return chosen.select(
        *groups, F.col("_p").alias("cut_key"), F.col("_rank").alias("copies_wanted"), F.col("_c").alias("copies"), "n"
    )


def mark_lowest(
    df: DataFrame, key: Column, rank: Column, name: str, first: int = DIGITS, groups: Sequence[str] = (), most: int = MOST_ORDERED
) -> DataFrame:
    """Adds `name`: true for exactly `rank` rows of each group, those with the lowest keys.

    Rows of equal keys go by the hash of all their columns; rows equal in all of them are counted, and that many marked.
    Rows whose key or group is missing are false.
    """
    groups, columns = list(groups), df.columns
    keyed = df.withColumn("_key", F.concat(key, hash_key(*columns)))
    cuts = ordered_cut(keyed, "_key", rank, first, groups, most).select(*groups, "cut_key", "copies_wanted", "copies")
    cuts = _settled(cuts, groups)
    if groups:
        placed = keyed.join(cuts, groups, "left").select(*columns, "_key", "cut_key", "copies_wanted", "copies")
    else:
        single = cuts.first()
        values = single.asDict() if single else {"cut_key": None, "copies_wanted": None, "copies": None}
        placed = keyed.select("*", *[F.lit(v).cast("string" if k == "cut_key" else "long").alias(k) for k, v in values.items()])
    split = F.coalesce((F.col("_key") == F.col("cut_key")) & (F.col("copies_wanted") < F.col("copies")), F.lit(False))
    below = F.coalesce(F.col("_key") <= F.col("cut_key"), F.lit(False))
    if cuts.where("copies_wanted < copies").isEmpty():
        return placed.select(*columns, below.alias(name))
    alike = placed.where(split).groupBy(*columns, "copies_wanted").agg(F.count("*").alias("_c"))
    copies = alike.withColumn("_at", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_c"))))
    marked = copies.select(*columns, (F.col("_at") <= F.col("copies_wanted")).alias(name))
    return placed.where(~split).select(*columns, below.alias(name)).unionByName(marked)


def take_lowest(df: DataFrame, keys: Sequence[str], share: float) -> DataFrame:
    """The rows with the lowest hash of `keys`, exactly round(share * rows) of them."""
    marked = mark_lowest(df, hash_key(*keys), F.round(F.col("n") * F.lit(share)), "_taken")
    return marked.where("_taken").drop("_taken")
