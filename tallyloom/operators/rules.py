"""Decision rules: loss rates by dimension sets, compared with the overall loss rate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.columns import one_row
from tallyloom.session import stored

# The dimension sets, the least rows of a rule, and the factor over the baseline that asks for review.
DIMENSION_SETS = (
    ("category",),
    ("sub_category",),
    ("market",),
    ("region",),
    ("discount_band",),
    ("category", "discount_band"),
    ("sub_category", "discount_band"),
    ("market", "category"),
    ("ship_mode", "order_priority"),
)
MIN_ROWS = 50
REVIEW_FACTOR = 1.35
REVIEW, PROMOTE = "Review pricing/discounts", "Good candidate to promote"


def decision_rules(
    df: DataFrame,
    dimension_sets: Sequence[Sequence[str]] = DIMENSION_SETS,
    min_rows: int = MIN_ROWS,
    factor: float = REVIEW_FACTOR,
) -> DataFrame:
    """One rule per value combination of each dimension set with at least `min_rows` lines.

    The lines are read once and summed at the finest combination; the sets, and the overall loss rate, are then rolled
    up from those few sums.
    """
    names = list(dict.fromkeys(name for dims in dimension_sets for name in dims))
    cells = df.groupBy(*names).agg(
        F.count("*").alias("rows"),
        F.count_if("is_loss").alias("losses"),
        F.sum("sales").alias("sales"),
        F.sum("profit").alias("profit"),
        F.sum("discount").alias("discount_sum"),
        F.count("discount").alias("discount_rows"),
        F.sum("profit_margin").alias("margin_sum"),
        F.count("profit_margin").alias("margin_rows"),
    )
    cells = stored(cells, "rule_cells")  # read for the sets and for the whole
    sums = [F.sum(c).alias(c) for c in cells.columns if c not in names]
    sets = [[F.col(name) for name in dims] for dims in dimension_sets]
    grouped = cells.groupingSets(sets, *names).agg(F.grouping_id().alias("_gid"), *sums)
    whole = one_row(cells.agg(F.sum("rows").alias("rows"), F.sum("losses").alias("losses")))
    rules = (
        grouped.select(
            _condition(names, dimension_sets).alias("if_condition"),
            "*",
            (F.col("losses") / F.col("rows")).alias("loss_rate"),
            whole["rows"].alias("_total"),
            (whole["losses"] / whole["rows"]).alias("baseline"),
        )
        .where(F.col("if_condition").isNotNull())
        .where(F.col("rows") >= min_rows)
    )
    decided = rule_decision(rules, "loss_rate", "baseline", factor)
    return decided.select(
        "if_condition",
        "then_decision",
        F.col("rows").alias("support_rows"),
        (F.col("rows") / F.col("_total")).alias("support_pct"),
        "confidence",
        F.col("lift").alias("lift_vs_baseline"),
        "sales",
        "profit",
        F.try_divide(F.col("discount_sum").cast("double"), F.col("discount_rows").cast("double")).alias("avg_discount"),
        F.try_divide("margin_sum", "margin_rows").alias("avg_margin"),
    )


def _condition(names: Sequence[str], dimension_sets: Sequence[Sequence[str]]) -> Column:
    """Rule text of the set a row belongs to; NULL where one of its keys is missing."""
    ladder = None
    for dims in dimension_sets:
        gid = sum(1 << (len(names) - 1 - i) for i, name in enumerate(names) if name not in dims)
        parts: list[Column] = []
        for name in dims:
            parts += [F.lit(f" AND {name} = " if parts else f"{name} = "), F.col(name).cast("string")]
        text = F.concat(*parts)
        ladder = F.when(F.col("_gid") == gid, text) if ladder is None else ladder.when(F.col("_gid") == gid, text)
    return ladder


def rule_decision(df: DataFrame, rate: str, baseline: str, factor: float = REVIEW_FACTOR) -> DataFrame:
    """Decision with the confidence and lift that belong to it."""
    loss, base = F.col(rate), F.col(baseline)
    review = loss > base * factor
    return df.select(
        "*",
        F.when(review, REVIEW).otherwise(PROMOTE).alias("then_decision"),
        F.when(review, loss).otherwise(1 - loss).alias("confidence"),
        F.when(review, F.try_divide(loss, base)).otherwise(F.try_divide(1 - loss, 1 - base)).alias("lift"),
    )
