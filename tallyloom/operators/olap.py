"""OLAP questions and dashboard marts over flat sales and shipping views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.columns import is_one_of, one_row

# Margin target and gauge bands, in percent.
MARGIN_TARGET = 15
MARGIN_BANDS = ((-10, 0), (0, 10), (10, 20), (20, 40))


def filter_in_lists(flat: DataFrame, selections: Mapping[str, Sequence | None]) -> DataFrame:
    """Keep rows whose columns are in the selected lists.  None selects all; an empty list selects nothing."""
    for name, values in selections.items():
        if values is not None:
            flat = flat.where(is_one_of(F.col(name), values))
    return flat


def filter_options(df: DataFrame, column: str, sample: int | None = None) -> DataFrame:
    """Distinct values of a column in order, or the first few of them."""
    options = df.select(F.col(column).alias("option")).na.drop().distinct().orderBy("option")
    return options.limit(sample) if sample else options


def slice_dice(flat: DataFrame, fixed: Mapping[str, object], measure: str = "sales") -> DataFrame:
    """Fix one dimension value (slice) or several (dice) and total a measure."""
    rows = flat
    for name, value in fixed.items():
        rows = rows.where(F.col(name) == F.lit(value))
    return rows.groupBy(*fixed).agg(F.sum(measure).alias(f"total_{measure}"))


def pivot(flat: DataFrame, rows: str, columns: str, values: Sequence[str], measure: str) -> DataFrame:
    """One row per `rows`, one column per listed value, 0 where nothing was sold.

    The values are given, so no job is needed to find them.
    """
    table = flat.groupBy(rows).pivot(columns, list(values)).agg(F.sum(measure))
    names = {value: value.lower().replace(" ", "_") for value in values}
    return table.select(rows, *[F.coalesce(F.col(f"`{v}`"), F.lit(0)).alias(names[v]) for v in values])


def totals_by(flat: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Sums per key: the mart behind most charts."""
    return flat.groupBy(*keys).agg(*[F.sum(m).alias(f"total_{m}") for m in measures])


def drill(flat: DataFrame, hierarchy: Sequence[str], level: int, measure: str, n: int | None, by_parent: bool) -> DataFrame:
    """Totals at one level of a hierarchy: deeper is drill-down, shallower is roll-up.

    `by_parent` lists children under their parents; otherwise the largest come first.
    """
    keys = list(hierarchy[: level + 1])
    total = f"total_{measure}"
    parents = keys[:-1] if by_parent else []
    order = [*[F.col(p) for p in parents], F.col(total).desc(), F.col(keys[-1])]
    table = totals_by(flat, keys, [measure]).orderBy(*order)
    return table.limit(n) if n else table


def drill_across(
    sales: DataFrame, shipping: DataFrame, keys: Sequence[str], group: str, n: int, safe: bool = False
) -> DataFrame:
    """Sales beside shipping cost per group.

    The joined form pairs every sale with every shipment of the same keys, so both sums are multiplied.  The same
    numbers come from pre-aggregated facts: each sum times the other side's row count, with no row pairs produced.
    `safe` gives the true totals.
    """
    if safe:
        left = sales.groupBy(group).agg(F.sum("sales").alias("total_sales"))
        right = shipping.groupBy(group).agg(F.sum("shipping_cost").alias("total_shipping"))
        table = left.join(right, group)
    else:
        keys = list(dict.fromkeys([*keys, group]))
        left = sales.groupBy(*keys).agg(F.sum("sales").alias("_s"), F.count("*").alias("_ns"))
        right = shipping.groupBy(*keys).agg(F.sum("shipping_cost").alias("_c"), F.count("*").alias("_nc"))
        table = (
            left.join(right, keys)
            .groupBy(group)
            .agg(F.sum(times("_s", "_nc")).alias("total_sales"), F.sum(times("_c", "_ns")).alias("total_shipping"))
        )
    return table.orderBy(F.col("total_sales").desc(), group).limit(n)


def times(amount: str, count: str) -> Column:
    """Exact product of a decimal sum and a row count."""
    return F.col(amount).cast("decimal(22,4)") * F.col(count).cast("decimal(15,0)")


def drill_through(flat: DataFrame, predicate: Column, columns: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The detail rows behind a cell, the first few in the given order."""
    return flat.where(predicate).orderBy(*order).limit(n).select(*columns)


def kpi_summary(flat: DataFrame, order_key: str | None = None) -> DataFrame:
    """Totals, mean discount, line count, distinct orders where known, margin %, distance to target, gauge band."""
    orders = [F.count_distinct(order_key).alias("total_orders")] if order_key else []
    totals = flat.agg(
        F.sum("sales").alias("total_sales"),
        F.sum("profit").alias("total_profit"),
        F.sum("quantity").alias("total_quantity"),
        F.avg(F.col("discount").cast("double")).alias("avg_discount"),
        F.count("*").alias("total_lines"),
        *orders,
    )
    ratio = F.try_divide(F.col("total_profit").cast("double"), F.col("total_sales").cast("double"))
    margin = F.round(F.coalesce(ratio, F.lit(0.0)) * 100, 2)
    ladder = F.when(margin < MARGIN_BANDS[0][0], F.lit("below range"))
    for low, high in MARGIN_BANDS:
        ladder = ladder.when(margin < high, F.lit(f"{low} to {high}"))
    ladder = ladder.when(margin == MARGIN_BANDS[-1][1], F.lit("{} to {}".format(*MARGIN_BANDS[-1])))
    return totals.select(
        "*",
        margin.alias("margin_pct"),
        F.round(margin - MARGIN_TARGET, 2).alias("margin_vs_target"),
        ladder.otherwise("above range").alias("margin_band"),
    )


def monthly_category_sales(flat: DataFrame, date: str) -> DataFrame:
    """Month by category sales, with the mean of the monthly totals as a reference line."""
    month = F.trunc(date, "month").alias("month")
    table = flat.groupBy(month, "category").agg(F.sum("sales").alias("total_sales"))
    per_month = table.groupBy("month").agg(F.sum("total_sales").alias("_m"))
    mean = per_month.agg(F.avg(F.col("_m").cast("double")).alias("mean"))
    return table.select("month", "category", "total_sales", one_row(mean)["mean"].alias("mean_month_sales"))


def join_cte_metrics(sales: DataFrame, shipping: DataFrame, key: str) -> DataFrame:
    """Per-key sales metrics beside per-key shipping totals.  Only the key filter applies to the shipping side."""
    left = sales.groupBy(key).agg(
        F.sum("sales").alias("total_sales"),
        F.sum("profit").alias("total_profit"),
        F.avg(F.col("discount").cast("double")).alias("avg_discount"),
        F.sum("quantity").alias("total_quantity"),
    )
    right = shipping.groupBy(key).agg(F.sum("shipping_cost").alias("total_shipping"))
    return left.join(right, key)


def metric_correlation(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Pearson matrix of the metrics, all pairs in one pass; NULL where a metric is constant."""
    pairs = []
    for i, a in enumerate(metrics):
        for b in metrics[: i + 1]:
            x, y = F.col(a).cast("double"), F.col(b).cast("double")
            both = x.isNotNull() & y.isNotNull()
            spread = F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
            pairs.append(F.try_divide(F.covar_pop(x, y), spread).alias(f"{a}|{b}"))
    single = df.agg(*pairs)
    rows = []
    for a in metrics:
        cells = [F.col(f"`{a}|{b}`" if metrics.index(b) <= metrics.index(a) else f"`{b}|{a}`").alias(b) for b in metrics]
        rows.append(F.struct(F.lit(a).alias("metric"), *cells))
    return single.select(F.inline(F.array(*rows)))


def product_hierarchy(flat: DataFrame, levels: Sequence[str], measure: str = "sales") -> DataFrame:
    """Totals of every node of a hierarchy, parents included.

    The leaves are summed first, so rolling up expands leaf totals and not the fact rows.
    """
    leaves = flat.groupBy(*levels).agg(F.sum(measure).alias("_leaf"))
    rolled = leaves.rollup(*levels).agg(F.sum("_leaf").alias(f"total_{measure}"), F.grouping_id().alias("_gid"))
    depth = F.lit(len(levels)) - F.bit_count("_gid")
    return rolled.select(*levels, f"total_{measure}", depth.alias("depth")).where("depth > 0")
