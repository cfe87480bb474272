"""Monthly series: roll-up, growth, moving average, smoothing, seasonality, trend and forecast.

All operators take `keys`, the columns that tell series apart (none: one series).  Windows and arrays run over the
months of one series, never over lines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.columns import margin
from tallyloom.session import stored

# Smoothing factor, blend weights and horizon.
ALPHA = 0.35
TREND_WEIGHT, SMOOTH_WEIGHT = 0.55, 0.45
HORIZON = 6


def monthly_rollup(df: DataFrame, date: str, keys: Sequence[str] = ()) -> DataFrame:
    """Per month: sums, distinct orders, mean discount, margin.  Months without lines are kept as zeros."""
    monthly = (
        df.where(F.col(date).isNotNull())
        .groupBy(*keys, F.trunc(date, "month").alias("month"))
        .agg(
            F.sum("sales").alias("sales"),
            F.sum("profit").alias("profit"),
            F.count_distinct("order_id").alias("orders"),
            F.sum("quantity").alias("quantity"),
            F.avg(F.col("discount").cast("double")).alias("avg_discount"),
        )
    )
    monthly = stored(monthly, "monthly")  # read twice: what the lines come from is worked out once
    span = monthly.groupBy(*keys).agg(
        F.explode(F.sequence(F.min("month"), F.max("month"), F.expr("interval 1 month"))).alias("month")
    )
    zero = lambda name: F.coalesce(F.col(name), F.lit(0)).alias(name)
    return span.join(monthly, [*keys, "month"], "left").select(
        *keys, "month", zero("sales"), zero("profit"), zero("orders"), zero("quantity"), "avg_discount",
        margin(F.coalesce("profit", F.lit(0)), F.coalesce("sales", F.lit(0))).alias("profit_margin"),
    )


def _along(keys: Sequence[str]) -> Window:
    return Window.partitionBy(*(keys or [F.lit(0)])).orderBy("month")


def mom_growth(monthly: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Change against the month before; missing where that was zero or there is none."""
    growth = []
    for c in columns:
        value = F.col(c).cast("double")
        growth.append((F.try_divide(value, F.lag(value).over(_along(keys))) - 1).alias(f"{c}_mom_growth"))
    return monthly.select("*", *growth)


def moving_avg(monthly: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), months: int = 3) -> DataFrame:
    """Trailing mean, missing until enough months exist."""
    frame = _along(keys).rowsBetween(1 - months, 0)
    full = F.count("*").over(frame) == months
    return monthly.select(
        "*", *[F.when(full, F.avg(F.col(c).cast("double")).over(frame)).alias(f"{c}_{months}m_moving_avg") for c in columns]
    )


def exp_smoothing(monthly: DataFrame, column: str, keys: Sequence[str] = (), alpha: float = ALPHA) -> DataFrame:
    """Simple exponential smoothing: each fit uses the months before it; the first fit is the first value."""
    points = F.array_sort(F.collect_list(F.struct("month", F.col(column).cast("double").alias("y"))))  # one per month
    ordered = monthly.groupBy(*keys).agg(points.alias("_p"))
    name = f"{column}_exp_smooth_fit"

    def step(done: Column, point: Column) -> Column:
        last = F.element_at(done, -1)
        return F.array_append(done, _fitted(point, alpha * last["y"] + (1 - alpha) * last["fit"]))

    first = F.array(_fitted(F.col("_p")[0], F.col("_p")[0]["y"]))
    later = F.slice("_p", F.lit(2), F.size("_p"))
    fitted = ordered.select(*keys, F.inline(F.aggregate(later, first, step)))
    return monthly.join(fitted.select(*keys, "month", F.col("fit").alias(name)), [*keys, "month"])


def _fitted(point: Column, fit: Column) -> Column:
    return F.struct(point["month"].alias("month"), point["y"].alias("y"), fit.alias("fit"))


def month_seasonality(monthly: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Means by calendar month, and each month's mean sales against the mean of those means."""
    by_month = monthly.groupBy(*keys, F.month("month").alias("calendar_month")).agg(
        F.avg(F.col("sales").cast("double")).alias("avg_sales"),
        F.avg(F.col("profit").cast("double")).alias("avg_profit"),
        F.avg(F.col("orders").cast("double")).alias("avg_orders"),
    )
    whole = F.avg("avg_sales").over(Window.partitionBy(*(keys or [F.lit(0)])))
    return by_month.select("*", F.try_divide(F.col("avg_sales"), whole).alias("seasonality_index"))


def _month_number(keys: Sequence[str]) -> Column:
    return (F.row_number().over(_along(keys)) - 1).cast("double")


def trend_fit(monthly: DataFrame, column: str, keys: Sequence[str] = ()) -> DataFrame:
    """Straight line of the series on its month number 0, 1, ...: slope, intercept, months."""
    numbered = monthly.select(*keys, _month_number(keys).alias("_x"), F.col(column).cast("double").alias("_y"))
    return numbered.groupBy(*keys).agg(
        F.regr_slope("_y", "_x").alias("slope"),
        F.regr_intercept("_y", "_x").alias("intercept"),
        F.count("*").alias("months"),
    )


def sales_forecast(
    monthly: DataFrame, keys: Sequence[str] = (), horizon: int = HORIZON, blend: tuple[float, float] = (TREND_WEIGHT, SMOOTH_WEIGHT)
) -> DataFrame:
    """Trend times seasonality, blended with the last smoothed value, for the coming months.

    A calendar month never seen has no seasonality, and its forecast is missing.
    """
    smoothed = exp_smoothing(monthly, "sales", keys)
    numbered = smoothed.withColumn("_x", _month_number(keys))
    sales = F.col("sales").cast("double")
    state = numbered.groupBy(*keys).agg(
        F.max("month").alias("last_month"),
        F.max_by("sales_exp_smooth_fit", "month").alias("last_smoothed"),
        F.regr_slope(sales, "_x").alias("slope"),
        F.regr_intercept(sales, "_x").alias("intercept"),
        F.count("*").alias("months"),
    )
    ahead = (
        state.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("i"))
        .withColumn("forecast_month", F.add_months("last_month", F.col("i")))
        .withColumn("calendar_month", F.month("forecast_month"))
    )
    season = month_seasonality(monthly, keys).select(*keys, "calendar_month", "seasonality_index")
    line = F.col("slope") * (F.col("months") + F.col("i") - 1) + F.col("intercept")
    value = blend[0] * line * F.col("seasonality_index") + blend[1] * F.col("last_smoothed")
    return ahead.join(season, [*keys, "calendar_month"], "left").select(
        *keys, "forecast_month", value.alias("forecast_sales")
    )


def history_and_forecast(monthly: DataFrame, forecast: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The forecast line as drawn: the last month of history, then the forecast."""
    last = monthly.groupBy(*keys).agg(
        F.max("month").alias("forecast_month"), F.max_by(F.col("sales").cast("double"), "month").alias("forecast_sales")
    )
    return last.select(*keys, "forecast_month", "forecast_sales").unionByName(forecast)
