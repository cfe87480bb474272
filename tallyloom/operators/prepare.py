"""Preparing columns: filling, smoothing, scaling, banding, encoding, sampling and splitting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.columns import band, hash_key, one_row, signed_log
from tallyloom.functions.numbering import dense_ranks
from tallyloom.functions.ranks import exact_quantiles, mark_lowest, take_lowest

MAX_LEVELS = 1_000


def impute_median(df: DataFrame, column: str) -> DataFrame:
    """Missing values take the median of the others."""
    found = exact_quantiles(df, column, [0.5]).first()
    median = F.lit(found["q"][0] if found else None)
    return df.withColumn(column, F.coalesce(F.col(column).cast("double"), median))


def smooth_by_bin_mean(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Equal-frequency bins; adds the bin and its mean.  Bins whose edges coincide are merged."""
    found = exact_quantiles(df, column, [i / bins for i in range(1, bins)]).first()
    value = F.col(column).cast("double")
    above = [(value > edge).cast("int") for edge in (found["q"] if found else [])]
    binned = df.withColumn(f"{column}_bin", sum(above, F.lit(0)))
    means = binned.where(F.col(column).isNotNull()).groupBy(f"{column}_bin").agg(
        F.try_divide(F.sum(column).cast("double"), F.count(column).cast("double")).alias("mean")
    )
    entries = F.collect_list(F.struct(F.col(f"{column}_bin"), F.col("mean")))  # one entry per bin
    lookup = one_row(means.agg(F.map_from_entries(entries).alias("m")))["m"]
    return binned.withColumn(f"{column}_smoothed", F.try_element_at(lookup, F.col(f"{column}_bin")))


def smooth_by_regression(df: DataFrame, y: str, x: str) -> DataFrame:
    """Least-squares line of y on x; adds the fitted value."""
    dy, dx = F.col(y).cast("double"), F.col(x).cast("double")
    line = one_row(df.agg(F.regr_slope(dy, dx).alias("slope"), F.regr_intercept(dy, dx).alias("intercept")))
    return (
        df.withColumn("_line", line)
        .withColumn(f"{y}_fitted", F.col("_line.slope") * dx + F.col("_line.intercept"))
        .drop("_line")
    )


def min_max_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rescale to 0..1; a constant column becomes 0."""
    value = {c: F.col(c).cast("double") for c in columns}
    ends = [F.min(value[c]).alias(f"min_{c}") for c in columns] + [F.max(value[c]).alias(f"max_{c}") for c in columns]
    scaled = df.withColumn("_ends", one_row(df.agg(*ends)))
    for c in columns:
        low, high = F.col(f"_ends.min_{c}"), F.col(f"_ends.max_{c}")
        share = F.coalesce(F.try_divide(value[c] - low, high - low), F.lit(0.0))
        scaled = scaled.withColumn(f"{c}_scaled", F.when(F.col(c).isNotNull(), share))
    return scaled.drop("_ends")


def zscore(df: DataFrame, columns: Sequence[str], fitted_on: DataFrame | None = None) -> DataFrame:
    """Replace columns by (x - mean) / population deviation; a deviation of 0 counts as 1.

    Mean and deviation come from `fitted_on` where given (a training part).
    """
    source = df if fitted_on is None else fitted_on
    value = {c: F.col(c).cast("double") for c in columns}
    moments = [F.avg(value[c]).alias(f"mean_{c}") for c in columns]
    moments += [F.stddev_pop(value[c]).alias(f"dev_{c}") for c in columns]
    scaled = df.withColumn("_moments", one_row(source.agg(*moments)))
    replaced = []
    for c in df.columns:
        if c in value:
            deviation = F.col("_moments")[f"dev_{c}"]
            deviation = F.when(deviation == 0, F.lit(1.0)).otherwise(deviation)
            replaced.append(((value[c] - F.col("_moments")[f"mean_{c}"]) / deviation).alias(c))
        else:
            replaced.append(F.col(f"`{c}`"))
    return scaled.select(*replaced)


def add_signed_log(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add the signed logarithm of each column."""
    return df.select("*", *[signed_log(F.col(c)).alias(f"{c}_log") for c in columns])


def discretise(df: DataFrame, column: str, edges: Sequence[float], labels: Sequence[str], name: str) -> DataFrame:
    """Add the label of the right-closed interval each value falls in."""
    return df.withColumn(name, band(F.col(column), edges, labels))


def levels_of(df: DataFrame, columns: Sequence[str], most: int = MAX_LEVELS) -> dict[str, list[str]]:
    """The distinct values of categorical columns in order, in one pass; refuses columns that are not categorical."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in columns])
    found = df.select(F.inline(cells)).na.drop().distinct().limit(most * len(columns) + 1).collect()
    levels = {c: sorted(row["level"] for row in found if row["column"] == c) for c in columns}
    crowded = [c for c in columns if len(levels[c]) > most] or (list(columns) if len(found) > most * len(columns) else [])
    if crowded:
        raise ValueError(f"more than {most} levels: {crowded}")
    return levels


def one_hot_drop_first(df: DataFrame, columns: Sequence[str], most: int = MAX_LEVELS) -> DataFrame:
    """Replace each categorical column by 0/1 columns for all its levels but the alphabetically first.

    A table of more than `most` columns for one is refused, never cut; `regression.encode_levels` has no such limit.
    """
    dummies = [
        F.coalesce((F.col(c) == level).cast("double"), F.lit(0.0)).alias(f"{c}_{level}")
        for c, levels in levels_of(df, columns, most).items()
        for level in levels[1:]
    ]
    return df.select(*[f"`{name}`" for name in df.columns if name not in columns], *dummies)


def label_encode(df: DataFrame, column: str, name: str) -> DataFrame:
    """Class to its index among the sorted classes (lower-cased); the classes are a table, joined back."""
    known = F.lower(F.col(column))
    classes = dense_ranks(df.select(known.alias("_class")).na.drop(), ["_class"], name)
    classes = classes.withColumn(name, F.col(name).cast("int"))
    return df.withColumn("_class", known).join(classes, "_class", "left").drop("_class")


def hash_sample(df: DataFrame, share: float = 0.05, keys: Sequence[str] | None = None) -> DataFrame:
    """A repeatable sample without replacement of exactly round(share * rows) rows."""
    return take_lowest(df, list(keys or df.columns), share)


def chronological_split(df: DataFrame, date: str, key: str, train_share: float = 0.8) -> DataFrame:
    """Mark the first whole part of `train_share` of the rows by date as training rows (`is_train`).

    Rows of one date are ordered by the hash of their key; days are counted first, then hash prefixes within the day
    that the cut falls in.
    """
    ordered = F.concat(F.date_format(date, "yyyy-MM-dd"), hash_key(key))
    return mark_lowest(df, ordered, F.floor(F.col("n") * F.lit(train_share)), "is_train", first=10)


def stratified_split(df: DataFrame, label: str, key: str, test_share: float = 0.2) -> DataFrame:
    """Mark round(test_share * rows) rows of each class as test rows (`is_test`), chosen by hash."""
    return mark_lowest(df, hash_key(key), F.round(F.col("n") * F.lit(test_share)), "is_test", groups=[label])
