"""Star, snowflake and shared-dimension modelling: dimensions, surrogate keys, facts and flat views."""

from __future__ import annotations

import functools
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.columns import hash_key, one_row

# Column types of the warehouse tables.
MEASURE_TYPES = {
    "sales": "decimal(15,2)",
    "quantity": "int",
    "discount": "decimal(15,4)",
    "profit": "decimal(15,5)",
    "shipping_cost": "decimal(15,3)",
}


def surrogate_key(df: DataFrame, natural_key: Sequence[str], id_name: str, first: Column | int = 1) -> DataFrame:
    """Number distinct natural keys densely from `first`, in the order of their hash.

    The leading hash digits split the keys into 4,096 equal buckets; a bucket's start is the count of all keys in
    earlier buckets, so no task orders more than one bucket and a re-run gives the same numbers.
    """
    hashed = df.withColumn("_h", hash_key(*natural_key)).withColumn("_b", F.substring("_h", 1, 3))
    earlier = Window.partitionBy(F.lit(0)).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        hashed.groupBy("_b")
        .agg(F.count("*").alias("_n"))
        .select("_b", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    )
    in_bucket = F.row_number().over(Window.partitionBy("_b").orderBy("_h", *natural_key))
    start = first if isinstance(first, Column) else F.lit(first)
    return (
        hashed.join(F.broadcast(starts), "_b")  # at most 4,096 rows
        .select((start + F.col("_start") + in_bucket - 1).cast("long").alias(id_name), *df.columns)
    )


def dim(df: DataFrame, natural_key: Sequence[str], id_name: str) -> DataFrame:
    """Distinct complete natural keys with a surrogate key."""
    return surrogate_key(df.select(*natural_key).na.drop().distinct(), natural_key, id_name)


def union_distinct_dates(df: DataFrame, date_columns: Sequence[str], name: str = "date") -> DataFrame:
    """All different dates of several columns."""
    stacked = df.select(F.explode(F.array(*date_columns)).alias(name))
    return stacked.where(F.col(name).isNotNull()).distinct()


def dim_time(df: DataFrame, date_columns: Sequence[str]) -> DataFrame:
    """Every order and ship date, numbered in calendar order (a calendar is small, so one window numbers it)."""
    numbered = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("date"))
    return union_distinct_dates(df, date_columns).select(numbered.cast("long").alias("date_id"), "date")


def first_per_key(df: DataFrame, key: str, attributes: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row's attributes of each key under an explicit order; combines before the shuffle."""
    chosen = F.min_by(F.struct(*attributes), F.struct(*order)).alias("_first")
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(chosen).select(key, "_first.*")


def first_present(column: str, order: Sequence[str]) -> Column:
    """First non-missing value under an explicit order, as an aggregate (rows with a NULL order are passed over)."""
    return F.min_by(F.col(column), F.when(F.col(column).isNotNull(), F.struct(*order)))


def child_dim(
    df: DataFrame, level: str, ancestors: Sequence[str], parent: DataFrame, parent_id: str, id_name: str
) -> DataFrame:
    """One level of a hierarchy: distinct (level, ancestors) with its own key and its parent's key.

    `parent` holds `ancestors` as columns, so a value is unique only within its parent.
    """
    own = dim(df, [level, *ancestors], id_name)
    return own.join(parent.select(*ancestors, parent_id), list(ancestors)).select(id_name, level, *ancestors, parent_id)


def insert_new_only(existing: DataFrame, incoming: DataFrame, natural_key: Sequence[str], id_name: str) -> DataFrame:
    """Existing dimension plus the natural keys it lacks, numbered after its highest key."""
    keys = list(natural_key)
    fresh = incoming.select(*keys).na.drop().distinct().join(existing, keys, "left_anti")
    highest = existing.agg(F.coalesce(F.max(id_name), F.lit(0)).alias("top"))
    numbered = surrogate_key(fresh, keys, id_name, one_row(highest)["top"] + 1)
    return existing.select(id_name, *keys).unionByName(numbered)


@dataclass(frozen=True)
class Lookup:
    """How a fact finds one dimension key: dimension, its natural key, its id, and the id's name in the fact."""

    dimension: DataFrame
    natural_key: Sequence[str]
    id_name: str
    fact_name: str | None = None


@dataclass(frozen=True)
class ByParent:
    """Rows that are made by joining children (order lines) to parents (buyers), given as the parents and as what makes the
    rows out of them; columns added to the parents stay on the rows."""

    parents: DataFrame
    rows_of: Callable[[DataFrame], DataFrame]


def _found(rows: DataFrame, lookup: Lookup) -> DataFrame:
    """The rows whose natural key the dimension knows, with its id."""
    name = lookup.fact_name or lookup.id_name
    keyed = lookup.dimension.select(*lookup.natural_key, F.col(lookup.id_name).alias(f"_{name}"))
    return rows.join(keyed, list(lookup.natural_key))


def fact(
    df: DataFrame | ByParent,
    date: Column,
    time: DataFrame,
    date_id: str,
    lookups: Sequence[Lookup],
    kept: Sequence[str],
    measures: Sequence[str],
    year: str | None = None,
) -> DataFrame:
    """Facts with surrogate keys; a line without a date or with an unknown key is dropped (inner joins).

    Only the columns used are read.  Dimension sizes decide how each lookup is joined.  Of rows given by their parents,
    keys that lie on the parents are looked up there, so the longer table is not shuffled for them and carries ids only.
    """
    names = [lookup.fact_name or lookup.id_name for lookup in lookups]
    early = []
    if isinstance(df, ByParent):
        early = [lookup for lookup in lookups if {*lookup.natural_key} <= {*df.parents.columns}]
        df = df.rows_of(functools.reduce(_found, early, df.parents))
    late = [lookup for lookup in lookups if lookup not in early]
    natural = sorted({name for lookup in late for name in lookup.natural_key})
    found = [f"_{lookup.fact_name or lookup.id_name}" for lookup in early]
    rows = df.select(date.alias("_date"), *natural, *found, *kept, *measures).where(F.col("_date").isNotNull())
    rows = rows.join(time.select(F.col("date").alias("_date"), "date_id"), "_date")
    rows = functools.reduce(_found, late, rows)
    ids = [F.col("date_id").alias(date_id), *[F.col(f"_{name}").alias(name) for name in names]]
    layout = [F.year("_date").alias(year)] if year else []
    return rows.select(
        *ids, *kept, *[F.col(m).cast(MEASURE_TYPES[m]).alias(m) for m in measures], *layout
    )


def number_rows(df: DataFrame, id_name: str) -> DataFrame:
    """Unique, not dense, row ids for a table about to be written."""
    return df.select((F.monotonically_increasing_id() + 1).alias(id_name), "*")


def flat(fact_table: DataFrame, paths: Mapping[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """A fact joined to just the dimension paths a query needs.

    `paths` maps a name to (dimension, fact column, dimension id).  The dimension may already be a joined hierarchy.
    """
    rows = fact_table
    for dimension, fact_column, id_name in paths.values():
        renamed = dimension.withColumnRenamed(id_name, fact_column)
        rows = rows.join(renamed, fact_column)
    return rows


def check_foreign_key(df: DataFrame, parent: DataFrame, key: Sequence[str], parent_key: Sequence[str]) -> DataFrame:
    """Distinct key values that have no parent row, with how many rows use them."""
    orphans = df.select(*key).na.drop().groupBy(*key).agg(F.count("*").alias("orphan_rows"))
    parents = parent.select(*[F.col(p).alias(k) for p, k in zip(parent_key, key)])
    return orphans.join(parents, list(key), "left_anti")


def check_unique(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*key).agg(F.count("*").alias("copies")).where("copies > 1")


def check_not_null_len(df: DataFrame, rules: Mapping[str, int | None]) -> DataFrame:
    """Per column, rows that are missing and rows longer than allowed; one pass for all columns."""
    checks = []
    for name, longest in rules.items():
        missing = F.count_if(F.col(name).isNull())
        too_long = F.count_if(F.length(F.col(name).cast("string")) > longest) if longest else F.lit(0).cast("long")
        checks.append(
            F.struct(F.lit(name).alias("column_name"), missing.alias("missing"), too_long.alias("too_long"))
        )
    return df.agg(F.array(*checks).alias("_c")).select(F.inline("_c"))
