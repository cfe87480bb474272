"""Incremental loading of the star and shared-dimension schemas: batches of order lines, each loaded once.

Dimension keys stay what they are: a load numbers only the natural keys that are new.  A product that came without an
attribute takes it from a later line.  Facts are made of the new lines alone and put beside those that are there, by year;
nothing that was loaded is read again but the dimensions.  Every load is published at once (see `sources.publish`).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.dimensions import first_per_key, insert_new_only, number_rows, union_distinct_dates
from tallyloom.plans.warehouse import (
    DATES,
    PLACE,
    PRODUCT_ATTRIBUTES,
    SCHEMAS,
    SHIPPING,
    Tables,
    star_dimensions,
)
from tallyloom.session import stored
from tallyloom.sources.order_lines import LINE_ORDER
from tallyloom.sources.publish import Rules, State, current, publish, read_published

#: Natural keys and ids of the shared dimensions that are numbered.
NUMBERED = {
    "time_dim": (["date"], "date_id"),
    "customer_dim": (["customer_name", "segment"], "customer_id"),
    "location_dim": (list(PLACE), "location_id"),
    "shipping_dim": (list(SHIPPING), "ship_mode_id"),
}
_PARENTS = (("date_id", "time_dim"), ("customer_id", "customer_dim"), ("location_id", "location_dim"), ("ship_mode_id", "shipping_dim"))


def merged_dimensions(known: Tables, lines: DataFrame) -> Tables:
    """The shared dimensions with what new lines bring; keys that are there stay."""
    if not known:
        return star_dimensions(lines)
    dates = union_distinct_dates(lines, DATES)
    out = {
        name: insert_new_only(known[name], dates if name == "time_dim" else lines, key, id_name) for name, (key, id_name) in NUMBERED.items()
    }
    came = first_per_key(lines, "product_id", PRODUCT_ATTRIBUTES, LINE_ORDER)
    both = known["product_dim"].join(came.toDF("product_id", *[f"_{a}" for a in PRODUCT_ATTRIBUTES]), "product_id", "full")
    filled = [F.coalesce(F.col(a), F.col(f"_{a}")).alias(a) for a in PRODUCT_ATTRIBUTES]
    return out | {"product_dim": both.select("product_id", *filled)}


def _rules(facts: Tables) -> Rules:
    """Ids and natural keys of dimensions are unique; every key of a fact is in its dimension."""
    unique = {name: [id_name] for name, (_, id_name) in NUMBERED.items()} | {"product_dim": ["product_id"]}
    parents = [
        (name, [key], parent, [key]) for name, table in facts.items() for key, parent in (*_PARENTS, ("product_id", "product_dim"))
        if key in table.columns
    ]
    return Rules(unique, parents)


def load_batches(spark: SparkSession, path: str, batches: Mapping[str, DataFrame], schema: str = "galaxy") -> State:
    """Load the batches of order lines that were not loaded before into the schema at `path`: star or galaxy.

    Names tell batches apart (a file's path, a day).  With nothing new the published state is left as it is.
    """
    if schema not in ("star", "galaxy"):
        raise ValueError("only schemas of shared dimensions grow by loads")
    before = current(spark, path)
    fresh = {name: lines for name, lines in batches.items() if name not in before.batches}
    if not fresh:
        return before
    lines = None
    for batch in fresh.values():
        lines = batch if lines is None else lines.unionByName(batch)
    lines = stored(lines, "batch-lines")
    known = read_published(spark, path, before)
    dims = {name: stored(table, f"batch-{name}") for name, table in merged_dimensions(known, lines).items()}
    facts = SCHEMAS[schema][1](lines, dims)
    facts = {name: _numbered_on(table, known.get(name)) for name, table in facts.items()}
    return publish(spark, path, dims, facts, {name: ["year"] for name in facts}, _rules(facts), list(fresh))


def _numbered_on(rows: DataFrame, known: DataFrame | None) -> DataFrame:
    """Rows numbered after those that are there."""
    id_name = rows.columns[0]
    if known is None:
        return rows
    highest = known.agg(F.coalesce(F.max(id_name), F.lit(0)).alias("top")).first()["top"]
    plain = number_rows(rows.drop(id_name), id_name)
    return plain.withColumn(id_name, F.col(id_name) + highest)
