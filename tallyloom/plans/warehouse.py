"""Star, snowflake and shared-dimension schemas: built once from order lines, read by the marts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.dimensions import (
    ByParent,
    Lookup,
    child_dim,
    dim,
    dim_time,
    fact,
    first_per_key,
    flat,
    number_rows,
)
from tallyloom.session import stored
from tallyloom.sources.order_lines import LINE_ORDER
from tallyloom.sources.tables import read_marts, write_warehouse

Tables = dict[str, DataFrame]

DATES = ("order_date", "ship_date")
PLACE = ("country", "state", "market", "region")
SHIPPING = ("ship_mode", "order_priority")
PRODUCT_ATTRIBUTES = ("product_name", "category", "sub_category")
SALES_MEASURES = ("sales", "quantity", "discount", "profit")



def _ship_or_order_date() -> Column:
    return F.coalesce("ship_date", "order_date")


def star_dimensions(lines: DataFrame) -> Tables:
    """Five flat dimensions."""
    return {
        "time_dim": dim_time(lines, DATES),
        "customer_dim": dim(lines, ["customer_name", "segment"], "customer_id"),
        "product_dim": first_per_key(lines, "product_id", PRODUCT_ATTRIBUTES, LINE_ORDER),
        "location_dim": dim(lines, PLACE, "location_id"),
        "shipping_dim": dim(lines, SHIPPING, "ship_mode_id"),
    }


def _star_lookups(dims: Tables) -> dict[str, Lookup]:
    return {
        "customer": Lookup(dims["customer_dim"], ["customer_name", "segment"], "customer_id"),
        "location": Lookup(dims["location_dim"], PLACE, "location_id"),
        "shipping": Lookup(dims["shipping_dim"], SHIPPING, "ship_mode_id"),
    }


def star_facts(lines: DataFrame | ByParent, dims: Tables) -> Tables:
    """One fact for everything, dated by order."""
    measures = [*SALES_MEASURES, "shipping_cost"]
    rows = fact(
        lines, F.col("order_date"), dims["time_dim"], "date_id", list(_star_lookups(dims).values()), ["product_id"], measures, "year"
    )
    return {"fact_table": number_rows(rows, "fact_id")}


def galaxy_facts(lines: DataFrame | ByParent, dims: Tables) -> Tables:
    """A sales fact dated by order and a shipping fact dated by shipment, on shared dimensions."""
    by = _star_lookups(dims)
    sales = fact(
        lines, F.col("order_date"), dims["time_dim"], "date_id", [by["customer"], by["location"]], ["product_id"], SALES_MEASURES, "year"
    )
    shipping = fact(
        lines, _ship_or_order_date(), dims["time_dim"], "date_id", [by["location"], by["shipping"]], ["product_id"], ["shipping_cost"], "year"
    )
    return {"fact_sales": number_rows(sales, "fact_sales_id"), "fact_shipping": number_rows(shipping, "fact_shipping_id")}


def snowflake_dimensions(lines: DataFrame) -> Tables:
    """Normalised dimensions: each level holds its own value and its parent's key.

    Each hierarchy is reduced to its stored distinct combinations first, so the lines are scanned once per hierarchy.
    """
    people = stored(lines.select("customer_name", "segment").distinct(), "combinations")
    places = stored(lines.select(*PLACE).distinct(), "combinations")
    kinds = stored(lines.select("category", "sub_category").distinct(), "combinations")
    handling = stored(lines.select(*SHIPPING).distinct(), "combinations")

    segment = dim(people, ["segment"], "segment_id")
    customer = child_dim(people, "customer_name", ["segment"], segment, "segment_id", "customer_id")
    category = dim(kinds, ["category"], "category_id")
    sub_category = child_dim(kinds, "sub_category", ["category"], category, "category_id", "sub_category_id")
    products = first_per_key(lines, "product_id", PRODUCT_ATTRIBUTES, LINE_ORDER)
    product = products.join(sub_category.select("sub_category", "category", "sub_category_id"), ["sub_category", "category"])
    country = dim(places, ["country"], "country_id")
    region = child_dim(places, "region", ["country"], country, "country_id", "region_id")
    market = child_dim(places, "market", ["region", "country"], region, "region_id", "market_id")
    state = child_dim(places, "state", ["market", "region", "country"], market, "market_id", "state_id")
    return {
        "time_dim": dim_time(lines, DATES),
        "segment_dim": segment,
        "customer_dim": customer.select("customer_id", "customer_name", "segment_id"),
        "category_dim": category,
        "sub_category_dim": sub_category.select("sub_category_id", "sub_category", "category_id"),
        "product_dim": product.select("product_id", "product_name", "sub_category_id"),
        "country_dim": country,
        "region_dim": region.select("region_id", "region", "country_id"),
        "market_dim": market.select("market_id", "market", "region_id"),
        "state_dim": state.select("state_id", "state", "market_id"),
        "ship_mode_dim": dim(handling, ["ship_mode"], "ship_mode_id"),
        "order_priority_dim": dim(handling, ["order_priority"], "order_priority_id"),
    }


def customers_of(tables: Tables) -> DataFrame:
    """Customers with their segment."""
    return tables["customer_dim"].join(tables["segment_dim"], "segment_id").drop("segment_id")


def products_of(tables: Tables) -> DataFrame:
    """Products with sub-category and category."""
    kinds = tables["sub_category_dim"].join(tables["category_dim"], "category_id").drop("category_id")
    return tables["product_dim"].join(kinds, "sub_category_id").drop("sub_category_id")


def states_of(tables: Tables) -> DataFrame:
    """States with market, region and country."""
    regions = tables["region_dim"].join(tables["country_dim"], "country_id").drop("country_id")
    markets = tables["market_dim"].join(regions, "region_id").drop("region_id")
    return tables["state_dim"].join(markets, "market_id").drop("market_id")


def snowflake_facts(lines: DataFrame | ByParent, dims: Tables) -> Tables:
    """Sales by order date, customer, product and state; shipping by ship date, product, state, mode and priority."""
    state = Lookup(states_of(dims), PLACE, "state_id")
    sales = fact(
        lines,
        F.col("order_date"),
        dims["time_dim"],
        "order_date_id",
        [Lookup(customers_of(dims), ["customer_name", "segment"], "customer_id"), state],
        ["product_id"],
        SALES_MEASURES,
        "year",
    )
    shipping = fact(
        lines,
        _ship_or_order_date(),
        dims["time_dim"],
        "ship_date_id",
        [
            state,
            Lookup(dims["ship_mode_dim"], ["ship_mode"], "ship_mode_id"),
            Lookup(dims["order_priority_dim"], ["order_priority"], "order_priority_id"),
        ],
        ["product_id"],
        ["shipping_cost"],
        "year",
    )
    return {"fact_sales": number_rows(sales, "fact_sales_id"), "fact_shipping": number_rows(shipping, "fact_shipping_id")}


def build_schema(
    spark: SparkSession,
    lines: DataFrame,
    path: str,
    dimensions: Callable[[DataFrame], Tables],
    facts: Callable[[DataFrame, Tables], Tables],
) -> Tables:
    """Write a schema and return its tables.

    Dimensions are written and read back before the facts, so their real sizes decide how each lookup is joined.
    """
    dims = dimensions(lines)
    write_warehouse(dims, path, {})
    stored = read_marts(spark, path, list(dims))
    rows = facts(lines, stored)
    write_warehouse(rows, path, {name: ["year"] for name in rows})
    return stored | read_marts(spark, path, list(rows))


SCHEMAS = {
    "star": (star_dimensions, star_facts),
    "snowflake": (snowflake_dimensions, snowflake_facts),
    "galaxy": (star_dimensions, galaxy_facts),
}


def flat_sales(tables: Tables, paths: Sequence[str] = ("time", "customer", "product", "state")) -> DataFrame:
    """Sales facts of the snowflake schema with the attributes of just the named paths."""
    available = {
        "time": lambda: (tables["time_dim"].withColumnRenamed("date", "order_date"), "order_date_id", "date_id"),
        "state": lambda: (stored(states_of(tables), "states"), "state_id", "state_id"),
        "customer": lambda: (stored(customers_of(tables), "customers"), "customer_id", "customer_id"),
        "product": lambda: (stored(products_of(tables), "products"), "product_id", "product_id"),
    }
    return flat(tables["fact_sales"], _smallest_first(available, paths))


def flat_shipping(tables: Tables, paths: Sequence[str] = ("time", "product", "state", "mode", "priority")) -> DataFrame:
    """Shipping facts of the snowflake schema with the attributes of just the named paths."""
    available = {
        "mode": lambda: (tables["ship_mode_dim"], "ship_mode_id", "ship_mode_id"),
        "priority": lambda: (tables["order_priority_dim"], "order_priority_id", "order_priority_id"),
        "time": lambda: (tables["time_dim"].withColumnRenamed("date", "ship_date"), "ship_date_id", "date_id"),
        "state": lambda: (stored(states_of(tables), "states"), "state_id", "state_id"),
        "product": lambda: (stored(products_of(tables), "products"), "product_id", "product_id"),
    }
    return flat(tables["fact_shipping"], _smallest_first(available, paths))


def _smallest_first(available: dict, paths: Sequence[str]) -> dict:
    """The named paths, small dimensions first: what they filter out need not be shuffled for the large ones.

    A hierarchy is stored, so that its size is known: of a join it is guessed as the product of its tables' sizes, and the
    facts would be shuffled for a table of a hundred rows.
    """
    return {name: make() for name, make in available.items() if name in paths}
