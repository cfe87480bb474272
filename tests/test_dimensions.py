"""Dimensions, keys, facts and checks on small literal tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tallyloom.operators import dimensions as D
from tallyloom.operators import olap as O
from tallyloom.plans.warehouse import SCHEMAS, build_schema, flat_sales

COLUMNS = (
    "order_id string, line_number int, order_date date, ship_date date, ship_mode string, customer_name string, segment string, "
    "state string, country string, market string, region string, product_id string, category string, sub_category string, "
    "product_name string, sales decimal(15,4), quantity int, discount decimal(15,4), profit decimal(15,4), "
    "shipping_cost decimal(15,4), order_priority string"
)


def line(order, number, **changes):
    row = {
        "order_id": order, "line_number": number, "order_date": dt.date(2020, 1, 5), "ship_date": dt.date(2020, 1, 9),
        "ship_mode": "First Class", "customer_name": "Ann", "segment": "Consumer", "state": "S", "country": "C",
        "market": "M", "region": "R", "product_id": "P1", "category": "Technology", "sub_category": "Phones",
        "product_name": "Old", "sales": 10, "quantity": 1, "discount": 0, "profit": 1, "shipping_cost": 2,
        "order_priority": "High",
    }
    return {**row, **changes}


def table(spark, rows):
    from decimal import Decimal

    fields = [part.split()[0] for part in COLUMNS.split(", ")]
    money = {"sales", "discount", "profit", "shipping_cost"}
    values = [tuple(Decimal(r[f]) if f in money and r[f] is not None else r[f] for f in fields) for r in rows]
    return spark.createDataFrame(values, COLUMNS)


def sample(spark):
    return table(
        spark,
        [
            line("A", 1),
            line("A", 2, product_name="New"),  # same product under a second name
            line("B", 1, customer_name=None),  # no customer
            line("C", 1, ship_date=None, state="T", ship_mode="Same Day"),
            line("D", 1, order_date=None),
            line("E", 1, customer_name="Bob", region="R2", product_id="P2", product_name="Else", sub_category="Copiers"),
        ],
    )


def test_first_name_wins(spark):
    products = D.first_per_key(sample(spark), "product_id", ["product_name"], ["order_id", "line_number"])
    assert {r["product_id"]: r["product_name"] for r in products.collect()} == {"P1": "Old", "P2": "Else"}


def test_first_present_skips_missing(spark):
    frame = spark.createDataFrame([("k", 1, None), ("k", 2, "b"), ("k", 3, "a")], "k string, o int, v string")
    assert frame.groupBy("k").agg(D.first_present("v", ["o"]).alias("v")).first()["v"] == "b"


def test_surrogate_keys_are_dense_and_repeatable(spark):
    names = spark.range(3000).select(F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"))
    once = {r["name"]: r["name_id"] for r in D.dim(names, ["name"], "name_id").collect()}
    again = {r["name"]: r["name_id"] for r in D.dim(names.repartition(5), ["name"], "name_id").collect()}
    assert sorted(once.values()) == list(range(1, 3001)) and once == again


def test_insert_new_only_keeps_old_keys(spark):
    frame = sample(spark)
    old = D.dim(frame.where("customer_name = 'Ann'"), ["customer_name", "segment"], "customer_id")
    merged = D.insert_new_only(old, frame, ["customer_name", "segment"], "customer_id")
    assert {r["customer_name"]: r["customer_id"] for r in merged.collect()} == {"Ann": 1, "Bob": 2}
    again = D.insert_new_only(merged, frame, ["customer_name", "segment"], "customer_id")
    assert again.count() == 2


def test_facts_drop_what_cannot_be_keyed(spark, tmp_path):
    frame = sample(spark)
    for name, (dimensions, facts) in SCHEMAS.items():
        tables = build_schema(spark, frame, str(tmp_path / name), dimensions, facts)
        if name == "star":
            assert tables["fact_table"].count() == 4  # no customer, no order date
        else:
            assert tables["fact_sales"].count() == 4
            assert tables["fact_shipping"].count() == 6  # needs no customer; dated by order where not shipped
            date_id = "ship_date_id" if name == "snowflake" else "date_id"
            dated = tables["fact_shipping"].withColumnRenamed(date_id, "d").join(tables["time_dim"], F.col("d") == F.col("date_id"))
            assert dated.where(F.col("date") == dt.date(2020, 1, 5)).count() == 1


def test_snowflake_children_are_unique_within_parents(spark, tmp_path):
    dimensions, facts = SCHEMAS["snowflake"]
    tables = build_schema(spark, sample(spark), str(tmp_path / "s"), dimensions, facts)
    assert tables["region_dim"].count() == 2 and tables["market_dim"].count() == 2 and tables["country_dim"].count() == 1
    assert tables["state_dim"].count() == 3
    assert D.check_foreign_key(tables["fact_sales"], tables["state_dim"], ["state_id"], ["state_id"]).count() == 0
    flat = flat_sales(tables)
    assert flat.count() == tables["fact_sales"].count()
    assert {r["region"] for r in flat.select("region").distinct().collect()} == {"R", "R2"}


def test_checks(spark):
    frame = sample(spark)
    assert D.check_unique(frame, ["order_id"]).collect()[0]["copies"] == 2
    found = {r["column_name"]: (r["missing"], r["too_long"]) for r in D.check_not_null_len(frame, {"customer_name": 2, "ship_date": None}).collect()}
    assert found == {"customer_name": (1, 5), "ship_date": (1, 0)}


def test_drill_across_equals_the_row_join(spark):
    sales = spark.createDataFrame([(1, "p", "x", 5), (1, "p", "x", 7), (2, "p", "y", 1), (3, "q", "x", 9)], "s int, p string, g string, v int")
    ships = spark.createDataFrame([(1, "p", "x", 1), (1, "p", "x", 2), (1, "p", "x", 3), (2, "p", "y", 4)], "s int, p string, g string, v int")
    sales = sales.select("s", "p", "g", F.col("v").cast("decimal(15,2)").alias("sales"))
    ships = ships.select("s", "p", "g", F.col("v").cast("decimal(15,3)").alias("shipping_cost"))
    joined = (
        sales.join(ships.drop("g"), ["s", "p"]).groupBy("g").agg(F.sum("sales").alias("a"), F.sum("shipping_cost").alias("b")).collect()
    )
    ours = O.drill_across(sales, ships, ["s", "p"], "g", 10).collect()
    assert {r["g"]: (float(r["total_sales"]), float(r["total_shipping"])) for r in ours} == {
        r["g"]: (float(r["a"]), float(r["b"])) for r in joined
    }
    safe = {r["g"]: float(r["total_sales"]) for r in O.drill_across(sales, ships, ["s"], "g", 10, safe=True).collect()}
    assert safe == {"x": 21.0, "y": 1.0}


def test_filters_and_constant_metric(spark):
    frame = spark.createDataFrame([("a", 1.0, 2.0), ("b", 2.0, 2.0)], "k string, x double, y double")
    assert O.filter_in_lists(frame, {"k": []}).count() == 0
    assert O.filter_in_lists(frame, {"k": None}).count() == 2
    matrix = {r["metric"]: r for r in O.metric_correlation(frame, ["x", "y"]).collect()}
    assert abs(matrix["x"]["x"] - 1) < 1e-12 and matrix["x"]["y"] is None and matrix["y"]["y"] is None


def test_hierarchy_parents_sum_their_children(spark):
    frame = spark.createDataFrame([("a", "b", 1), ("a", "c", 2), ("d", "b", 4)], "l1 string, l2 string, sales int")
    nodes = {(r["l1"], r["l2"]): r["total_sales"] for r in O.product_hierarchy(frame, ["l1", "l2"]).collect()}
    assert nodes == {("a", None): 3, ("d", None): 4, ("a", "b"): 1, ("a", "c"): 2, ("d", "b"): 4}
