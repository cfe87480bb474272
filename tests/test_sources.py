"""Reading untidy text, and writing and reading results."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyloom.functions.columns import DISCOUNT_EDGES, DISCOUNT_LABELS, QUANTITY_EDGES, QUANTITY_LABELS, band, margin
from tallyloom.sources.order_lines import load_order_lines, normal_name
from tallyloom.sources.reviews import find_columns, load_reviews
from tallyloom.sources.tables import read_result, write_result

HEADER = " Order ID ,Order Date,ship date,Sales,Quantity,Discount,Profit,Shipping Cost,Product Name"
LINES = [
    'A1 ,1/2/2011,3/2/2011," 1,234.50 ",2,0,-10.5,1.125, Desk "x',
    "A2,13-01-2011,bad date,,x,0.2,,2,Chair",
    "A3,2011,05/01/2011,abc,3,1.1,1,, Lamp ",
]


@pytest.fixture
def lines(spark, tmp_path):
    path = tmp_path / "lines.csv"
    path.write_text("\n".join([HEADER, *LINES]) + "\n", encoding="utf8")
    return {row["order_id"]: row for row in load_order_lines(spark, str(path)).collect()}


def test_numbers_and_dates(lines):
    first, second, third = lines["A1"], lines["A2"], lines["A3"]
    assert float(first["sales"]) == 1234.5 and first["order_date"] == dt.date(2011, 2, 1)
    assert second["order_date"] == dt.date(2011, 1, 13) and second["ship_date"] is None
    assert second["sales"] is None and second["quantity"] is None and second["profit"] is None
    assert third["order_date"] is None and third["sales"] is None and third["shipping_cost"] is None
    assert third["product_name"] == "Lamp"


def test_derived_columns(lines):
    assert lines["A1"]["ship_days"] == 2 and lines["A1"]["is_loss"] is True
    assert lines["A1"]["discount_band"] == "No discount" and lines["A3"]["discount_band"] is None
    assert lines["A2"]["ship_days"] is None and lines["A2"]["is_loss"] is False
    assert lines["A2"]["profit_margin"] == 0.0  # no sales


def test_names():
    assert normal_name("  Ship Mode ") == "ship_mode"


def test_bands_are_closed_on_the_right(spark):
    values = [0.0, 0.2, 0.4, 0.41, 1.0, 1.1, -1.0]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    found = [row[0] for row in frame.select(band(F.col("v"), DISCOUNT_EDGES, DISCOUNT_LABELS)).collect()]
    high = "High discount"
    assert found == ["No discount", "Low discount", "Medium discount", high, high, None, None]
    counts = spark.createDataFrame([(v,) for v in (0, 1, 5, 6, 10, 100, 101)], "v int")
    found = [row[0] for row in counts.select(band(F.col("v"), QUANTITY_EDGES, QUANTITY_LABELS)).collect()]
    assert found == [None, "Low", "Low", "Medium", "Medium", "High", None]


def test_margin_without_sales(spark):
    frame = spark.createDataFrame([(5.0, 0.0), (5.0, -2.0), (5.0, 10.0), (None, 10.0)], "p double, s double")
    assert [row[0] for row in frame.select(margin(F.col("p"), F.col("s"))).collect()] == [0.0, 0.0, 0.5, None]


def test_reviews_with_line_breaks_and_unnamed_text(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text('Comment,Sentiment,customer_rating\n" two\nlines, ""quoted"" ",Positive,4\n,negative,1\n', encoding="utf8")
    rows = load_reviews(spark, str(path)).collect()
    assert [(r["review_text"], r["sentiment"], r["customer_rating"]) for r in rows] == [('two\nlines, "quoted"', "Positive", 4.0)]


def test_no_review_column(spark):
    with pytest.raises(ValueError):
        find_columns(spark.createDataFrame([(1,)], "sentiment int"))


@pytest.mark.parametrize("format", ["parquet", "json", "csv"])
def test_result_round_trip(spark, tmp_path, format):
    frame = spark.createDataFrame([("a, b\nc", 1, dt.date(2020, 1, 2)), ('"q"', None, None)], "t string, n int, d date")
    path = str(tmp_path / format)
    write_result(frame, path, format)
    back = read_result(spark, path, frame.schema, format)
    assert sorted(map(str, back.collect())) == sorted(map(str, frame.collect()))


def test_nested_result_as_text(spark, tmp_path):
    frame = spark.createDataFrame([(["x", "y"],)], "words array<string>")
    write_result(frame, str(tmp_path / "n"), "csv")
    assert spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "n")).first()["words"] == '["x","y"]'


def test_missing_result_is_empty(spark, tmp_path):
    assert read_result(spark, str(tmp_path / "none"), spark.range(1).schema).count() == 0
