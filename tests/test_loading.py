"""Quoted text in splits, published schemas, and loads by batches."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyloom.plans import incremental as N
from tallyloom.plans import inputs as I
from tallyloom.plans.warehouse import build_schema, galaxy_facts, star_dimensions
from tallyloom.sources import publish as U
from tallyloom.sources.quoted_text import read_quoted_text

FOLDER = "/root/testdata/sf0.001"


# --- quoted text ---------------------------------------------------------------------------------------------------

TEXT = (
    'id, Review Text ,note\n1,plain,x\n2,"two\nlines",y\n3,"a ""quoted"" word","three\n\nmore, lines\n"\n4,"","  z "\n'
    '5,"' + "long " * 60 + "\n" * 5 + '",q\n\n6,"ends with quote""",\n7,"""starts\n""","""\n"""\n8,last,é漢\n'
)


def plain_rows(spark, path):
    options = dict(header=True, escape='"', multiLine=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    table = spark.read.options(**options).csv(path)
    return table.columns, Counter(tuple(r) for r in table.collect())


@pytest.mark.parametrize("size", [7, 16, 33, 64, 1 << 20])
def test_records_over_every_edge(spark, tmp_path, size):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(TEXT)
    (tmp_path / "in" / "b.csv").write_text(TEXT.replace("1,plain", "9,other").rstrip("\n"))
    path = str(tmp_path / "in")
    expected = plain_rows(spark, path)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        found = read_quoted_text(spark, path)
        assert (found.columns, Counter(tuple(r) for r in found.collect())) == expected
        splits = spark.read.text(path).select("_metadata.file_path", "_metadata.file_block_start").distinct().count()
        assert splits > 4 or size > 64
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value)


def test_other_line_ends(spark, tmp_path):
    (tmp_path / "w.csv").write_bytes(b'a,b\r\n1,"x\r\ny"\r\n2,z\r\n')
    found = read_quoted_text(spark, str(tmp_path / "w.csv"))
    assert (found.columns, Counter(tuple(r) for r in found.collect())) == plain_rows(spark, str(tmp_path / "w.csv"))
    (tmp_path / "h.csv").write_text("a,b\n")
    assert read_quoted_text(spark, str(tmp_path / "h.csv")).collect() == []


# --- publishing ----------------------------------------------------------------------------------------------------


def table(spark, *rows):
    return spark.createDataFrame(list(rows), "id long, name string")


def test_a_load_is_seen_whole_or_not_at_all(spark, tmp_path):
    path = f"file://{tmp_path}/schema"
    assert U.current(spark, path) == U.State() and U.read_published(spark, path) == {}
    U.publish(spark, path, {"d": table(spark, (1, "a")), "f": table(spark, (1, "x"))})
    rules = U.Rules({"d": ["id"]}, [("f", ["id"], "d", ["id"])])
    with pytest.raises(ValueError, match="repeats"):
        U.publish(spark, path, {"d": table(spark, (2, "b"), (2, "c"))}, rules=rules)
    with pytest.raises(ValueError, match="without a row"):
        U.publish(spark, path, {}, {"f": table(spark, (7, "y"))}, rules=rules)

    def fails(value):
        raise RuntimeError(value)

    broken = table(spark, (3, "c")).withColumn("name", F.udf(fails)("name"))
    with pytest.raises(Exception, match="RuntimeError"):
        U.publish(spark, path, {"d": broken, "f": table(spark, (3, "z"))})
    now = U.read_published(spark, path)
    assert now["d"].collect() == [(1, "a")] and now["f"].collect() == [(1, "x")]
    state = U.publish(spark, path, {"d": table(spark, (1, "a"), (2, "b"))}, {"f": table(spark, (2, "y"))}, rules=rules, batches=["one"])
    assert state.rows == {"d": 2, "f": 2} and U.current(spark, path) == state
    with pytest.raises(ValueError, match="loaded before"):
        U.publish(spark, path, {}, batches=["one"])
    # Readers that began before still find their rows until old folders are removed.
    assert now["d"].collect() == [(1, "a")]
    assert len(U.remove_unused(spark, path)) >= 3 and U.remove_unused(spark, path) == []
    later = U.read_published(spark, path)
    assert sorted(later["f"].collect()) == [(1, "x"), (2, "y")] and later["d"].count() == 2


# --- loads by batches ----------------------------------------------------------------------------------------------


def named_sales(tables):
    """Sales facts with natural keys in the place of ids."""
    rows = tables["fact_sales"].join(tables["time_dim"], "date_id").join(tables["customer_dim"], "customer_id")
    rows = rows.join(tables["location_dim"], "location_id").join(tables["product_dim"], "product_id")
    return rows.drop("fact_sales_id", "date_id", "customer_id", "location_id")


def as_rows(df):
    return Counter(tuple(map(str, r)) for r in df.select(*sorted(df.columns)).collect())


def test_half_loads_give_what_a_full_load_gives(spark, tmp_path):
    lines = I.order_lines(spark, FOLDER)
    path = f"file://{tmp_path}/grown"
    early, late = lines.where("year < 1998"), lines.where("year >= 1998 OR year IS NULL")
    assert set(N.load_batches(spark, path, {"nothing": lines.limit(0)}).rows.values()) == {0}
    first = N.load_batches(spark, path, {"nothing": lines.limit(0), "early": early})
    ids = {r["customer_id"]: r["customer_name"] for r in U.read_published(spark, path)["customer_dim"].collect()}
    second = N.load_batches(spark, path, {"early": early, "late": late})
    assert first.batches == ["nothing", "early"] and second.batches == ["nothing", "early", "late"]
    assert N.load_batches(spark, path, {"late": late}) == second
    grown = U.read_published(spark, path)
    full = build_schema(spark, lines, f"file://{tmp_path}/full", star_dimensions, galaxy_facts)
    assert as_rows(named_sales(grown)) == as_rows(named_sales(full))
    for name in ("customer_dim", "location_dim", "shipping_dim", "time_dim", "product_dim"):
        kept = [c for c in full[name].columns if not c.endswith("_id") or c == "product_id"]
        if name == "product_dim":
            kept = ["product_id"]  # a product's first line may be another
        assert as_rows(grown[name].select(*kept)) == as_rows(full[name].select(*kept))
    now = {r["customer_id"]: r["customer_name"] for r in grown["customer_dim"].collect()}
    assert all(now[i] == name for i, name in ids.items()) and len(now) > len(ids) > 0
    for name in ("fact_sales", "fact_shipping"):
        key = f"{name}_id"
        assert grown[name].count() == full[name].count() == grown[name].select(key).distinct().count()
    with pytest.raises(ValueError):
        N.load_batches(spark, path, {"x": lines}, "snowflake")


def test_late_attributes_are_filled_in(spark, tmp_path):
    lines = I.order_lines(spark, FOLDER).where("product_id IS NOT NULL")
    one = lines.limit(1).select("product_id").first()["product_id"]
    own = lines.where(F.col("product_id") == one)
    path = f"file://{tmp_path}/late"
    N.load_batches(spark, path, {"early": own.withColumn("product_name", F.lit(None).cast("string"))}, "star")
    assert U.read_published(spark, path)["product_dim"].collect()[0]["product_name"] is None
    N.load_batches(spark, path, {"late": own}, "star")
    assert U.read_published(spark, path)["product_dim"].collect()[0]["product_name"] is not None
