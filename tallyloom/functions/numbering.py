"""Dense numbers in value order without a window over the whole table."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import stored


def numbered(df: DataFrame, by: Sequence[str], name: str = "number", first: int = 0, parts: int | None = None) -> DataFrame:
    """Rows of `df` numbered from `first` in ascending order of `by` (nulls first), which should tell rows apart.

    Rows are dealt to ranges of the order and stored with their range, ranges are counted (the driver sees one count
    each), and each range numbers its own rows after all earlier ones.  Rows equal in all of `by` share a range and are
    numbered in any order.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(f"`{c}`").asc_nulls_first() for c in by]
    dealt = stored(df.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()), "numbered")
    sizes = {r["_range"]: r["count"] for r in dealt.groupBy("_range").count().collect()}
    ranges = sorted(sizes)
    starts = dict(zip(ranges, accumulate([first, *(sizes[r] for r in ranges)]), strict=False))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    if not starts:
        return dealt.withColumn(name, F.lit(first).cast("long")).drop("_range")
    start = F.create_map(*[F.lit(v) for pair in starts.items() for v in pair])
    return dealt.withColumn(name, (F.element_at(start, F.col("_range")) + place).cast("long")).drop("_range")


def dense_ranks(df: DataFrame, by: Sequence[str], name: str = "number", first: int = 0, parts: int | None = None) -> DataFrame:
    """The distinct values of `by`, numbered in order: each value's dense rank."""
    return numbered(df.select(*[F.col(f"`{c}`") for c in by]).distinct(), by, name, first, parts)
