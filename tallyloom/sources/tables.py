"""Result and warehouse tables on shared storage."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_result(df: DataFrame, path: str, format: str = "parquet") -> None:
    """Replace a result table; nested columns become JSON text where the format is delimited text."""
    writer = df
    if format == "csv":
        nested = (T.ArrayType, T.StructType, T.MapType)
        writer = df.select(
            *[
                (F.to_json(f.name) if isinstance(f.dataType, nested) else F.col(f.name)).alias(f.name)
                for f in df.schema.fields
            ]
        )
    options = {"header": True, "escape": '"'} if format == "csv" else {}
    writer.write.mode("overwrite").options(**options).format(format).save(path)


def read_result(spark: SparkSession, path: str, schema: T.StructType, format: str = "parquet") -> DataFrame:
    """Read a result table back; an empty table of the same schema if it was never written."""
    options = {"header": True, "escape": '"', "multiLine": True} if format == "csv" else {}
    try:
        table = spark.read.schema(schema).options(**options).format(format).load(path)
        table.schema  # noqa: B018  where plans are made late, this is what looks for the path
        return table
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_warehouse(tables: dict[str, DataFrame], path: str, partitioned_by: dict[str, Sequence[str]]) -> None:
    """Replace all tables of a schema, a few jobs at a time; `partitioned_by` lays out the facts by year.

    Every task writes its own file of each year: dealing the rows by year first would be a shuffle of all facts, and
    tasks after a join are as few as adaptive execution leaves.
    """

    def write(name: str) -> None:
        keys = partitioned_by.get(name, ())
        writer = tables[name].write.mode("overwrite").option("compression", "zstd")
        if keys:
            writer = writer.partitionBy(*keys)
        writer.parquet(f"{path}/{name}")

    session = next(iter(tables.values())).sparkSession
    with ThreadPool(4) as pool:
        pool.map(inheritable_thread_target(session)(write), list(tables))


def read_marts(spark: SparkSession, path: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """The named tables of a warehouse schema."""
    return {name: spark.read.parquet(f"{path}/{name}") for name in names}


def table_sizes(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of every table, as one query."""
    counts = [
        table.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, table in tables.items()
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result
