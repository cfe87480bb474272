"""Session helpers: where intermediate tables go."""

from __future__ import annotations

import itertools
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, tempfile.TemporaryDirectory] = {}
_NUMBERS = itertools.count(1)


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors can reach: the one the cluster names in spark.checkpoint.dir, else one in
    the warehouse.

    Only a session that runs in one process (as in tests) may use a temporary folder of this machine; on a cluster where
    neither setting names a shared file system, this is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if re.fullmatch(r"local(\[.*\])?", context.master):
        if context.applicationId not in _LOCAL_DIRS:
            _LOCAL_DIRS[context.applicationId] = tempfile.TemporaryDirectory(prefix="tallyloom-")  # goes with the process
        return _LOCAL_DIRS[context.applicationId].name
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if warehouse.startswith(("file:", "/")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{warehouse.rstrip('/')}/_work"


def work_dir(spark: SparkSession, name: str) -> str:
    """A folder of this application's own inside the shared folder."""
    return f"{shared_dir(spark)}/tallyloom/{spark.sparkContext.applicationId}/{name}"


def work_name(name: str) -> str:
    """A name that no other intermediate table of this process has."""
    return f"{name}-{next(_NUMBERS)}"


def stored(df: DataFrame, name: str, slot: str | None = None) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    For a frame that several passes read: it is computed once, survives lost executors, and its real size is known to
    the joins that follow.  In a named slot it takes the place of the table of that name stored there before, which must
    not be read any more.
    """
    path = work_dir(df.sparkSession, f"stored/{slot}/{name}" if slot else f"stored/{work_name(name)}")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def stored_buckets(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """A stored intermediate table in buckets of `key`: whoever groups it by the key need not shuffle it again."""
    spark = df.sparkSession
    name = work_name(name)
    table = re.sub(r"\W", "_", f"{spark.sparkContext.applicationId}_{name}").lower()
    dealt = df.repartition(buckets, key)
    dealt.write.mode("overwrite").bucketBy(buckets, key).option("path", work_dir(spark, f"stored/{name}")).saveAsTable(table, format="parquet")
    return spark.table(table)


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for costly work on a table that may come in few files: its rows are dealt round.

    For a plain scan only; of anything else adaptive execution chooses the partitions.
    """
    files = len(df.inputFiles())
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if files < cores else df
