"""Helpers shared by the operators: typed mapping over Arrow batches, stored tables, batch sizes."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyloom.session import stored

#: Most bytes of one Arrow batch (a longer row is a batch of its own): a task process works on several times that.
BATCH_BYTES = 2 << 20
#: Words of a sieve, as a power of two: 16 million bits, 10 % of which two million keys set.
SIEVE_BITS = 18


def find_package(df: DataFrame) -> None:
    """Let Python workers that don't have this package installed find it where the driver has it."""
    environment = df.sparkSession.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    if root not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, environment.get("PYTHONPATH")]))


def small_batches(df: DataFrame) -> None:
    """Bound the bytes that Python tasks of this session take at a time, because texts and indexes can be long."""
    name, conf = "spark.sql.execution.arrow.maxBytesPerBatch", df.sparkSession.conf
    set_to = (conf.get(name, None) or "").rstrip("bB")
    if not (set_to.isdigit() and int(set_to) <= BATCH_BYTES):
        conf.set(name, str(BATCH_BYTES))


def map_columns(
    df: DataFrame, schema: str, compute: Callable[..., Sequence], needs: Sequence[str], keep: Sequence[str] | None = None
) -> DataFrame:
    """`keep` columns (all if None) with the columns of `schema` added, worked out batch by batch.

    `compute` takes the batch's `needs` columns as lists and returns one sequence per added column.  A kept column
    with the name of an added one gives way to it, whatever its case.
    """
    added = T.StructType.fromDDL(schema)
    taken = {f.name.lower() for f in added}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in taken]
    inputs = [F.col(f"`{c}`").alias(f"_in{i}") for i, c in enumerate(needs)]
    source = df.select(*[F.col(f"`{c}`") for c in kept], *inputs)
    out = T.StructType([*source.select(*[f"`{c}`" for c in kept]).schema.fields, *added.fields])
    arrow = to_arrow_schema(added)
    n = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            results = compute(*[batch.column(n + i).to_pylist() for i in range(len(needs))])
            new = [
                r if isinstance(r, pa.Array) else pa.array(r, type=field.type) for r, field in zip(results, arrow, strict=True)
            ]
            columns = [batch.column(i) for i in range(n)] + new
            fields = [batch.schema.field(i) for i in range(n)] + list(arrow)
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields))

    find_package(df)
    small_batches(df)
    return source.mapInArrow(run, out)


def sifted(rows: DataFrame, few: DataFrame, keys: Sequence[str], word_bits: int = SIEVE_BITS) -> DataFrame:
    """The rows whose keys may be among those of `few`: all that are, and a share of others that grows with `few` over
    64 * 2**word_bits bits.

    The bits are a table of at most 2**word_bits words (4 MB), small enough to be sent to every task at any size of the
    input: rows that meet nothing need not be shuffled to learn it.
    """
    mark = F.xxhash64(*[F.col(f"`{c}`") for c in keys])
    word, bit = mark.bitwiseAND((1 << word_bits) - 1), F.shiftrightunsigned(mark, 58).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    words = stored(few.select(word.alias("_word"), one.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits")), "sieve")
    met = rows.withColumn("_word", word).join(F.broadcast(words), "_word")
    return met.where(F.col("_bits").bitwiseAND(one) != 0).select(*[f"`{c}`" for c in rows.columns])


def text_key(text: str | Column = "text") -> Column:
    """128 bits that stand for a text: rows with equal texts share it; null for a null text."""
    return F.unhex(F.md5(text if isinstance(text, Column) else F.col(f"`{text}`")))


def remainder(key: str, modulus: int) -> Column:
    """crc32 of a column as text, modulo `modulus`; null for null."""
    return F.pmod(F.crc32(F.col(f"`{key}`").cast("string")), F.lit(modulus))
