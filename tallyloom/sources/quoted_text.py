"""Delimited text with line breaks inside quotes, read by many tasks per file.

A line break ends a record where an even number of quotes stands before it.  So a first pass over all splits notes, for
each, whether its quotes are odd in number and what its edges would be if it began outside quotes or inside.  The
parities of all earlier splits of the file then say which of the two is true, and a second pass puts the records inside
each split together; a record that reaches over splits is put together from their edges.

The driver sees a few numbers for each split, as it does when it plans the scan.  No task holds more than a split, and no
line is shuffled but those of edges inside quotes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.session import stored

_OPTIONS = {"escape": '"', "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}
_EDGES = "file string, block long, odd boolean, starts0 boolean, starts1 boolean, head1 string, tail0 string, tail1 string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    place = F.col("_metadata")
    return spark.read.text(path, lineSep="\n").select(
        "value", place["file_path"].alias("file"), place["file_block_start"].alias("block")
    )


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator[str]]]:
    """(file, block) and the lines of each split, in order; a task reads its splits one after the other."""

    def rows():
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    stream = rows()
    held = next(stream, None)
    while held is not None:
        key = held[1:]

        def own():
            nonlocal held
            while held is not None and held[1:] == key:
                yield held[0]
                held = next(stream, None)

        lines = own()
        yield key, lines
        for _ in lines:  # what was not asked for
            pass


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each split: see `_EDGES`.  `starts`, `head` and `tail` are told for a beginning outside (0) and inside
    quotes (1): whether a record begins, the lines before the first that does, the lines of one that does not end."""
    for (file, block), lines in _splits(batches):
        parity, starts, head = 0, [False, False], []
        open_at: list[list[str] | None] = [None, None]
        for line in lines:
            for begun in (0, 1):
                if parity == begun:  # even with what was begun
                    starts[begun], open_at[begun] = True, []
                if open_at[begun] is not None:
                    open_at[begun].append(line)
            if not starts[1]:
                head.append(line)
            parity ^= line.count('"') & 1
        tails = ["\n".join(lines) if lines is not None and parity ^ begun else None for begun, lines in enumerate(open_at)]
        row = (file, block, bool(parity), *starts, "\n".join(head), *tails)
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row[:-3]] + [pa.array([x], pa.string()) for x in row[-3:]],
                                         names=[c.split()[0] for c in _EDGES.split(", ")])


def records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """(record): the text of every record of the files at `path`, without each file's first where that is a header.

    A header must end in the first split of its file.
    """
    told = stored(_lines(spark, path).mapInArrow(_edges, _EDGES), "text-edges")
    inside: dict[tuple[str, int], bool] = {}
    first: dict[str, int] = {}
    owners: list[tuple[str, int, bool, int]] = []
    before, odd, last = None, False, 0
    for row in told.select("file", "block", "odd", "starts0", "starts1").orderBy("file", "block").toLocalIterator():
        if row["file"] != before:
            before, odd, last = row["file"], False, row["block"]
            first[before] = last
        key = (row["file"], row["block"])
        inside[key] = odd
        owners.append((*key, odd, last))
        if row["starts1"] if odd else row["starts0"]:
            last = row["block"]
        odd ^= row["odd"]
    known = spark.sparkContext.broadcast(inside)  # one entry for each split

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, block), lines in _splits(batches):
            if (file, block) not in known.value:
                raise ValueError(f"{file} is split otherwise than before; keep spark.sql.files settings as they are")
            parity, own, out, skip = int(known.value[file, block]), None, [], header and block == first[file]
            for line in lines:
                if not parity:
                    own = []
                if own is not None:
                    own.append(line)
                parity ^= line.count('"') & 1
                if not parity:
                    if own is not None:
                        if not skip:
                            out.append("\n".join(own))
                        skip = False
                    own = None
                if len(out) >= 1_000:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["record"])
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["record"])

    complete = _lines(spark, path).mapInArrow(whole, "record string")
    if not any(inside.values()):
        return _tidy(complete)
    schema = "file string, block long, inside boolean, owner long"
    edges = told.join(spark.createDataFrame(owners, schema), ["file", "block"])
    heads = edges.where("inside").select("file", "owner", "block", F.lit(0).alias("part"), F.col("head1").alias("text"))
    tails = edges.select(
        "file", F.col("block").alias("owner"), "block", F.lit(1).alias("part"), F.when(F.col("inside"), F.col("tail1")).otherwise(F.col("tail0")).alias("text")
    ).where("text IS NOT NULL")
    pieces = heads.unionByName(tails).groupBy("file", "owner").agg(F.array_sort(F.collect_list(F.struct("block", "part", "text"))).alias("p"))
    over = pieces.select(F.array_join(F.transform("p", lambda x: x["text"]), "\n").alias("record"))
    return _tidy(complete.unionByName(over))


def _tidy(found: DataFrame) -> DataFrame:
    """Records with plain line breaks, without empty ones."""
    text = F.regexp_replace(F.regexp_replace("record", "\r\n", "\n"), "\r$", "")
    return found.select(text.alias("record")).where("trim(record) <> ''")


def read_quoted_text(spark: SparkSession, path: str) -> DataFrame:
    """A table of delimited text with a header, every column as text; quoted values may hold line breaks and doubled quotes."""
    names = spark.read.options(header=True, inferSchema=False, multiLine=True, **_OPTIONS).csv(path).columns
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
    ddl = ", ".join(f"{f.name} string" for f in schema)
    parsed = records(spark, path).select(F.from_csv("record", ddl, _OPTIONS).alias("r"))
    return parsed.select("r.*").toDF(*names)
