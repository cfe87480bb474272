"""Warehouse schemas that are replaced at once, and grow by loads.

A schema's tables lie in folders of their own, and one small file, `current.json`, names the folders that make up each
table, their row counts, and the batches they were loaded from.  A load writes new folders, checks them, and then replaces
that file by one rename: readers see the schema as before or after, never between.  A load that stops midway leaves
folders that nothing names; `remove_unused` deletes those and folders of earlier states.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyloom.operators.dimensions import check_foreign_key, check_unique
from tallyloom.sources.tables import table_sizes, write_warehouse

POINTER = "current.json"
DATA = "data"


@dataclass(frozen=True)
class State:
    """What makes up a published schema: folders, rows and schema (as JSON) of each table, and the batches loaded."""

    folders: dict[str, list[str]] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)
    schemas: dict[str, str] = field(default_factory=dict)
    batches: list[str] = field(default_factory=list)


@dataclass(frozen=True)
class Rules:
    """Keys that must be unique (table to columns), and keys that must have a parent (table, columns, parent, columns)."""

    unique: Mapping[str, Sequence[str]] = field(default_factory=dict)
    parents: Sequence[tuple[str, Sequence[str], str, Sequence[str]]] = ()


def current(spark: SparkSession, path: str) -> State:
    """The published state; an empty one if nothing was published."""
    try:
        row = spark.read.text(f"{path}/{POINTER}", wholetext=True).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return State()
    return State(**json.loads(row["value"]))


def read_published(spark: SparkSession, path: str, state: State | None = None) -> dict[str, DataFrame]:
    """All tables of the published schema."""
    state = state or current(spark, path)
    return {name: read_table(spark, path, state, name) for name in state.folders}


def read_table(spark: SparkSession, path: str, state: State, name: str) -> DataFrame:
    """One table out of the folders that make it up; each may be laid out by partition columns, or hold no row."""
    schema = T.StructType.fromJson(json.loads(state.schemas[name]))
    tables = [spark.read.schema(schema).parquet(f"{path}/{DATA}/{folder}").select(schema.names) for folder in state.folders[name]]
    out = tables[0]
    for more in tables[1:]:
        out = out.unionByName(more)
    return out


def publish(
    spark: SparkSession,
    path: str,
    replaced: Mapping[str, DataFrame],
    added: Mapping[str, DataFrame] | None = None,
    partitioned_by: Mapping[str, Sequence[str]] | None = None,
    rules: Rules = Rules(),
    batches: Sequence[str] = (),
) -> State:
    """Replace tables, add rows to others, and name the batches they come from, all at once.

    `replaced` tables take the place of published ones; rows of `added` join those that are there.  Tables of neither
    stay.  Broken rules are an error, and the published state is left as it is.
    """
    before, load, added = current(spark, path), uuid.uuid4().hex, dict(added or {})
    again = sorted(set(batches) & set(before.batches))
    if again:
        raise ValueError(f"loaded before: {again}")
    fresh = {**replaced, **added}
    write_warehouse(fresh, f"{path}/{DATA}/{load}", dict(partitioned_by or {}))
    schemas = dict(before.schemas) | {name: table.schema.json() for name, table in fresh.items()}
    new = State({name: [f"{load}/{name}"] for name in fresh}, schemas=schemas)
    written = {name: read_table(spark, path, new, name) for name in fresh}
    counts = {r["table_name"]: r["row_count"] for r in table_sizes(written).collect()}
    folders, rows = dict(before.folders), dict(before.rows)
    for name in fresh:
        older = before.folders.get(name, []) if name in added else []
        folders[name] = [*older, f"{load}/{name}"]
        rows[name] = counts[name] + (before.rows.get(name, 0) if older else 0)
    state = State(folders, rows, schemas, [*before.batches, *batches])
    _check(spark, path, state, written, rules)
    _replace(spark, f"{path}/{POINTER}", json.dumps(state.__dict__, indent=1))
    return state


def _check(spark: SparkSession, path: str, state: State, written: Mapping[str, DataFrame], rules: Rules) -> None:
    """Keys of replaced tables and of added rows against the state to be; what was published before is not read again."""
    for name, key in rules.unique.items():
        if name in written and not check_unique(written[name], key).isEmpty():
            raise ValueError(f"{name}: {list(key)} repeats")
    for name, key, parent, parent_key in rules.parents:
        if name in written:
            known = written[parent] if parent in written else read_table(spark, path, state, parent)
            if not check_foreign_key(written[name], known, key, parent_key).isEmpty():
                raise ValueError(f"{name}: {list(key)} without a row of {parent}")


def _replace(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in the place of another by one rename, on the file system that the path names."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fresh = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    conf = spark._jsc.hadoopConfiguration()
    stream = target.getFileSystem(conf).create(fresh)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.makeQualified(target.getFileSystem(conf)).toUri(), conf)
    context.rename(fresh, target, overwrite)


def remove_unused(spark: SparkSession, path: str) -> list[str]:
    """Delete the folders that the published state does not name, and tell which; not while a load or an old reader runs."""
    kept = {folder.split("/")[0] for folders in current(spark, path).folders.values() for folder in folders}
    used = {folder for folders in current(spark, path).folders.values() for folder in folders}
    data = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{DATA}")
    files = data.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for load in files.listStatus(data) if files.exists(data) else ():
        name = load.getPath().getName()
        if name not in kept:
            files.delete(load.getPath(), True)
            gone.append(name)
            continue
        for table in files.listStatus(load.getPath()):
            folder = f"{name}/{table.getPath().getName()}"
            if folder not in used:
                files.delete(table.getPath(), True)
                gone.append(folder)
    return sorted(gone)
