"""Published tables: silver and gold as parquet folders, or as lists of files.

A version that drops a few rows of a large table names the files it shares with
the version before and holds only those it had to write again.
"""

from __future__ import annotations

import json
import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.session import delete_path, path_exists, store

# Folder columns: what readers of a table nearly always name a value of.
PARTITIONED = {
    "identity_graph": "raw_source",
    "touch_axis": "mark",
    "fct_touchpoints": "touchpoint_date",
}
# Keys that are looked for first when rows are dropped.
PROBED = 10_000
# Tables with many folder values: rows are gathered by value before writing, or
# each task would leave a small file in every folder. Adaptive execution sizes
# the gathered partitions and splits a value that is too large for one file.
GATHERED = {"fct_touchpoints"}


def publish(df: DataFrame, root: str, name: str) -> DataFrame:
    """Write `df` as table `name` and return it as read from there."""
    column = PARTITIONED.get(name)
    if column is None:
        return store(df, f"{root}/{name}")
    if name in GATHERED:
        df = df.hint("rebalance", column)
    return store(df, f"{root}/{name}", [column])


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Table `name` under `root`, from its list of files where it has one."""
    listed = f"{root}/{_LISTS}/{name}"
    if not path_exists(spark, listed):
        return spark.read.parquet(f"{root}/{name}")
    rows = spark.read.schema(_LIST).parquet(listed).where(~F.col("replaced")).collect()
    schema = T.StructType.fromJson(json.loads(rows[0].table_schema))
    return _scan(spark, schema, name, [r.file for r in rows if r.file])


_LISTS = "_files"
_LIST = "table_schema STRING, file STRING, replaced BOOLEAN"


def _path(uri: str) -> str:
    """A file as the readers take it; a file without a host has one slash or three."""
    return unquote(re.sub(r"^(\w+):///", r"\1:/", uri))


def files_of(table: DataFrame) -> list[str]:
    return sorted(_path(f) for f in table.inputFiles())


def _scan(spark: SparkSession, schema: T.StructType, name: str, files: list[str], *columns) -> DataFrame:
    """The given files of a table; one scan per folder that they come from."""
    folders: dict[str, list[str]] = {}
    for f in files:
        folders.setdefault(f[: f.rindex(f"/{name}/") + len(name) + 1], []).append(f)
    columns = columns or tuple(schema.names)
    parts = [
        spark.read.schema(schema).option("basePath", base).parquet(*chosen).select(*columns)
        for base, chosen in folders.items()
    ]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def _files_with(table: DataFrame, name: str, files: list[str], keys: DataFrame) -> set[str]:
    """Those of a table's files that have a row with one of `keys`.

    A few keys go to all files at once, so that where rows lie spread over them
    most files are found without a shuffle. What is left meets all keys, each
    key of a file once.
    """
    spark, (key,) = table.sparkSession, keys.columns
    probe, found = keys.limit(PROBED), set()
    for wanted in [F.broadcast(probe)] + ([keys] if files and probe.count() == PROBED else []):
        left = [f for f in files if f not in found]
        if not left:
            break
        where = _scan(spark, table.schema, name, left, key, F.col("_metadata.file_path").alias("_file"))
        if wanted is keys:
            where = where.distinct()
        held = where.join(wanted, key, "left_semi").select("_file").distinct()
        found |= {_path(r._file) for r in held.collect()}
    return found


def publish_without(table: DataFrame, name: str, keys: DataFrame, target: str) -> DataFrame:
    """A version of a stored table under `target`, without the rows that have one of `keys`.

    `keys` has one column, of the same name in the table; rows without a value
    there stay. Passes over that column alone find the files with such rows;
    only those are written again, all others are shared with the version that
    `table` was read from. File names, not rows, come to the driver.
    """
    spark, (key,) = table.sparkSession, keys.columns
    files = files_of(table)
    touched = _files_with(table, name, files, keys)
    shared = [f for f in files if f not in touched]
    if len(shared) + len(touched) != len(files):
        raise ValueError(f"{name}: the table's files go by other names in its rows")
    if touched:
        rest = _scan(spark, table.schema, name, sorted(touched)).join(keys, key, "left_anti")
        shared += files_of(publish(rest.select(*table.columns), target, name))
    layout = table.schema.json()
    # The first row carries the schema of a table that has no file left.
    rows = [(layout, None, False), *((layout, f, False) for f in shared), *((layout, f, True) for f in sorted(touched))]
    store(spark.createDataFrame(rows, _LIST).coalesce(1), f"{target}/{_LISTS}/{name}")
    return read_published(spark, target, name)


def drop_replaced(spark: SparkSession, root: str, name: str) -> int:
    """Delete the files that the version under `root` wrote again; how many there were.

    The version before cannot be read any more; do this once no reader is left.
    """
    rows = spark.read.schema(_LIST).parquet(f"{root}/{_LISTS}/{name}").where("replaced").collect()
    for r in rows:
        delete_path(spark, r.file)
    return len(rows)
