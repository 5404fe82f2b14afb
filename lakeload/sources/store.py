"""Lineage cuts and versioned tables on plain files.

``materialize`` writes a frame as Parquet into the shared scratch folder and reads it back: the
result no longer depends on how its input was computed, survives executor loss, and gives later
scans column pruning. A versioned table keeps each rewrite in ``<table>/v=<n>``; readers take the
highest complete version, so a merge can read the version it replaces.

Rows that no later merge can touch (closed versions of a type 2 dimension) need no rewriting. They are an ordinary
Parquet table partitioned by the version that closed them, ``<table>/closed/from=<g>/n=<n>``; version m reads those with
n <= m. A table written whole as version g begins a new ``from=<g>``. Highest keys and counts are asked of the rows.
"""

from __future__ import annotations

import re
import threading
from contextlib import contextmanager
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeload.session import TABLE_CODEC, scratch_path
from lakeload.sources.fs import delete_path, is_complete, list_dir_names, path_exists, touch

_VERSION = re.compile(r"^v=(\d+)(?:_load=(.+))?$")
_FROM = re.compile(r"^from=(\d+)$")
_scope = threading.local()


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("errorifexists").parquet(path, compression=TABLE_CODEC)
    created = getattr(_scope, "paths", None)
    if created is not None:
        created.append(path)
    return spark.read.parquet(path)


@contextmanager
def scratch_scope(spark: SparkSession):
    """Remove the scratch folders materialised inside the block once it ends, well or not.

    For a block that ends with a write of everything that reads them (a table load); frames handed
    back to callers must not be built inside such a block.
    """
    outer = getattr(_scope, "paths", None)
    _scope.paths = []
    try:
        yield
    finally:
        paths, _scope.paths = _scope.paths, outer
        for path in paths:
            delete_path(spark, path)


class Version(NamedTuple):
    number: int
    name: str
    load: str | None  # the last load that it holds


def _versions(spark: SparkSession, table_path: str) -> list[Version]:
    """The complete versions, oldest first."""
    found = [(m, n) for n in list_dir_names(spark, table_path) if (m := _VERSION.match(n))]
    return sorted(Version(int(m[1]), n, m[2]) for m, n in found if is_complete(spark, f"{table_path.rstrip('/')}/{n}"))


def _next_number(spark: SparkSession, table_path: str) -> int:
    versions = _versions(spark, table_path)
    return versions[-1].number + 1 if versions else 1


def current_version(spark: SparkSession, table_path: str) -> Version:
    versions = _versions(spark, table_path)
    if not versions:
        raise FileNotFoundError(f"no complete version of table {table_path}")
    return versions[-1]


def _closed_folders(spark: SparkSession, table_path: str) -> list[int]:
    return sorted(int(m[1]) for n in list_dir_names(spark, f"{table_path.rstrip('/')}/closed") if (m := _FROM.match(n)))


def closed_folder(spark: SparkSession, table_path: str, number: int) -> str | None:
    """Where the closed rows of a version lie, if any have been written."""
    of = [g for g in _closed_folders(spark, table_path) if g <= number]
    return f"{table_path.rstrip('/')}/closed/from={of[-1]}" if of else None


def last_load(spark: SparkSession, table_path: str) -> str | None:
    """The last load merged into the table. It is part of the version folder's name, so it commits with the version."""
    loads = [v.load for v in _versions(spark, table_path) if v.load]
    return loads[-1] if loads else None


def table_exists(spark: SparkSession, table_path: str) -> bool:
    return path_exists(spark, table_path) and bool(_versions(spark, table_path))


def current_version_path(spark: SparkSession, table_path: str) -> str:
    return f"{table_path.rstrip('/')}/{current_version(spark, table_path).name}"


def read_own_rows(spark: SparkSession, table_path: str) -> DataFrame:
    """The rows of the current version's folder: every open row, and the closed rows of a table written whole."""
    return spark.read.parquet(current_version_path(spark, table_path))


def read_closed(spark: SparkSession, table_path: str) -> DataFrame | None:
    """The appended closed rows of the current version, with its columns (NULL where they were added later)."""
    number = current_version(spark, table_path).number
    folder = closed_folder(spark, table_path, number)
    if folder is None or not any(n.startswith("n=") for n in list_dir_names(spark, folder)):
        return None
    schema = read_own_rows(spark, table_path).schema
    return spark.read.schema(schema.add("n", "integer")).parquet(folder).filter(F.col("n") <= number).drop("n")


def read_table(spark: SparkSession, table_path: str) -> DataFrame:
    own, closed = read_own_rows(spark, table_path), read_closed(spark, table_path)
    return own if closed is None else own.unionByName(closed)


def _version_path(table_path: str, number: int, load: str | None) -> str:
    return f"{table_path.rstrip('/')}/v={number}" + (f"_load={load}" if load else "")


def write_table(df: DataFrame, table_path: str, load: str | None = None) -> str:
    """Write ``df`` as the next version of the table, whole; returns the version folder.

    ``load``: the last load the version holds (default: that of the version before)."""
    spark, number = df.sparkSession, _next_number(df.sparkSession, table_path)
    if _closed_folders(spark, table_path):  # rows that were closed before are among those of ``df``
        touch(spark, f"{table_path.rstrip('/')}/closed/from={number}/_whole")
    path = _version_path(table_path, number, load or last_load(spark, table_path))
    df.write.mode("overwrite").parquet(path, compression=TABLE_CODEC)
    return path


def append_closed(closed: DataFrame | None, own: DataFrame, table_path: str, load: str | None = None) -> None:
    """The next version: its own rows are ``own``; ``closed`` (None: no rows) is added to the closed rows, which stay
    as they are.

    The closed rows come first and belong to no version until its folder is complete; those that a failed write
    left behind have the number of the next version, which writes them anew. One writer per table."""
    spark, number = own.sparkSession, _next_number(own.sparkSession, table_path)
    folder = closed_folder(spark, table_path, number) or f"{table_path.rstrip('/')}/closed/from={number}"
    if closed is not None:
        closed.write.mode("overwrite").parquet(f"{folder}/n={number}", compression=TABLE_CODEC)
    else:
        delete_path(spark, f"{folder}/n={number}")
    path = _version_path(table_path, number, load or last_load(spark, table_path))
    own.write.mode("overwrite").parquet(path, compression=TABLE_CODEC)


def observed(obs: Observation) -> dict:
    """The metrics of a write; a plan that Spark knows to be empty is replaced together with its observation."""
    try:
        return obs.get
    except Py4JJavaError:
        return {}


def prune_versions(spark: SparkSession, table_path: str, keep: int) -> list[str]:
    """Delete complete versions older than the newest ``keep`` (at least 1 is always kept).

    Readers only ever use the newest complete version; keeping two or more also leaves the previous
    one for readers that started before the last write.
    """
    keep = max(1, int(keep))
    versions = _versions(spark, table_path)
    removed = []
    for v in versions[:-keep]:
        path = f"{table_path.rstrip('/')}/{v.name}"
        if delete_path(spark, path):
            removed.append(path)
    oldest = closed_folder(spark, table_path, versions[-keep:][0].number) if versions else None
    for g in _closed_folders(spark, table_path):  # closed rows that no version left refers to
        if oldest and g < int(oldest.rpartition("=")[2]):
            delete_path(spark, f"{table_path.rstrip('/')}/closed/from={g}")
    return removed
