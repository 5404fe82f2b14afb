"""Dimension tables in buckets of their keys: a merge reads and rewrites only the buckets in which something changes.

A table is ordinary partitioned Parquet, written with dynamic partition overwrite:

* type 1: ``<table>/current/_buckets=<B>/_bucket=<b>``, all rows;
* type 2: the open versions there, and the closed ones in ``<table>/history/_closed_on=<stamp>/_bucket=<b>``.

``b = pmod(xxhash64(keys as text), B)``. A merge

1. compares the source with key, hash and bucket of the current rows (the only columns of every bucket that are read),
2. brings the numbers of the buckets that hold a change to the driver (at most B integers),
3. runs the type 1 or type 2 merge over those buckets alone; the partition filter prunes the others,
4. writes closed versions, then the new rows of the buckets, staged before because their input is what they replace.

Files of untouched buckets stay as they are, and so does closed history: a merge adds partitions of its own stamp.
A merge that failed half-way is repeated: buckets that were replaced hold no change any more, the others are merged, and
closed rows of one stamp are kept by surrogate key. One writer per table.

Columns that only the source has are added (NULL in untouched rows); a changed column type is an error.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.functions.dates import to_stamp
from lakeload.operators._joins import max_frame, translate_errors, unique_rows
from lakeload.operators.scd1 import scd1_merge
from lakeload.operators.scd2 import CLOSE, IGNORE, is_open_version, scd2_change
from lakeload.plans.roles import HASH_COL, UPDATED_COL, resolve_keys, sk_column
from lakeload.sources.fs import delete_path, list_dir_names, path_exists
from lakeload.sources.store import materialize, scratch_scope

BUCKETS, BUCKET, CLOSED_ON = "_buckets", "_bucket", "_closed_on"
DEFAULT_BUCKETS = 64


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


def _current(path: str) -> str:
    return f"{path.rstrip('/')}/current"


def _history(path: str) -> str:
    return f"{path.rstrip('/')}/history"


def bucket_count(spark: SparkSession, path: str) -> int:
    """The number of buckets the table was created with."""
    found = [int(m[1]) for n in list_dir_names(spark, _current(path)) if (m := re.fullmatch(rf"{BUCKETS}=(\d+)", n))]
    if len(found) != 1:
        raise FileNotFoundError(f"{path} is not a table in buckets")
    return found[0]


def _read(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(folder)  # a column added later is in some files only


def _write(df: DataFrame, folder: str, *parts: str) -> None:
    """Replace the partitions that ``df`` has rows of; adaptive execution splits those that are large."""
    rows = df.hint("rebalance", *parts)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(folder)


def create_buckets(df: DataFrame, path: str, keys: Sequence[str] | None = None, buckets: int = DEFAULT_BUCKETS) -> None:
    """Write a dimension (all its versions) as a table in buckets of its keys."""
    spark, ks = df.sparkSession, resolve_keys(df.columns, keys)
    if path_exists(spark, _current(path)):
        raise FileExistsError(f"{path} exists")
    placed = df.withColumns({BUCKETS: F.lit(buckets), BUCKET: bucket_of(ks, buckets)})
    if UPDATED_COL in df.columns:
        placed = materialize(placed, "buckets-create")
        closed = placed.filter(~is_open_version()).drop(BUCKETS).withColumn(CLOSED_ON, F.col(UPDATED_COL))
        if not closed.isEmpty():
            _write(closed, _history(path), CLOSED_ON, BUCKET)
        placed = placed.filter(is_open_version())
    _write(placed, _current(path), BUCKETS, BUCKET)


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a type 1 table, the open versions of a type 2 table."""
    return _read(spark, _current(path)).drop(BUCKETS, BUCKET)


def read_history(spark: SparkSession, path: str) -> DataFrame | None:
    """The closed versions, or None if there are none yet."""
    return _read(spark, _history(path)).drop(CLOSED_ON, BUCKET) if path_exists(spark, _history(path)) else None


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    now, closed = read_current(spark, path), read_history(spark, path)
    return now if closed is None else now.unionByName(closed, allowMissingColumns=True)


def _check_types(gold: DataFrame, source: DataFrame) -> None:
    have = dict(gold.dtypes)
    wrong = [f"{c} {have[c]} -> {t}" for c, t in source.dtypes if have.get(c, t) != t]
    if wrong:
        raise ValueError(f"column types differ from the table's: {', '.join(wrong)}; create the table anew")


def _touched(
    current: DataFrame, source: DataFrame, ks: list[str], every_row: bool, missing: bool
) -> tuple[DataFrame, list[int]]:
    """The source rows that change something (staged), and the buckets they and vanished keys lie in."""
    state = current.select(*ks, BUCKET, F.col(HASH_COL).alias("_ll_hash"))
    seen = source.withColumn("_ll_src", F.lit(True)).join(state, [*ks, BUCKET], "full" if missing else "left")
    if not every_row:
        seen = seen.filter(F.col("_ll_hash").isNull() | F.col("_ll_src").isNull() | (F.col("_ll_hash") != F.col(HASH_COL)))
    seen = materialize(seen, "buckets-changed")
    numbers = sorted(r[0] for r in seen.select(BUCKET).distinct().collect())  # at most as many as there are buckets
    return seen.filter("_ll_src").drop("_ll_src"), numbers


def _replace(spark: SparkSession, rows: DataFrame, path: str, ks: list[str], n: int, touched: list[int]) -> None:
    """``rows`` become the content of the touched buckets."""
    rows = materialize(rows.withColumns({BUCKETS: F.lit(n), BUCKET: bucket_of(ks, n)}), "buckets-rows")
    filled = {r[0] for r in rows.select(BUCKET).distinct().collect()}
    _write(rows, _current(path), BUCKETS, BUCKET)
    for b in set(touched) - filled:  # a bucket left without rows has no partition to overwrite
        delete_path(spark, f"{_current(path)}/{BUCKETS}={n}/{BUCKET}={b}")


def merge_scd1_buckets(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str] | None = None) -> dict:
    """Type 1 merge of ``source`` into the table: inserted, updated and the numbers of the buckets rewritten."""
    n, current = bucket_count(spark, path), _read(spark, _current(path))
    ks, sk = resolve_keys(source.columns, keys), sk_column(current.columns)
    _check_types(current, source)
    with scratch_scope(spark):
        rows = unique_rows(source, ks, allow_null_keys=False).withColumn(BUCKET, bucket_of(ks, n))
        changed, touched = translate_errors(_touched, current, rows, ks, False, False)
        if not touched:
            return {"inserted": 0, "updated": 0, "buckets": []}
        new, old = changed.agg(
            F.count(F.when(F.col("_ll_hash").isNull(), 1)), F.count(F.when(F.col("_ll_hash").isNotNull(), 1))
        ).first()
        part = current.filter(F.col(BUCKET).isin(touched)).drop(BUCKETS, BUCKET)
        merged = scd1_merge(
            part, changed.drop(BUCKET, "_ll_hash"), ks, check_source=False, max_sk=max_frame(sk, current)
        )
        _replace(spark, merged, path, ks, n, touched)
    return {"inserted": new, "updated": old, "buckets": touched}


def merge_scd2_buckets(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    now,
    keys: Sequence[str] | None = None,
    on_same_hash: str = IGNORE,
    close_missing: bool = False,
) -> dict:
    """Type 2 merge of ``source`` into the table: inserted, closed and the numbers of the buckets rewritten."""
    n, current, history = bucket_count(spark, path), _read(spark, _current(path)), None
    if path_exists(spark, _history(path)):
        history = _read(spark, _history(path))
    ks, sk, stamp = resolve_keys(source.columns, keys), sk_column(current.columns), to_stamp(now)
    _check_types(current, source)
    with scratch_scope(spark):
        rows = unique_rows(source, ks, allow_null_keys=False).withColumn(BUCKET, bucket_of(ks, n))
        changed, touched = translate_errors(_touched, current, rows, ks, on_same_hash == CLOSE, close_missing)
        if not touched:
            return {"inserted": 0, "closed": 0, "buckets": []}
        here = F.col(BUCKET).isin(touched)
        part = current.filter(here).drop(BUCKETS, BUCKET)
        closed = None if history is None else history.filter(here)
        # to tell vanished keys from unchanged ones, the merge needs all source rows of the touched buckets
        rows = rows.filter(here).drop(BUCKET) if close_missing else changed.drop(BUCKET, "_ll_hash")
        change = scd2_change(
            part, rows, None if closed is None else closed.select(*ks), ks, stamp, on_same_hash, close_missing,
            check_source=False, max_sk=max_frame(sk, current, history),
        )
        inserted, ended = change.counts()
        after = materialize(change.open_rows(), "buckets-open")  # it asks the history that is written next
        if ended:
            end = change.ended().withColumn(BUCKET, bucket_of(ks, n))
            if closed is not None:  # closed at this stamp before: by an earlier merge, or by this one when it failed
                held = closed.filter(F.col(CLOSED_ON).cast("string") == stamp).drop(CLOSED_ON)
                end = end.unionByName(held.join(end.select(sk), sk, "left_anti"), allowMissingColumns=True)
            _write(materialize(end.withColumn(CLOSED_ON, F.lit(stamp)), "buckets-closed"), _history(path), CLOSED_ON, BUCKET)
        _replace(spark, after, path, ks, n, touched)
    return {"inserted": inserted, "closed": ended, "buckets": touched}
