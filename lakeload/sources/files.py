"""Landing CSV, dated Parquet snapshots (bronze) and load-stamped appends (silver)."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from lakeload.functions.dates import to_day
from lakeload.plans.roles import LOAD_DATE_COL
from lakeload.session import TABLE_CODEC
from lakeload.sources.fs import delete_path, list_dir_names, list_file_names, move_path, path_exists, touch

_DAY_FOLDER = re.compile(r"^\d{4}-\d{2}-\d{2}$")
_EMPTY = "_EMPTY"  # Spark ignores files whose names begin so
_ORDERED = "_IN_KEY_ORDER-"  # and the number of its files: a load with one row per key, in key order
_LOAD_PARTITION = re.compile(rf"^{LOAD_DATE_COL}=(\d{{4}}-\d{{2}}-\d{{2}})$")


def read_csv(
    spark: SparkSession,
    path: str,
    header: bool = True,
    sep: str = ",",
    quote: str = '"',
    escape: str = "\\",
    multi_line: bool = False,
    encoding: str = "UTF-8",
    malformed: str | None = None,
) -> DataFrame:
    """Landing file as all-string columns (no inference: schema-on-read stays in the copy step).

    A UTF-8 byte-order mark and CRLF line ends are handled by Spark's reader. ``malformed`` names one more column
    that holds the whole record where it has more or fewer fields than the header, and NULL elsewhere.
    """
    reader = (
        spark.read.option("header", header)
        .option("sep", sep)
        .option("quote", quote)
        .option("escape", escape)
        .option("multiLine", multi_line)
        .option("encoding", encoding)
        .option("inferSchema", False)
    )
    if malformed is None:
        return reader.csv(path)
    schema = reader.csv(path).schema.add(malformed, "string")
    return reader.option("columnNameOfCorruptRecord", malformed).schema(schema).csv(path)


def typed_copy(df: DataFrame, types: Mapping[str, str | DataType] | StructType | None = None) -> DataFrame:
    """Column-by-column conversion; a value that does not convert becomes NULL (``try_cast``).

    Columns without a given type keep their (string) type.
    """
    if types is None:
        return df
    mapping = {f.name: f.dataType for f in types.fields} if isinstance(types, StructType) else dict(types)
    return df.select(*[F.col(c).try_cast(mapping[c]).alias(c) if c in mapping else F.col(c) for c in df.columns])


def unconverted(df: DataFrame, types: Mapping[str, str | DataType]) -> Column:
    """Aggregate: the number of values that :func:`typed_copy` turns into NULL."""
    lost = [(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).cast("long") for c, t in types.items() if c in df.columns]
    return F.coalesce(F.sum(sum(lost, F.lit(0).cast("long"))), F.lit(0))


def snapshot_path(base: str, run_date, name: str) -> str:
    return f"{base.rstrip('/')}/{to_day(run_date)}/{name}"


def write_snapshot(df: DataFrame, base: str, run_date, name: str) -> str:
    """``<base>/<yyyy-MM-dd>/<name>`` as snappy Parquet; a re-run of the day replaces it."""
    path = snapshot_path(base, run_date, name)
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return path


def snapshot_days(spark: SparkSession, base: str, until: str | None = None) -> list[str]:
    """The ``yyyy-MM-dd`` folders, oldest first, up to ``until`` if given."""
    return sorted(n for n in list_dir_names(spark, base) if _DAY_FOLDER.match(n) and (until is None or n <= until))


def latest_snapshot_day(spark: SparkSession, base: str, until: str | None = None) -> str | None:
    """Newest ``yyyy-MM-dd`` folder by name (the maximum, not the listing order), up to ``until`` if given."""
    days = snapshot_days(spark, base, until)
    return days[-1] if days else None


def read_latest_snapshot(spark: SparkSession, base: str, name: str, until: str | None = None) -> DataFrame:
    day = latest_snapshot_day(spark, base, until)
    if day is None:
        raise FileNotFoundError(f"no dated snapshot under {base}")
    return spark.read.parquet(f"{base.rstrip('/')}/{day}/{name}")


def _writer(df: DataFrame, fmt: str) -> DataFrameWriter:
    writer = df.write.format(fmt)
    return writer.option("compression", TABLE_CODEC) if fmt == "parquet" else writer


def append_silver(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Add one load to a silver table partitioned by ``LoadDate``.

    Only the partitions present in ``df`` are replaced, so other loads are kept and a repeated run
    of the same day does not double its rows.
    """
    if LOAD_DATE_COL not in df.columns:
        raise ValueError(f"silver rows need a {LOAD_DATE_COL} column")
    (
        _writer(df, fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(LOAD_DATE_COL)
        .save(path)
    )


def stage_load(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Write a load of the silver table at ``path`` beside it, where no reader looks; returns the staging folder."""
    base, _, name = path.rstrip("/").rpartition("/")
    staging = f"{base}/_staging/{name}-{uuid.uuid4().hex}"
    _writer(df, fmt).partitionBy(LOAD_DATE_COL).save(staging)
    return staging


def stage_ordered_load(df: DataFrame, path: str, load: str) -> str:
    """:func:`stage_load` of one load with one row per key, whose partitions follow each other in key order."""
    base, _, name = path.rstrip("/").rpartition("/")
    staging = f"{base}/_staging/{name}-{uuid.uuid4().hex}"
    folder, spark = _load_path(staging, load), df.sparkSession
    _writer(df.drop(LOAD_DATE_COL), "parquet").save(folder)
    touch(spark, f"{folder}/{_ORDERED}{_file_count(spark, folder)}")
    return staging


def _file_count(spark: SparkSession, folder: str) -> int:
    return sum(n[0] not in "._" for n in list_file_names(spark, folder))


def load_is_ordered(spark: SparkSession, path: str, load: str) -> bool:
    """The load has one row per key, in key order from file to file, and no file was added to it."""
    folder = _load_path(path, load)
    return path_exists(spark, f"{folder}/{_ORDERED}{_file_count(spark, folder)}")


def publish_load(spark: SparkSession, staging: str, path: str) -> list[str]:
    """Make a staged load part of the table: its partitions take the place of those of the same days, by renaming."""
    loads = silver_loads(spark, staging)
    for load in loads:
        delete_path(spark, _load_path(path, load))
        move_path(spark, _load_path(staging, load), _load_path(path, load))
    delete_path(spark, staging)
    return loads


def append_rows(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Plain append: earlier rows of the same load stay."""
    writer = _writer(df, fmt).mode("append")
    (writer.partitionBy(LOAD_DATE_COL) if LOAD_DATE_COL in df.columns else writer).save(path)


def _load_path(path: str, load: str) -> str:
    return f"{path.rstrip('/')}/{LOAD_DATE_COL}={load}"


def mark_empty_load(spark: SparkSession, path: str, load: str) -> None:
    """Record that a load brought no rows (and remove rows that an earlier run of it left)."""
    delete_path(spark, _load_path(path, load))
    touch(spark, f"{_load_path(path, load)}/{_EMPTY}")


def load_is_empty(spark: SparkSession, path: str, load: str) -> bool:
    return path_exists(spark, f"{_load_path(path, load)}/{_EMPTY}")


def read_load(spark: SparkSession, path: str, load: str, fmt: str = "parquet") -> DataFrame:
    """One load, read from its own folder: no other folder is listed, and its own columns are all there."""
    df = spark.read.format(fmt).option("basePath", path).load(_load_path(path, load))
    return df.withColumn(LOAD_DATE_COL, F.col(LOAD_DATE_COL).cast("string"))


def silver_loads(spark: SparkSession, path: str) -> list[str]:
    return sorted(m.group(1) for n in list_dir_names(spark, path) if (m := _LOAD_PARTITION.match(n)))


def read_silver(spark: SparkSession, path: str, newest_only: bool = True, fmt: str = "parquet") -> DataFrame:
    """The newest load that has rows, or with ``newest_only=False`` all loads with the columns of any of them."""
    if newest_only:
        loads = [x for x in silver_loads(spark, path) if not load_is_empty(spark, path, x)]
        if not loads:
            raise FileNotFoundError(f"no {LOAD_DATE_COL}= folder with rows under {path}")
        return read_load(spark, path, loads[-1], fmt)
    df = spark.read.format(fmt).option("mergeSchema", True).load(path)
    # partition values are read back as dates by type inference; keep the stamp a string
    return df.withColumn(LOAD_DATE_COL, F.col(LOAD_DATE_COL).cast("string"))


__all__ = [
    "read_csv",
    "typed_copy",
    "snapshot_path",
    "write_snapshot",
    "snapshot_days",
    "latest_snapshot_day",
    "read_latest_snapshot",
    "append_silver",
    "append_rows",
    "stage_load",
    "stage_ordered_load",
    "load_is_ordered",
    "publish_load",
    "mark_empty_load",
    "load_is_empty",
    "read_load",
    "silver_loads",
    "read_silver",
    "unconverted",
    "to_day",
    "latest_partition_value",
    "read_latest_partition",
]


def latest_partition_value(spark: SparkSession, path: str, column: str) -> str | None:
    """Largest value of a ``column=value`` partition folder (driver-side listing of folder names)."""
    prefix = column + "="
    vals = [n[len(prefix):] for n in list_dir_names(spark, path) if n.startswith(prefix)]
    return max(vals) if vals else None


def read_latest_partition(spark: SparkSession, path: str, column: str) -> DataFrame:
    """Rows of the newest partition only; the filter prunes partitions at the scan."""
    value = latest_partition_value(spark, path, column)
    if value is None:
        raise FileNotFoundError(f"no {column}= partitions under {path}")
    df = spark.read.parquet(path)
    return df.filter(F.col(column).cast("string") == F.lit(value))
