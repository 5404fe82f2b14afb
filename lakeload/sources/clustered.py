"""Type 2 dimensions bucketed and sorted by key in Spark's own catalog: the daily join moves the source only.

The open versions are an external table ``CLUSTERED BY (keys) SORTED BY (keys) INTO <n> BUCKETS``. A merge deals the
source out by the keys into as many parts; source and open versions then meet where the open versions lie, to find the
changes and to end versions, without an exchange of the dimension. (:mod:`lakeload.sources.buckets` reads and writes less
where few buckets change; here everything is read and written once, but nothing of it is shuffled.)

Every merge writes the open versions to a new folder and lets the catalog's table point there. Versions that it closes
are added to ``<path>/closed/_closed_on=<stamp>``; the table's property says up to which stamp they count, so those of a
merge that failed are not seen, and its repeat writes them anew. One writer per table, one merge per stamp.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.functions.dates import to_stamp
from lakeload.operators._joins import SRC, max_frame
from lakeload.operators.scd2 import IGNORE, is_open_version, scd2_change
from lakeload.plans.roles import OPEN_END, UPDATED_COL, resolve_keys, sk_column
from lakeload.sources.fs import path_exists
from lakeload.sources.store import scratch_scope

CLOSED_ON, CLOSED_UNTIL = "_closed_on", "lakeload.closed_until"


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def bucketing(spark: SparkSession, name: str) -> tuple[list[str], int]:
    """Key columns and number of buckets of a table of the catalog."""
    rows = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE FORMATTED {name}").collect()}
    if not rows.get("Num Buckets", "-1").isdigit():
        raise ValueError(f"{name} is not bucketed")
    return [c.strip(" `") for c in rows["Bucket Columns"].strip("[]").split(",")], int(rows["Num Buckets"])


def _publish(rows: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int, until: str) -> None:
    """Write open versions, one file a bucket, to a new folder, and let the table point there."""
    spark, folder = rows.sparkSession, f"{path.rstrip('/')}/open-{uuid.uuid4().hex}"
    writing = f"{name}_{uuid.uuid4().hex}"
    dealt = rows.repartition(buckets, *keys)
    dealt.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", folder).saveAsTable(writing)
    spark.sql(f"DROP TABLE {writing}")  # external: the files stay
    by = ", ".join(f"`{k}`" for k in keys)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS "
        f"LOCATION '{folder}' TBLPROPERTIES ('{CLOSED_UNTIL}' = '{until}')"
    )


def _close(rows: DataFrame, path: str) -> None:
    closed = rows.withColumn(CLOSED_ON, F.col(UPDATED_COL))
    closed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(CLOSED_ON).parquet(f"{path.rstrip('/')}/closed")


def create_clustered(
    df: DataFrame, name: str, path: str, keys: Sequence[str] | None = None, buckets: int = 64
) -> None:
    """Make the catalog's table ``name`` of a dimension (all its versions), with its files under ``path``."""
    closed = df.filter(~is_open_version())
    if not closed.isEmpty():
        _close(closed, path)
    _publish(df.filter(is_open_version()), name, path, resolve_keys(df.columns, keys), buckets, OPEN_END)


def read_closed(spark: SparkSession, name: str, path: str) -> DataFrame | None:
    """The closed versions that count, with the columns of the table."""
    folder = f"{path.rstrip('/')}/closed"
    if not path_exists(spark, folder):
        return None
    until = _properties(spark, name)[CLOSED_UNTIL]
    schema = spark.table(name).schema.add(CLOSED_ON, "string")
    return spark.read.schema(schema).parquet(folder).filter(F.col(CLOSED_ON) <= until).drop(CLOSED_ON)


def read_clustered(spark: SparkSession, name: str, path: str) -> DataFrame:
    closed = read_closed(spark, name, path)
    return spark.table(name) if closed is None else spark.table(name).unionByName(closed)


def merge_scd2_clustered(
    spark: SparkSession, name: str, path: str, source: DataFrame, now, on_same_hash: str = IGNORE
) -> dict:
    """Type 2 merge of ``source`` into the table; returns how many versions were inserted and closed."""
    keys, buckets = bucketing(spark, name)
    current, closed, stamp = spark.table(name), read_closed(spark, name, path), to_stamp(now)
    sk = sk_column(current.columns)
    with scratch_scope(spark):
        dealt = source.repartition(buckets, *keys)
        change = scd2_change(current, dealt, closed, keys, stamp, on_same_hash, max_sk=max_frame(sk, current, closed))
        inserted, ended = change.counts()
        ending = change.changes.filter("_ll_close").select(*[F.col(SRC + k).alias(k) for k in keys]).repartition(buckets, *keys)
        if ended:
            _close(change.current.join(ending, keys).select(*change.current.columns).withColumn(UPDATED_COL, F.lit(stamp)), path)
        stay = change.current.join(ending, keys, "left_anti").select(*change.current.columns)
        _publish(stay.unionByName(change.inserts), name, path, keys, buckets, stamp)
    return {"inserted": inserted, "closed": ended}


__all__ = ["create_clustered", "merge_scd2_clustered", "read_clustered", "read_closed", "bucketing"]
