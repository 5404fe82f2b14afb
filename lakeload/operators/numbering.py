"""Dense, distributed row numbering: the result of ``row_number() OVER (ORDER BY keys)`` (plus an
offset) without a single-partition window.

Plan:

1. range-partition on the order columns, sort within partitions, record ``(partition, position)``
   per row. When the order columns are not known to be unique, a row hash and a per-row id are
   added as tie-breakers, so a group of equal keys, even of identical copies, can be split over
   partitions. The per-row id is assigned after a local sort of each input partition; only identical
   rows can then swap ids, so a recomputed task (executor loss) yields the same set of
   (row, id) pairs and every row lands in the same range partition again;
2. write that frame to the shared scratch folder (lineage cut: the sampled range bounds are used
   exactly once, and a lost executor re-reads files instead of re-sampling);
3. count rows per partition (one tiny aggregate over one pruned column), turn the counts into
   running offsets with a window over at most ``n`` rows, broadcast those ``n`` rows;
4. number = offset + partition offset + position + 1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from lakeload.functions.hashing import pack_hashes, unpack_hashes
from lakeload.sources.store import materialize

_PID, _POS, _TIE, _SEQ, _CNT, _OFF, _BASE = "_ll_pid", "_ll_pos", "_ll_tie", "_ll_seq", "_ll_cnt", "_ll_off", "_ll_base"
_FILE = "_ll_file"
MAX_NUMBER = (1 << 63) - 1


def _range_partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions is None:
        num_partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        initial = df.sparkSession.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
        if initial:
            num_partitions = max(num_partitions, int(initial))
    if num_partitions < 1:
        raise ValueError(f"range partitions must be at least 1, got {num_partitions}")
    return num_partitions


def number_rows(
    df: DataFrame,
    order_by: Sequence[str],
    name: str,
    offset: int | DataFrame = 0,
    num_partitions: int | None = None,
    unique: bool = False,
    by_range: bool = False,
) -> DataFrame:
    """Append ``name`` = ``offset`` + 1..n in ``order_by`` order (ascending, NULLs first), as bigint.

    ``offset`` may be a frame of one row and one column; it is then part of the plan, broadcast when that runs.

    ``unique=True`` declares the order columns unique (no tie-breakers needed). Otherwise rows equal
    on ``order_by`` are ordered by a hash of all columns, identical rows in any order (the result is
    the same multiset either way). ``by_range=True``: ``df`` is range-partitioned on the unique order columns already.
    """
    if not order_by:
        raise ValueError("number_rows needs at least one order column")
    n = _range_partitions(df, num_partitions)
    keys = [F.col(c).asc_nulls_first() for c in order_by]
    columns, df = df.columns, pack_hashes(df, order_by)
    if unique:
        prepared, order, helpers = df, keys, []
    else:
        hashable = [c for c in df.columns if not isinstance(df.schema[c].dataType, MapType)]
        prepared = (
            df.withColumn(_TIE, F.xxhash64(*hashable))
            .sortWithinPartitions(*keys, F.col(_TIE))
            .withColumn(_SEQ, F.monotonically_increasing_id())
        )
        order, helpers = keys + [F.col(_TIE), F.col(_SEQ)], [_TIE, _SEQ]
    # Without an explicit count the range exchange starts at spark.sql.shuffle.partitions and AQE
    # coalesces adjacent ranges to the advisory size; coalesced partitions stay contiguous and in
    # order, so (partition, position) still orders the rows globally.
    if not (unique and by_range):
        prepared = prepared.repartitionByRange(*([n] if num_partitions else []), *order)
    ranged = (
        prepared.sortWithinPartitions(*order)
        .withColumn(_PID, F.spark_partition_id())
        # monotonically_increasing_id = (partition << 33) + position within the partition
        .withColumn(_POS, F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33))
        .drop(*helpers)
    )
    staged = materialize(ranged, "numbering")
    counts = staged.groupBy(_PID).agg(F.count(F.lit(1)).alias(_CNT))
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PID, F.coalesce(F.sum(_CNT).over(before), F.lit(0)).alias(_OFF))
    nth = F.col(_OFF) + F.col(_POS) + F.lit(1)
    past = F.raise_error(F.lit(f"{name} would pass the largest bigint")).cast("bigint")
    if isinstance(offset, DataFrame):  # one row joins the n rows of offsets
        offsets = offsets.join(offset.toDF(_BASE))
    else:
        offsets = offsets.withColumn(_BASE, F.lit(int(offset)).cast("bigint"))
    base = F.col(_BASE)
    # at most n rows of an int and two longs: a proven bound, so the broadcast is safe
    return (
        unpack_hashes(staged)
        .join(F.broadcast(offsets), _PID, "inner")
        .withColumn(name, F.when(nth > F.lit(MAX_NUMBER) - base, past).otherwise((nth + base).cast("bigint")))
        .select(*[c for c in columns if c != name], name)
    )


def number_in_files(df: DataFrame, name: str) -> DataFrame:
    """Append ``name`` = 1..n in the order of the Parquet files that ``df`` is read from (by name) and of the rows in them.

    For files written in order, each after the one before: nothing is sorted, shuffled or staged but a row per file."""
    placed = df.select("*", F.col("_metadata.file_name").alias(_FILE), F.col("_metadata.row_index").alias(_POS))
    counts = placed.groupBy(_FILE).agg((F.max(_POS) + 1).alias(_CNT))
    before = Window.orderBy(F.length(_FILE), _FILE).rowsBetween(Window.unboundedPreceding, -1)  # part-99999, part-100000
    offsets = counts.select(_FILE, F.coalesce(F.sum(_CNT).over(before), F.lit(0)).alias(_OFF))
    number = (F.col(_OFF) + F.col(_POS) + 1).cast("bigint")
    return placed.join(F.broadcast(offsets), _FILE).withColumn(name, number).drop(_FILE, _POS, _OFF)
