"""Join helpers shared by the merge operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.functions.hashing import pack_hashes, row_fingerprint, unpack_hashes
from lakeload.operators.validate import DuplicateKeyError

SRC = "_s_"


def prefixed(df: DataFrame, prefix: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Select ``cols`` (default all) renamed to ``prefix + name`` so both join sides stay addressable."""
    cols = list(df.columns) if cols is None else list(cols)
    return df.select(*[F.col(c).alias(prefix + c) for c in cols])


def key_condition(left_keys: Sequence[str], right_keys: Sequence[str], null_safe: bool) -> Column:
    cond = None
    for lk, rk in zip(left_keys, right_keys):
        c = F.col(lk).eqNullSafe(F.col(rk)) if null_safe else (F.col(lk) == F.col(rk))
        cond = c if cond is None else (cond & c)
    return cond


DUP_MARKER = "lakeload: merge source"


def no_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df``; the job that reads it fails at a NULL key."""
    any_null = None
    for k in keys:
        c = F.col(k).isNull()
        any_null = c if any_null is None else (any_null | c)
    if any_null is None:
        return df
    null_msg = F.lit(f"{DUP_MARKER} has a NULL value in a key column of ({', '.join(keys)})")
    return df.filter(F.when(any_null, F.raise_error(null_msg)).otherwise(F.lit(True)))


def unique_rows(source: DataFrame, keys: Sequence[str], allow_null_keys: bool, by_range: bool = False) -> DataFrame:
    """One row per key, checked lazily inside the plan.

    Per key: ``min(struct(row))`` (the survivor) and the min/max of a 128-bit row fingerprint, all with
    partial aggregation (a hot key sends one row per map task, and each shuffled row carries the
    row once plus four longs). Identical copies collapse; two different rows for one key fail the
    job through ``raise_error`` when the plan runs, as does a NULL key unless allowed. The output
    is hash-partitioned on the keys, which a following join on the keys reuses.

    ``by_range``: the rows are dealt out by ranges of the keys instead, for a numbering in key order, which then needs
    no exchange of its own. Equal keys lie in one range. Rows travel as they are, without fingerprints; a hot key's
    copies meet in one task, which sorts them (on disk, if need be) and holds one at a time.
    """
    columns, source = source.columns, pack_hashes(source, keys)
    if by_range:
        source = source.repartitionByRange(*keys)
    rest = [c for c in source.columns if c not in keys]
    if rest:
        fp = row_fingerprint(source, rest)
        agg = source.withColumn("_ll_fp", fp).groupBy(*keys).agg(
            F.min(F.struct(*[F.col(c) for c in rest])).alias("_ll_row"),
            F.min("_ll_fp.h1").alias("_ll_lo1"),
            F.max("_ll_fp.h1").alias("_ll_hi1"),
            F.min("_ll_fp.h2").alias("_ll_lo2"),
            F.max("_ll_fp.h2").alias("_ll_hi2"),
        )
        differs = (F.col("_ll_lo1") != F.col("_ll_hi1")) | (F.col("_ll_lo2") != F.col("_ll_hi2"))
    else:
        agg = source.select(*keys).distinct()
        differs = F.lit(False)
    msg = F.lit(f"{DUP_MARKER} has different rows for one key of ({', '.join(keys)})")
    out = agg.filter(F.when(differs, F.raise_error(msg)).otherwise(F.lit(True)))
    if not allow_null_keys:
        out = no_null_keys(out, keys)
    if rest:
        out = out.select(*keys, *[F.col(f"_ll_row.{c}").alias(c) for c in rest])
    return unpack_hashes(out).select(*columns)


def translate_errors(fn, *args, **kwargs):
    """Run ``fn``; a failure raised by :func:`unique_rows` surfaces as ``DuplicateKeyError``."""
    try:
        return fn(*args, **kwargs)
    except DuplicateKeyError:
        raise
    except Exception as e:  # the JVM error class differs between Spark versions
        if DUP_MARKER in str(e):
            raise DuplicateKeyError(str(e).split("\n")[0][:500]) from e
        raise


def max_frame(column: str, *frames: DataFrame | None) -> DataFrame:
    """One row: the highest value of ``column`` in any of the frames, 0 if there is none. Not computed yet."""
    tops = [df.agg(F.max(column).alias(column)) for df in frames if df is not None]
    whole = tops[0]
    for df in tops[1:]:
        whole = whole.unionByName(df)
    return whole.agg(F.coalesce(F.max(column), F.lit(0)).cast("bigint").alias(column))


def max_value(df: DataFrame, column: str) -> int:
    """Scalar ``coalesce(max(column), 0)``: one value to the driver (pruned to one column)."""
    v = df.agg(F.max(column)).first()[0]
    return int(v) if v is not None else 0
