"""Duplicate-key validation: over the distinct rows of the non-ignored columns, a frame is valid iff
no key tuple occurs in two different rows. Identical rows are not a violation.

One job, two partial-aggregated shuffles over (keys, 16-byte row fingerprint) instead of whole rows:
``distinct`` (map-side combine collapses copies before the shuffle) and a count per key (map-side
combine emits one row per key and task, so a hot key does not pile up in one task). The fingerprint
only has to tell apart rows that share a key; at 128 bits two such rows collide with probability
about 2**-128. NULL key values form a group of their own, as in ``dropDuplicates``.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.functions.hashing import row_fingerprint
from lakeload.plans.roles import resolve_keys

HOT_ROWS, HOT_SAMPLE = 1_000_000, 0.01


@dataclass(frozen=True)
class ValidationResult:
    valid: bool
    key_columns: list[str] = field(default_factory=list)
    n_rows: int = 0
    n_keys: int = 0


class DuplicateKeyError(ValueError):
    pass


def not_unique(keys: Sequence[str]) -> str:
    return f"different rows share one value of {', '.join(keys)}"


def validate_keys_df(df: DataFrame, ignore: Iterable[str] = (), keys: Sequence[str] | None = None) -> DataFrame:
    """One row ``(valid, n_rows, n_keys, key_columns)``; ``n_rows`` counts distinct rows."""
    ignored = set(ignore)
    ks = resolve_keys(df.columns, keys, ignored)
    cols = [c for c in df.columns if c not in ignored]
    others = [c for c in cols if c not in ks]
    fingerprint = row_fingerprint(df, others).alias("_ll_fp")
    distinct_rows = df.select(*ks, fingerprint).distinct() if others else df.select(*ks).distinct()
    key_list = F.array(*[F.lit(k) for k in ks]) if ks else F.array().cast("array<string>")
    if not ks:
        return distinct_rows.agg(
            F.lit(True).alias("valid"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count(F.lit(1)).alias("n_keys"),
        ).withColumn("key_columns", key_list)
    per_key = distinct_rows.groupBy(*ks).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        (F.coalesce(F.max("_n"), F.lit(0)) <= 1).alias("valid"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
    ).withColumn("key_columns", key_list)


def validate_keys(df: DataFrame, ignore: Iterable[str] = (), keys: Sequence[str] | None = None) -> ValidationResult:
    row = validate_keys_df(df, ignore, keys).first()
    return ValidationResult(bool(row["valid"]), list(row["key_columns"]), int(row["n_rows"]), int(row["n_keys"]))


def assert_unique_keys(df: DataFrame, keys: Sequence[str], what: str = "source") -> None:
    """Raise if any key tuple occurs in more than one row (merge precondition)."""
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    if not dup.isEmpty():
        raise DuplicateKeyError(f"{what} has more than one row for some key of ({', '.join(keys)})")


def assert_no_null_keys(df: DataFrame, keys: Sequence[str], what: str = "source") -> None:
    cond = None
    for k in keys:
        c = F.col(k).isNull()
        cond = c if cond is None else (cond | c)
    if cond is not None and not df.filter(cond).isEmpty():
        raise DuplicateKeyError(f"{what} has NULL values in key columns ({', '.join(keys)})")


def first_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None, by_range: bool = False
) -> DataFrame:
    """One determined survivor per key: the smallest row by ``order_by`` (default: all other columns).

    An aggregate ``min(struct(...))`` with map-side combine, not a window: a hot key never gathers its
    rows in one task.

    ``by_range``: the rows are dealt out by ranges of the keys instead, for an output in key order. They travel uncombined,
    but for those of hot keys, which a sample finds (about ``HOT_ROWS`` rows and more) and which go as one row each.
    """
    if by_range:
        hot = df.select(*keys).sample(HOT_SAMPLE, seed=1).groupBy(*keys).count().filter(F.col("count") > HOT_ROWS * HOT_SAMPLE)
        found = hot.select(*keys).collect()  # a key per million rows at most, or nearly so
        if found:
            names = [f"_ll_hot_{i}" for i in range(len(keys))]
            hot = F.broadcast(df.sparkSession.createDataFrame(found, df.select(*keys).schema).toDF(*names))
            is_hot = functools.reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)])
            df = df.join(hot, is_hot, "left_anti").unionByName(first_per_key(df.join(hot, is_hot, "left_semi"), keys, order_by))
        df = df.repartitionByRange(*keys)
    rest = [c for c in df.columns if c not in keys]
    order = list(order_by) if order_by is not None else rest
    tail = [c for c in rest if c not in order]
    v = F.min(F.struct(*[F.col(c) for c in order + tail])).alias("_ll_first")
    return df.groupBy(*keys).agg(v).select(*keys, *[F.col(f"_ll_first.{c}").alias(c) for c in order + tail]).select(
        *df.columns
    )


def count_distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``n_keys``: number of distinct key tuples, NULL values counted as values."""
    return df.select(*keys).distinct().agg(F.count(F.lit(1)).alias("n_keys"))
