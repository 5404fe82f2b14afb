"""Slowly changing dimension, type 1: overwrite attributes in place, keep the surrogate key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.operators._joins import SRC, key_condition, max_frame, prefixed, translate_errors, unique_rows
from lakeload.operators.numbering import number_in_files, number_rows
from lakeload.plans.roles import HASH_COL, attribute_columns, resolve_keys, sk_column, sk_name_for


def scd1_create(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    sk: str | None = None,
    table_name: str | None = None,
    num_partitions: int | None = None,
    unique_keys: bool = False,
    by_range: bool = False,
    in_files: bool = False,
) -> DataFrame:
    """Source rows plus ``SK_<name>`` = 1..n in key order (``unique_keys``: one row per key; ``by_range``: dealt out by ranges
    of it; ``in_files``: they lie so in the files they are read from)."""
    ks = resolve_keys(df.columns, keys)
    name = sk or sk_name_for(table_name or "")
    if in_files:
        return number_in_files(df, name)
    return number_rows(df, ks, name, 0, num_partitions, unique=unique_keys, by_range=by_range)


def scd1_merge(
    gold: DataFrame,
    source: DataFrame,
    keys: Sequence[str] | None = None,
    null_safe_keys: bool = False,
    check_source: bool = True,
    num_partitions: int | None = None,
    max_sk: int | DataFrame | None = None,
) -> DataFrame:
    """Upsert by key.

    matched, hash differs -> attributes and hash from the source, SK kept; matched and equal ->
    unchanged; source only -> inserted with the next SKs (key order); gold only -> kept. Columns that
    only the source has are added, NULL in rows that the source does not update.

    Plan: the (deduplicated, checked) source is compared with gold's key, SK and hash columns only;
    the changed and new rows form one numbered change table (inserts ordered first, so their SKs are
    dense after ``max(SK)``); gold rows take their new values through a join on the SK with the
    updates, which Spark can broadcast when the change table is small, so gold is not shuffled.
    """
    ks = resolve_keys(gold.columns, keys)
    sk = sk_column(gold.columns)
    added = [c for c in source.columns if c not in gold.columns]
    if added:  # NULL until a row is updated; the source's hash covers them, so it is
        gold = gold.withColumns({c: F.lit(None).cast(source.schema[c].dataType) for c in added})
    attrs = attribute_columns(gold.columns, ks)
    needed = ks + attrs + [HASH_COL]
    missing = [c for c in needed if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks gold columns {missing}")
    source = source.select(*needed)
    if check_source:
        source = unique_rows(source, ks, null_safe_keys)
    src = prefixed(source, SRC, needed)
    cond = key_condition([SRC + k for k in ks], ks, null_safe_keys)
    current = gold.select(*ks, F.col(sk).alias("_ll_gsk"), F.col(HASH_COL).alias("_ll_ghash"))
    cmp = src.join(current, cond, "left")
    is_new = F.col("_ll_gsk").isNull()
    changed = ~is_new & (F.col("_ll_ghash") != F.col(SRC + HASH_COL))
    staged = cmp.filter(is_new | changed).select(
        *[F.col(SRC + c) for c in needed],
        F.col("_ll_gsk"),
        F.when(is_new, F.lit(0)).otherwise(F.lit(1)).alias("_ll_grp"),
    )
    base = max_frame(sk, gold) if max_sk is None else max_sk
    numbered = translate_errors(
        number_rows, staged, ["_ll_grp", *[SRC + k for k in ks]], "_ll_new_sk", base, num_partitions,
        unique=check_source,
    )

    updates = numbered.filter(F.col("_ll_grp") == 1).select(
        F.col("_ll_gsk").alias(sk), *[F.col(SRC + c).alias("_ll_u_" + c) for c in attrs + [HASH_COL]]
    )
    upd = F.col("_ll_u_" + HASH_COL).isNotNull()
    updated = gold.join(updates, sk, "left").select(
        *[F.when(upd, F.col("_ll_u_" + c)).otherwise(F.col(c)).alias(c) if c in attrs or c == HASH_COL else F.col(c)
          for c in gold.columns]
    )
    inserts = numbered.filter(F.col("_ll_grp") == 0).select(
        *[F.col(SRC + c).alias(c) for c in needed], F.col("_ll_new_sk").alias(sk)
    )
    return updated.unionByName(inserts.select(*gold.columns))
