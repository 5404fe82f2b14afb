"""Difference of two snapshots of a table: the rows that a merge has to see.

Both snapshots are first cut down to keys and fingerprint, one row per key (identical copies collapse, different rows
of a key fail the job). These narrow frames, hash-partitioned on the keys already, meet in a full outer join. Only
keys that differ go on and fetch their rows, by a join that Spark broadcasts while they are few.

The result is a difference feed as the type 2 merge reads it with ``on_same_hash='close'``: new and changed rows as they
are now, removed rows as they were last, which equals the open version and therefore closes it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.operators._joins import key_condition, translate_errors, unique_rows
from lakeload.plans.roles import HASH_COL, resolve_keys
from lakeload.sources.store import materialize

CHANGE_COL = "_change"
INSERTED, UPDATED, REMOVED = "insert", "update", "delete"


def changed_keys(
    before: DataFrame, after: DataFrame, keys: Sequence[str], hash_col: str = HASH_COL, allow_null_keys: bool = False
) -> DataFrame:
    """``keys`` and ``_change`` of every key whose row was added, changed or removed."""
    old, new = (unique_rows(df.select(*keys, hash_col), keys, allow_null_keys) for df in (before, after))
    old = old.select(*[F.col(k).alias(f"_b_{k}") for k in keys], F.col(hash_col).alias("_b_hash"), F.lit(True).alias("_b_in"))
    new = new.select(*keys, F.col(hash_col).alias("_a_hash"), F.lit(True).alias("_a_in"))
    both = new.join(old, key_condition(keys, [f"_b_{k}" for k in keys], allow_null_keys), "full")
    change = (
        F.when(F.col("_b_in").isNull(), INSERTED)
        .when(F.col("_a_in").isNull(), REMOVED)
        .when(~F.col("_a_hash").eqNullSafe(F.col("_b_hash")), UPDATED)
    )
    here = [F.when(F.col("_a_in"), F.col(k)).otherwise(F.col(f"_b_{k}")).alias(k) for k in keys]
    return both.select(*here, change.alias(CHANGE_COL)).filter(F.col(CHANGE_COL).isNotNull())


def snapshot_diff(
    before: DataFrame,
    after: DataFrame,
    keys: Sequence[str] | None = None,
    hash_col: str = HASH_COL,
    allow_null_keys: bool = False,
) -> DataFrame:
    """Rows of ``after`` that were added or changed and rows of ``before`` that are gone, with ``_change``.

    Columns are those of ``after``; columns that ``before`` lacks are NULL in removed rows."""
    ks = resolve_keys(after.columns, keys)
    changes = translate_errors(materialize, changed_keys(before, after, ks, hash_col, allow_null_keys), "snapshot-diff")
    named = changes.select(*[F.col(k).alias(f"_c_{k}") for k in ks], CHANGE_COL)
    cond = key_condition(ks, [f"_c_{k}" for k in ks], allow_null_keys)

    def rows(df: DataFrame, gone: bool) -> DataFrame:
        wanted = named.filter((F.col(CHANGE_COL) == REMOVED) if gone else (F.col(CHANGE_COL) != REMOVED))
        found = df.join(wanted, cond).drop(*[f"_c_{k}" for k in ks])
        return found.dropDuplicates(ks)  # identical copies

    removed = rows(before.select(*[c for c in after.columns if c in before.columns]), gone=True)
    return rows(after, gone=False).unionByName(removed, allowMissingColumns=True)
