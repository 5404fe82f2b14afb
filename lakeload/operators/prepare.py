"""Silver preparation: key renames, load stamp, row fingerprint, duplicate-key check."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.functions.dates import to_day
from lakeload.functions.hashing import SAFE, row_hash
from lakeload.functions.text import remove_accents
from lakeload.operators.validate import DuplicateKeyError, not_unique, validate_keys
from lakeload.plans.roles import HASH_COL, KEY_PREFIX, LOAD_DATE_COL


def rename_keys(df: DataFrame, keys: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Mark business keys: a list renames ``c`` to ``KEY_c``; a mapping gives the new names."""
    mapping = dict(keys) if isinstance(keys, Mapping) else {c: KEY_PREFIX + c for c in keys}
    missing = [c for c in mapping if c not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} not in frame")
    return df.withColumnsRenamed(mapping)


def add_load_date(df: DataFrame, run_date, name: str = LOAD_DATE_COL) -> DataFrame:
    """``LoadDate`` = the run day as ``yyyy-MM-dd`` literal."""
    return df.withColumn(name, F.lit(to_day(run_date)))


def hash_key(df: DataFrame, name: str = HASH_COL, ignore: Iterable[str] = (), mode: str = SAFE) -> DataFrame:
    """Add the row fingerprint over all columns except ``ignore`` (keys included)."""
    ignored = set(ignore) | {name}
    cols = [c for c in df.columns if c not in ignored]
    return df.withColumn(name, row_hash(df, cols, mode))


def prepare_silver(
    df: DataFrame,
    ignore: Iterable[str] = (LOAD_DATE_COL,),
    dedupe: bool = False,
    mode: str = SAFE,
    validate: bool = True,
) -> DataFrame:
    """Hash as ``HASHCOLUMN``, then validate keys (one aggregate job); raise on duplicate keys.

    ``dedupe`` drops exact duplicate rows (over the non-ignored columns) before hashing.
    """
    ignored = tuple(ignore)
    if dedupe:
        df = df.dropDuplicates([c for c in df.columns if c not in ignored])
    if validate:
        # the fingerprint is a function of the validated columns, so it is left out of the check
        # (no SHA-256 pass in the validation job)
        res = validate_keys(df.drop(HASH_COL), ignored)
        if not res.valid:
            raise DuplicateKeyError(not_unique(res.key_columns))
    return hash_key(df, HASH_COL, ignored, mode)


def geo_normalise(
    df: DataFrame,
    renames: Mapping[str, str],
    accent_columns: Mapping[str, str],
    run_date,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Location cleanup: rename keys, accent-strip text keys, stamp, project, distinct."""
    out = df.withColumnsRenamed(dict(renames))
    out = out.withColumns({new: remove_accents(F.col(src)) for src, new in accent_columns.items()})
    out = add_load_date(out, run_date)
    cols = list(keep) if keep is not None else list(renames.values()) + list(accent_columns.values()) + [LOAD_DATE_COL]
    return out.select(*cols).distinct()


__all__ = ["rename_keys", "add_load_date", "hash_key", "prepare_silver", "geo_normalise", "DuplicateKeyError"]
