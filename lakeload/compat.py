"""Call-compatible entry points for existing notebook code.

Same names and argument order as the functions such notebooks call, implemented with the operators of
this package. Differences, all deliberate:

* no notebook globals: the session is the active one, a merge takes ``table_name`` explicitly;
* tables are folders of this package's layouts (silver: Parquet partitioned by ``LoadDate`` when the
  column exists; gold: versioned folders), not a transactional table format;
* ``AddHashKey`` and ``ValidateDuplicateKeys`` keep the notebooks' literal rules (a column named like
  the fingerprint is hashed too; keys are columns whose name contains ``KEY_``); elsewhere key columns
  are found by the ``KEY_`` prefix, the merges have the documented meaning (SCD1: update
  changed attributes, insert new keys; SCD2: close changed versions and insert the new ones), and
  surrogate keys are numbered without a single-partition window.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from lakeload.functions.dates import to_stamp
from lakeload.functions.hashing import COMPAT, row_hash
from lakeload.functions.text import remove_accents, strip_marks
from lakeload.operators.scd1 import scd1_create, scd1_merge
from lakeload.operators.scd2 import scd2_actions, scd2_create
from lakeload.operators.validate import DuplicateKeyError, ValidationResult, validate_keys
from lakeload.plans.roles import HASH_COL, LOAD_DATE_COL, sk_name_for
from lakeload.plans.runs import merge_type2_table
from lakeload.sources.files import append_rows, read_silver
from lakeload.sources.fs import path_exists
from lakeload.sources.store import read_table, scratch_scope, write_table


def _spark() -> SparkSession:
    spark = SparkSession.getActiveSession()
    if spark is None:
        raise RuntimeError("no active SparkSession")
    return spark


def PathExists(path: str) -> bool:  # noqa: N802
    return path_exists(_spark(), path)


def AddHashKey(param_df: DataFrame, param_colName: str, param_ignoreList: Sequence[str] = ()) -> DataFrame:  # noqa: N802,N803
    """Undelimited SHA-256 fingerprint (``compat`` mode) over every non-ignored column in frame order,
    a column of the same name included (as in the notebooks; ``hash_key`` leaves it out)."""
    cols = [c for c in param_df.columns if c not in set(param_ignoreList)]
    return param_df.withColumn(param_colName, row_hash(param_df, cols, COMPAT))


def ValidateDuplicateKeys(param_df: DataFrame, param_ignoreCols: Sequence[str] = ()) -> ValidationResult:  # noqa: N802,N803
    """Key columns are those whose name contains ``KEY_`` (the notebooks' rule; the library uses the prefix)."""
    keys = [c for c in param_df.columns if "KEY_" in c]
    return validate_keys(param_df, param_ignoreCols, keys)


def PrepareToSilver(param_df: DataFrame, param_ignoreList: Sequence[str] = ()) -> DataFrame:  # noqa: N802,N803
    out = AddHashKey(param_df, HASH_COL, param_ignoreList)
    res = ValidateDuplicateKeys(out, param_ignoreList)
    if not res.valid:
        raise DuplicateKeyError(f"several rows share a value of {', '.join(res.key_columns)}")
    return out


def SaveToSilver(param_df: DataFrame, param_folder: str, param_tableName: str) -> None:  # noqa: N802,N803
    append_rows(param_df, os.path.join(param_folder, param_tableName))


def RemoveAccents(param_string: str | None) -> str | None:  # noqa: N802
    return strip_marks(param_string)


def RemoveAccentsUDF(c: Column | str) -> Column:  # noqa: N802
    """Column function by the exact rule, usable where the row UDF was used."""
    return remove_accents(c, exact=True)


def _silver(folder: str, table_name: str) -> DataFrame:
    spark = _spark()
    path = os.path.join(folder, table_name)
    df = spark.read.parquet(path)
    return read_silver(spark, path) if LOAD_DATE_COL in df.columns else df


def create_scd1(silver_folder: str, gold_folder: str, table_name: str, unique_cols: Sequence[str]) -> None:
    df = scd1_create(_silver(silver_folder, table_name), list(unique_cols), sk_name_for(table_name))
    write_table(df, os.path.join(gold_folder, table_name))


def create_scd2(silver_folder: str, gold_folder: str, table_name: str, unique_cols: Sequence[str]) -> None:
    df = scd2_create(_silver(silver_folder, table_name), list(unique_cols), sk_name_for(table_name))
    write_table(df, os.path.join(gold_folder, table_name))


def merge_scd1(current_date, source_table: str, target_table: str, unique_cols: Sequence[str], table_name: str) -> None:
    gold_path = os.path.join(target_table, table_name)
    gold = read_table(_spark(), gold_path)
    write_table(scd1_merge(gold, _silver(source_table, table_name), list(unique_cols)), gold_path)


def action_to_perform(source_table: DataFrame, target_table: DataFrame, unique_cols: Sequence[str], current_date) -> DataFrame:
    return scd2_actions(source_table, target_table, list(unique_cols), current_date)


def merge_scd2(current_date, source_table: str, target_table: str, unique_cols: Sequence[str], table_name: str) -> None:
    gold_path = os.path.join(target_table, table_name)
    with scratch_scope(_spark()):
        merge_type2_table(_spark(), gold_path, _silver(source_table, table_name), list(unique_cols), to_stamp(current_date))
