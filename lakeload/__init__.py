"""lakeload: lakehouse-loading operators on Spark DataFrames.

Bronze (dated Parquet snapshots of landing CSV), silver (keys, fingerprints, duplicate-key check, load
stamps) and gold (surrogate keys, SCD type 1 and 2, fact lookups), driven by small table configs.
"""

from lakeload.functions.dates import to_day, to_stamp
from lakeload.functions.hashing import COMPAT, SAFE, row_fingerprint, row_hash
from lakeload.functions.text import register_sql_functions, remove_accents
from lakeload.operators.facts import DimLookup, load_fact, lookup_sk
from lakeload.operators.numbering import number_rows
from lakeload.operators.prepare import add_load_date, geo_normalise, hash_key, prepare_silver, rename_keys
from lakeload.operators.scd1 import scd1_create, scd1_merge
from lakeload.operators.scd2 import (
    scd2_actions,
    scd2_as_of,
    scd2_create,
    scd2_current,
    scd2_history,
    scd2_latest,
    scd2_merge,
)
from lakeload.operators.validate import (
    DuplicateKeyError,
    ValidationResult,
    count_distinct_keys,
    first_per_key,
    validate_keys,
    validate_keys_df,
)
from lakeload.plans.layout import Layout
from lakeload.plans.runs import (
    SilverSpec,
    load_gold,
    merge_into_gold,
    run_bronze,
    run_from_config,
    run_gold,
    run_layers,
    run_silver,
)
from lakeload.session import checkpoint_dir, get_session
from lakeload.sources.config import read_config
from lakeload.sources.files import (
    append_silver,
    read_csv,
    read_latest_partition,
    read_latest_snapshot,
    read_silver,
    typed_copy,
    write_snapshot,
)
from lakeload.sources.store import read_table, write_table

__all__ = [name for name in dir() if not name.startswith("_")]
