"""Column roles and table-name conventions.

The metadata model is carried by column and table names:

* ``KEY_<col>``   business-key column (prefix match),
* ``SK_<name>``   surrogate key, ``<name>`` = table name without its first ``_`` segment,
* ``HASHCOLUMN``  row fingerprint,
* ``LoadDate``    load stamp of a silver row,
* ``created_date`` / ``updated_date``  SCD2 validity range as ``yyyyMMddHHmm`` strings,
* ``DIM1_x`` / ``DIM2_x``  table name prefix selecting SCD type 1 / 2.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

# Fixed values of the data model (must stay equal to the loads they interoperate with).
KEY_PREFIX = "KEY_"
SK_PREFIX = "SK_"
HASH_COL = "HASHCOLUMN"
LOAD_DATE_COL = "LoadDate"
CREATED_COL = "created_date"
UPDATED_COL = "updated_date"
ACTION_COL = "Action"
DEFAULT_START = "190001010000"
OPEN_END = "999912312359"
# Action labels of the SCD2 action table, first matching rule wins.
NEW_INSERT = "new_insert"
EXIST_INSERT = "exist_insert"
UPDATE = "update"
DELETE = "delete"


class RoleError(ValueError):
    """A frame or table name does not follow the column-role conventions."""


def key_columns(columns: Iterable[str]) -> list[str]:
    """Business-key columns in frame order (``KEY_`` prefix)."""
    return [c for c in columns if c.startswith(KEY_PREFIX)]


def sk_name_for(table_name: str) -> str:
    """``DIM2_order_items`` -> ``SK_order_items``."""
    parts = table_name.split("_")
    if len(parts) < 2 or not parts[1]:
        raise RoleError(f"table name {table_name!r} has no '<TYPE>_<name>' form")
    return SK_PREFIX + "_".join(parts[1:])


def sk_column(columns: Iterable[str]) -> str:
    """The one surrogate-key column of a gold frame; zero or several is an error."""
    found = [c for c in columns if c.startswith(SK_PREFIX)]
    if len(found) != 1:
        raise RoleError(f"expected exactly one {SK_PREFIX}* column, found {found}")
    return found[0]


def scd_type(table_name: str) -> int:
    """Prefix ``DIM1``/``DIM2`` (case-insensitive) -> 1/2; anything else raises."""
    prefix = table_name.split("_")[0].upper()
    if prefix == "DIM1":
        return 1
    if prefix == "DIM2":
        return 2
    raise RoleError(f"cannot identify the dimension type of table {table_name!r}")


def resolve_keys(columns: Sequence[str], keys: Sequence[str] | None, ignore: Iterable[str] = ()) -> list[str]:
    """Explicit keys, else the ``KEY_`` columns; a key that is ignored or missing is an error."""
    ks = list(keys) if keys is not None else key_columns(columns)
    ignored = set(ignore)
    missing = [k for k in ks if k not in columns]
    if missing:
        raise RoleError(f"key columns {missing} not in frame columns {list(columns)}")
    clash = [k for k in ks if k in ignored]
    if clash:
        raise RoleError(f"key columns {clash} cannot be ignored")
    return ks


def attribute_columns(columns: Sequence[str], keys: Sequence[str], extra_exclude: Iterable[str] = ()) -> list[str]:
    """Columns that are neither keys, surrogate key, hash nor validity dates."""
    excl = set(keys) | {HASH_COL, CREATED_COL, UPDATED_COL} | set(extra_exclude)
    return [c for c in columns if c not in excl and not c.startswith(SK_PREFIX)]
