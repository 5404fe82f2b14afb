"""Row fingerprints as Catalyst expressions (JVM-side, whole-stage codegen)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType

from lakeload.plans.roles import HASH_COL

COMPAT = "compat"
SAFE = "safe"
_RAW = "_ll_raw_"


def _as_text(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, MapType):
        raise TypeError(f"column {name!r} is a map; maps have no stable string form to hash")
    return F.col(name).cast("string")


def row_hash(df: DataFrame, columns: Sequence[str], mode: str = SAFE) -> Column:
    """SHA-256 (lower-case hex) over ``columns`` of ``df``.

    ``compat``: undelimited concatenation of the string forms in the given order, NULL as ''
    (so ``('ab','c')`` and ``('a','bc')`` collide, kept for parity with existing loads).
    ``safe``: columns sorted by name, each value written as ``<byte length>:<value>``, NULL as ``~``;
    the encoding is prefix-free, so different rows never share an input string.
    """
    if not columns:
        return F.sha2(F.lit(""), 256)
    if mode == COMPAT:
        parts = [F.coalesce(_as_text(df, c), F.lit("")) for c in columns]
    elif mode == SAFE:
        parts = []
        for c in sorted(columns):
            s = _as_text(df, c)
            parts.append(F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("~")))
    else:
        raise ValueError(f"unknown hash mode {mode!r}")
    return F.sha2(F.concat(*parts), 256)


def row_fingerprint(df: DataFrame, columns: Sequence[str]) -> Column:
    """128-bit row identity for grouping: two differently seeded ``xxhash64`` over the typed values and
    a NULL mask (hash functions skip NULLs, so the mask keeps ``(NULL, 'x')`` apart from ``('x', NULL)``).

    Cheap (no string casts) and used only to tell rows *of the same key* apart, where a collision of
    two different rows has probability about 2**-128.
    """
    cols = [c for c in columns if not isinstance(df.schema[c].dataType, MapType)]
    if len(cols) != len(columns):
        raise TypeError("map columns cannot be fingerprinted")
    if not cols:
        return F.struct(F.lit(0).cast("long").alias("h1"), F.lit(0).cast("long").alias("h2"))
    mask = F.array(*[F.col(c).isNull() for c in cols])
    return F.struct(
        F.xxhash64(F.lit(1), *[F.col(c) for c in cols], mask).alias("h1"),
        F.xxhash64(F.lit(2), *[F.col(c) for c in cols], mask).alias("h2"),
    )


def _hashes(df: DataFrame, but: list[str]) -> list[str]:
    return [f.name for f in df.schema if f.name.endswith(HASH_COL) and isinstance(f.dataType, StringType) and f.name not in but]


def _is_hex(c: str) -> Column:
    return F.col(c).rlike("^[0-9a-f]{64}$")


def pack_hashes(df: DataFrame, but: list[str] | tuple = ()) -> DataFrame:
    """Row hashes (hex text) as their 32 bytes, for an exchange; other text stays as it is. :func:`unpack_hashes` undoes it."""
    packed = _hashes(df, list(but))
    both = {_RAW + c: F.when(_is_hex(c), F.unhex(c)) for c in packed} | {c: F.when(~_is_hex(c), F.col(c)) for c in packed}
    return df.withColumns(both) if packed else df


def unpack_hashes(df: DataFrame) -> DataFrame:
    raw = [c for c in df.columns if c.startswith(_RAW)]
    whole = {c.removeprefix(_RAW): F.coalesce(F.lower(F.hex(c)), F.col(c.removeprefix(_RAW))) for c in raw}
    return df.withColumns(whole).drop(*raw) if raw else df
