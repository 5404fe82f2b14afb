"""Accent removal: NFD-decompose and drop non-spacing marks (Unicode category ``Mn``).

The default form is a single Catalyst ``translate`` expression whose table is derived once, on the
driver, from the Unicode database by rule: every code point whose NFD form without ``Mn`` marks is
one character maps to it, every code point that is all marks is deleted. It stays inside whole-stage
codegen and processes whole texts. Code points whose stripped form has several characters (Hangul
syllables, a few others) are left unchanged by it; ``exact=True`` runs the rule itself through an
Arrow-batched pandas UDF for those callers.
"""

from __future__ import annotations

import functools
import sys
import unicodedata

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

SQL_NAME = "RemoveAccentsUDF"
SQL_NAME_EXACT = "RemoveAccentsExactUDF"
SQL_NAME_FAST = "RemoveAccentsFast"


def strip_marks(text: str | None) -> str | None:
    """Reference rule on one Python string (also the oracle for tests)."""
    if text is None:
        return None
    return "".join(ch for ch in unicodedata.normalize("NFD", text) if unicodedata.category(ch) != "Mn")


@functools.lru_cache(maxsize=1)
def translate_table() -> tuple[str, str]:
    """(from, to) for ``translate``: mapped characters first, then deleted ones."""
    mapped_from, mapped_to, deleted = [], [], []
    for cp in range(sys.maxunicode + 1):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        out = strip_marks(ch)
        if out == ch:
            continue
        if out == "":
            deleted.append(ch)
        elif len(out) == 1:
            mapped_from.append(ch)
            mapped_to.append(out)
    return "".join(mapped_from) + "".join(deleted), "".join(mapped_to)


@F.pandas_udf(StringType())
def _strip_marks_exact(s: pd.Series) -> pd.Series:
    return s.map(strip_marks, na_action="ignore")


def remove_accents(c: Column | str, exact: bool = False) -> Column:
    """NULL -> NULL; otherwise the text without accents."""
    col = F.col(c) if isinstance(c, str) else c
    if exact:
        return _strip_marks_exact(col)
    src, dst = translate_table()
    return F.translate(col, src, dst)


def _sql_literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_sql_functions(spark: SparkSession) -> None:
    """``RemoveAccentsUDF(s)`` (also ``RemoveAccentsExactUDF``): the exact rule; ``RemoveAccentsFast(s)``: ``translate``."""
    src, dst = translate_table()
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {SQL_NAME_FAST}(s STRING) RETURNS STRING "
        f"RETURN translate(s, {_sql_literal(src)}, {_sql_literal(dst)})"
    )
    for name in (SQL_NAME, SQL_NAME_EXACT):
        spark.udf.register(name, _strip_marks_exact)
