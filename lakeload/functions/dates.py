"""Run-date handling: every stamp is a ``yyyyMMddHHmm`` string (lexicographic = time order)."""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

STAMP_FORMAT = "yyyyMMddHHmm"
_DIGITS12 = re.compile(r"^\d{12}$")
_DAY = re.compile(r"^\d{4}-\d{2}-\d{2}$")


def to_stamp(value: str | _dt.date | _dt.datetime | None = None) -> str:
    """Normalise a run date to ``yyyyMMddHHmm`` (24-hour clock).

    Accepts a date, a datetime, ``'yyyy-MM-dd'``, ``'yyyy-MM-dd HH:mm[:ss]'`` or twelve digits; ``None`` is
    today, in UTC.
    """
    if value is None:
        return _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d") + "0000"
    if isinstance(value, _dt.datetime):
        return value.strftime("%Y%m%d%H%M")
    if isinstance(value, _dt.date):
        return value.strftime("%Y%m%d") + "0000"
    text = str(value).strip()
    if _DIGITS12.match(text):
        _dt.datetime.strptime(text, "%Y%m%d%H%M")  # validates
        return text
    if _DAY.match(text):
        return _dt.datetime.strptime(text, "%Y-%m-%d").strftime("%Y%m%d") + "0000"
    for fmt in ("%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%dT%H:%M"):
        try:
            return _dt.datetime.strptime(text, fmt).strftime("%Y%m%d%H%M")
        except ValueError:
            pass
    raise ValueError(f"cannot read run date {value!r}")


def to_day(value: str | _dt.date | _dt.datetime | None = None) -> str:
    """``yyyy-MM-dd`` of a run date (folder name of a bronze snapshot, silver ``LoadDate``)."""
    s = to_stamp(value)
    return f"{s[0:4]}-{s[4:6]}-{s[6:8]}"


def stamp_col(c: Column) -> Column:
    """Column version of :func:`to_stamp` for date / timestamp columns."""
    return F.date_format(c, STAMP_FORMAT)


def stamp_to_timestamp(c: Column) -> Column:
    """``yyyyMMddHHmm`` string -> ``timestamp_ntz`` (for history views)."""
    return F.to_timestamp_ntz(c, F.lit(STAMP_FORMAT))
