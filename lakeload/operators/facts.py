"""Fact loading: replace business keys by dimension surrogate keys.

For a type 2 dimension the version valid at the fact's date is taken
(``created_date <= d < updated_date``); without a date, the current version. A key without a
matching version gets ``-1``. The join is an equi-join on the key with the range as a join
condition; Spark plans it as a broadcast join when the dimension side is small at run time (AQE)
and as a sort-merge join otherwise, where AQE splits skewed fact-side partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lakeload.functions.dates import STAMP_FORMAT, stamp_col
from lakeload.plans.roles import CREATED_COL, OPEN_END, UPDATED_COL, key_columns, sk_column

UNKNOWN_SK = -1
_D = "_d_"


@dataclass(frozen=True)
class DimLookup:
    dim: DataFrame
    fact_keys: Sequence[str]
    dim_keys: Sequence[str] | None = None
    as_of: str | None = None
    keep_keys: bool = False
    name: str | None = None  # of the surrogate key column; needed if a dimension plays several roles

    @property
    def sk_name(self) -> str:
        return self.name or sk_column(self.dim.columns)


def check_versions(dim: DataFrame, keys: Sequence[str] | None = None) -> None:
    """Raise unless every key has one version at any time (else a lookup would multiply fact rows)."""
    ks = list(keys) if keys is not None else key_columns(dim.columns)
    if UPDATED_COL in dim.columns:
        by_key = Window.partitionBy(*ks).orderBy(CREATED_COL, UPDATED_COL)
        wrong = dim.select(*ks, UPDATED_COL, F.lead(CREATED_COL).over(by_key).alias("_ll_next")).filter(
            F.col("_ll_next") < F.col(UPDATED_COL)
        )
    else:
        wrong = dim.groupBy(*ks).count().filter("count > 1")
    found = wrong.select(*ks).take(3)
    if found:
        raise ValueError(f"dimension has overlapping versions of keys {[tuple(r) for r in found]}")


def fact_stamp(fact: DataFrame, column: str) -> Column:
    """The facts' time as a 12-digit stamp; text may be a stamp already, or a date or timestamp (e.g. from CSV)."""
    at = F.col(column)
    if not isinstance(fact.schema[column].dataType, StringType):
        return stamp_col(at)
    return F.when(at.rlike("^[0-9]{12}$"), at).otherwise(F.date_format(F.try_to_timestamp(at), STAMP_FORMAT))


def lookup_sk(fact: DataFrame, lookup: DimLookup, unknown: int = UNKNOWN_SK) -> DataFrame:
    dim = lookup.dim
    dkeys = list(lookup.dim_keys) if lookup.dim_keys is not None else key_columns(dim.columns)
    fkeys = list(lookup.fact_keys)
    if len(dkeys) != len(fkeys) or not dkeys:
        raise ValueError(f"fact keys {fkeys} do not match dimension keys {dkeys}")
    sk = sk_column(dim.columns)
    if lookup.sk_name in fact.columns:
        raise ValueError(f"fact has a column {lookup.sk_name} already; give the lookup a name of its own")
    versioned = CREATED_COL in dim.columns and UPDATED_COL in dim.columns
    cols = dkeys + [sk] + ([CREATED_COL, UPDATED_COL] if versioned else [])
    d = dim.select(*[F.col(c).alias(_D + c) for c in cols])
    cond = None
    for fk, dk in zip(fkeys, dkeys):
        c = F.col(fk) == F.col(_D + dk)
        cond = c if cond is None else cond & c
    if versioned:
        if lookup.as_of is None:
            d = d.filter(F.col(_D + UPDATED_COL) == F.lit(OPEN_END))
        else:
            at = fact_stamp(fact, lookup.as_of)
            cond = cond & (F.col(_D + CREATED_COL) <= at) & (at < F.col(_D + UPDATED_COL))
    out = fact.join(d, cond, "left").withColumn(
        lookup.sk_name, F.coalesce(F.col(_D + sk), F.lit(unknown)).cast("bigint")
    )
    out = out.drop(*[_D + c for c in cols])
    return out if lookup.keep_keys else out.drop(*fkeys)


def load_fact(fact: DataFrame, lookups: Sequence[DimLookup], unknown: int = UNKNOWN_SK) -> DataFrame:
    """Every lookup in turn; key columns go at the end, so that several lookups may use one."""
    for lk in lookups:
        fact = lookup_sk(fact, replace(lk, keep_keys=True), unknown)
    kept = {k for lk in lookups if lk.keep_keys for k in lk.fact_keys}
    return fact.drop(*{k for lk in lookups for k in lk.fact_keys} - kept)
