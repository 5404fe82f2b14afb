"""As-of lookup by a sorted union: the version valid at a fact's time, without comparing facts with every version.

Facts and versions of a dimension are put into one frame and sorted by key and time; the last version met before a
fact is the candidate, and it holds if it has not ended. One shuffle and one sort, whatever the number of versions
per key (a range join compares each fact with all versions of its key).

A window gives a key to one task, so hot keys are cut first. A key is hot when it has more than a thousandth of all facts
(and more than ``hot_rows``), so there are a thousand at most and their list is broadcast. Their facts' quantiles cut the
time into ranges of about equally many facts; a version is carried over each cut that lies in its validity, as a
copy that starts at the cut. Where many facts share one moment, cuts coincide and the ranges are salted instead, with
a copy of the versions for every salt. Keys and times that are NULL match nothing and never enter the sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeload.operators.facts import _D, UNKNOWN_SK, DimLookup, fact_stamp
from lakeload.plans.roles import CREATED_COL, UPDATED_COL, key_columns, sk_column

HOT_SHARE = 1000  # at most so many hot keys
HOT_ROWS = 1_000_000
PIECES = 128  # a hot key is cut into about so many


def _hot_cuts(facts: DataFrame, names: list[str], hot_rows: int, pieces: int) -> DataFrame:
    """(keys, cuts, salts) of the hot keys."""
    limit = max(hot_rows, facts.count() // HOT_SHARE)
    hot = facts.groupBy(*names).count().filter(F.col("count") > limit).select(*names)
    share = [k / pieces for k in range(1, pieces)]
    cuts = facts.join(F.broadcast(hot), names).groupBy(*names).agg(
        F.array_sort(F.array_distinct(F.percentile_approx("_ll_at", share, 1000))).alias("_ll_cuts")
    )
    return cuts.withColumn("_ll_salts", F.ceil(F.lit(pieces) / (F.size("_ll_cuts") + 1)).cast("int"))


def _range_of(at: Column, strictly: bool = False) -> Column:
    """The range a time lies in: how many cuts are not after it (``strictly``: before it)."""
    inside = F.filter("_ll_cuts", lambda c: (c < at) if strictly else (c <= at))
    return F.when(F.col("_ll_cuts").isNull(), 0).otherwise(F.size(inside))


def lookup_sk_sorted(
    fact: DataFrame, lookup: DimLookup, unknown: int = UNKNOWN_SK, hot_rows: int = HOT_ROWS, pieces: int = PIECES
) -> DataFrame:
    """``fact`` with the SK of the version valid at ``lookup.as_of`` (result of ``lookup_sk``)."""
    dim, sk = lookup.dim, sk_column(lookup.dim.columns)
    dkeys = list(lookup.dim_keys) if lookup.dim_keys is not None else key_columns(dim.columns)
    fkeys = list(lookup.fact_keys)
    if lookup.as_of is None or UPDATED_COL not in dim.columns:
        raise ValueError("a sorted lookup needs a type 2 dimension and the facts' time")
    if len(dkeys) != len(fkeys) or not dkeys:
        raise ValueError(f"fact keys {fkeys} do not match dimension keys {dkeys}")
    if lookup.sk_name in fact.columns:
        raise ValueError(f"fact has a column {lookup.sk_name} already; give the lookup a name of its own")
    names = [f"{_D}k{i}" for i in range(len(dkeys))]
    common = fact.select(*fkeys).limit(0).union(dim.select(*dkeys).limit(0)).schema  # keys compare as in a join
    keyed = lambda cols: [F.col(c).cast(f.dataType).alias(n) for c, n, f in zip(cols, names, common)]

    rows = fact.select(F.struct(*fact.columns).alias("_ll_fact"), *keyed(fkeys), fact_stamp(fact, lookup.as_of).cast("long").alias("_ll_at"))
    whole = F.col("_ll_at").isNotNull()
    for n in names:
        whole = whole & F.col(n).isNotNull()
    facts, rest = rows.filter(whole), rows.filter(~whole)
    cuts = _hot_cuts(facts.select(*names, "_ll_at"), names, hot_rows, pieces)

    salts = F.coalesce(F.col("_ll_salts"), F.lit(1))
    facts = facts.join(F.broadcast(cuts), names, "left").select(
        *names, _range_of(F.col("_ll_at")).alias("_ll_range"), F.pmod(F.xxhash64("_ll_fact"), salts).cast("int").alias("_ll_salt"),
        "_ll_at", F.lit(1).alias("_ll_kind"), F.lit(None).cast("long").alias("_ll_sk"), F.lit(None).cast("long").alias("_ll_end"),
        "_ll_fact",
    )
    versions = dim.select(
        *keyed(dkeys), F.col(CREATED_COL).cast("long").alias("_ll_at"), F.col(sk).cast("long").alias("_ll_sk"),
        F.col(UPDATED_COL).cast("long").alias("_ll_end"),
    ).filter("_ll_at < _ll_end")
    versions = versions.join(F.broadcast(cuts), names, "left")
    spans = F.sequence(_range_of(F.col("_ll_at")), _range_of(F.col("_ll_end"), strictly=True))
    versions = versions.select("*", F.explode(spans).alias("_ll_range"))
    versions = versions.select("*", F.explode(F.sequence(F.lit(0), salts - 1)).alias("_ll_salt"))
    starts = F.when(F.col("_ll_range") > 0, F.greatest("_ll_at", F.get("_ll_cuts", F.col("_ll_range") - 1))).otherwise(F.col("_ll_at"))
    versions = versions.withColumns({"_ll_at": starts, "_ll_kind": F.lit(0), "_ll_fact": F.lit(None).cast(facts.schema["_ll_fact"].dataType)})

    over = Window.partitionBy(*names, "_ll_range", "_ll_salt").orderBy("_ll_at", "_ll_kind").rowsBetween(Window.unboundedPreceding, 0)
    version = F.when(F.col("_ll_kind") == 0, F.struct("_ll_sk", "_ll_end"))
    met = facts.unionByName(versions.select(*facts.columns)).withColumn("_ll_met", F.last(version, ignorenulls=True).over(over))
    holds = F.col("_ll_at") < F.col("_ll_met._ll_end")
    met = met.filter("_ll_kind = 1").select("_ll_fact.*", F.when(holds, F.col("_ll_met._ll_sk")).alias(lookup.sk_name))
    out = met.unionByName(rest.select("_ll_fact.*", F.lit(None).cast("long").alias(lookup.sk_name)))
    out = out.withColumn(lookup.sk_name, F.coalesce(lookup.sk_name, F.lit(unknown)).cast("bigint"))
    return out if lookup.keep_keys else out.drop(*fkeys)
