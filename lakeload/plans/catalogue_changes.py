"""Queries of the operators that move changes only: merges by bucket, difference feeds, late members, time joins.

They use the snapshots and the SQL of :mod:`lakeload.plans.catalogue`; registered there.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeload.operators.asof import lookup_sk_sorted
from lakeload.operators.facts import DimLookup
from lakeload.operators.prepare import hash_key, rename_keys
from lakeload.operators.scd1 import scd1_create
from lakeload.operators.scd2 import CLOSE, scd2_create, scd2_interval_join, scd2_merge
from lakeload.operators.snapshots import snapshot_diff
from lakeload.operators.validate import DuplicateKeyError
from lakeload.plans.catalogue import (
    CUST_COLS,
    CUST_SPEC,
    DAY1,
    DAY2,
    DAY3,
    LOAD_DATA,
    ORACLES,
    SQL_CUST,
    SQL_CUST_M2,
    SQL_LOADS,
    STAMP2,
    STAMP3,
    _dec,
    _landing,
    _t,
    cust_gold_day2,
    cust_raw,
    cust_raw_day2,
    cust_raw_day3,
    cust_src,
    orders_at,
    part_raw,
    part_raw_day2,
    part_src,
    query,
    sql_hash,
    sql_scd2,
)
from lakeload.plans.layout import Layout
from lakeload.plans.runs import (
    FactSpec,
    SilverSpec,
    load_gold,
    register_gold_tables,
    run_difference,
    run_facts,
    run_layers,
    run_silver,
)
from lakeload.session import scratch_path
from lakeload.sources.buckets import create_buckets, merge_scd1_buckets, merge_scd2_buckets, read_buckets
from lakeload.sources.clustered import create_clustered, merge_scd2_clustered, read_clustered
from lakeload.sources.files import read_silver, silver_loads, write_snapshot
from lakeload.sources.store import read_table


# ------------------------------------------------------------------ J3, J4, C8, C11 merges of touched buckets
@query("scd1_merge_buckets", ORACLES["scd1_merge"])
def q_scd1_merge_buckets(spark, sf):
    """Part as a table in buckets: day 2 rewrites only the buckets that hold a changed or new part."""
    path, r1 = scratch_path(spark, "q-buckets"), part_raw(spark, sf)
    create_buckets(scd1_create(part_src(r1), sk="SK_part"), path)
    merge_scd1_buckets(spark, path, part_src(part_raw_day2(r1)))
    return read_buckets(spark, path)


def _cust_buckets(spark, sf, days: dict, **options):
    path, r1 = scratch_path(spark, "q-buckets"), cust_raw(spark, sf)
    create_buckets(scd2_create(cust_src(r1), sk="SK_customer"), path)
    for day, raw in days.items():
        merge_scd2_buckets(spark, path, cust_src(raw(r1)), day, **options)
    return read_buckets(spark, path)


@query("scd2_merge_buckets", ORACLES["scd2_merge"])
def q_scd2_merge_buckets(spark, sf):
    return _cust_buckets(spark, sf, {DAY2: cust_raw_day2})


@query("scd2_merge_bucketed", ORACLES["scd2_merge"])
def q_scd2_merge_bucketed(spark, sf):
    """Customers bucketed by key in the catalog: the merge of day 2 shuffles the source, not the dimension."""
    path, r1 = scratch_path(spark, "q-clustered"), cust_raw(spark, sf)
    name = "q_" + path.rsplit("-", 1)[-1]
    create_clustered(scd2_create(cust_src(r1), sk="SK_customer"), name, path, buckets=8)
    merge_scd2_clustered(spark, name, path, cust_src(cust_raw_day2(r1)), DAY2)
    return read_clustered(spark, name, path)


_THREE_DAYS = "WITH " + SQL_CUST + "," + ",".join(
    sql_scd2(p, g, s, "KEY_c_custkey", "SK_customer", CUST_COLS + ["HASHCOLUMN"], now, close_missing=True)
    for p, g, s, now in (("x2", "g1", "s2", STAMP2), ("x3", "x2_m", "s3", STAMP3))
) + "SELECT * FROM x3_m"


@query("scd2_merge_buckets_missing", _THREE_DAYS)
def q_scd2_merge_buckets_missing(spark, sf):
    """Three days, keys missing from a snapshot close, returning keys reopen."""
    return _cust_buckets(spark, sf, {DAY2: cust_raw_day2, DAY3: cust_raw_day3}, close_missing=True)


# ------------------------------------------------------------------ C10, C11 difference of snapshots
@query(
    "snapshot_diff",
    "WITH " + SQL_CUST + f"""
SELECT {', '.join(f'CASE WHEN s2.KEY_c_custkey IS NULL THEN s1.{c} ELSE s2.{c} END AS {c}' for c in CUST_COLS + ['HASHCOLUMN'])},
  CASE WHEN s1.KEY_c_custkey IS NULL THEN 'insert' WHEN s2.KEY_c_custkey IS NULL THEN 'delete' ELSE 'update' END AS _change
FROM s1 FULL JOIN s2 ON s1.KEY_c_custkey = s2.KEY_c_custkey
WHERE s1.HASHCOLUMN IS DISTINCT FROM s2.HASHCOLUMN
""",
)
def q_snapshot_diff(spark, sf):
    r1 = cust_raw(spark, sf)
    return snapshot_diff(cust_src(r1), cust_src(cust_raw_day2(r1)))


@query(
    "gold_load_difference_feed",
    "WITH " + SQL_LOADS + "l3 AS (SELECT *, '2024-03-11' AS LoadDate FROM s3),"
    + sql_scd2("x2", "lg1", "l2", "KEY_c_custkey", "SK_customer", LOAD_DATA, STAMP2, close_missing=True) + ","
    + sql_scd2("x3", "x2_m", "l3", "KEY_c_custkey", "SK_customer", LOAD_DATA, STAMP3, close_missing=True) + "SELECT * FROM x3_m",
)
def q_gold_load_difference_feed(spark, sf):
    """Silver gets differences of the daily snapshots; gold merges them in close mode. The result is that of merging
    whole snapshots and closing what is missing from them."""
    layout, r1 = Layout(scratch_path(spark, "q-lake")), cust_raw(spark, sf)
    for day, raw in ((DAY1, r1), (DAY2, cust_raw_day2(r1)), (DAY3, cust_raw_day3(r1))):
        write_snapshot(raw, layout.bronze("tpch"), day, "customer")
        run_difference(spark, layout, CUST_SPEC, day)
        load_gold(spark, layout, "DIM2_customer", day, on_same_hash=CLOSE)
    return read_table(spark, layout.gold("DIM2_customer"))


# ------------------------------------------------------------------ C4, C5 stage, check, publish
@query(
    "silver_publish",
    "WITH " + SQL_LOADS.rstrip().rstrip(",") + """
SELECT * FROM l1 UNION ALL SELECT * FROM l2
""",
)
def q_silver_publish(spark, sf):
    """A broken second load (two rows for some keys) is dropped before it is seen, its repair is published."""
    layout, r1 = Layout(scratch_path(spark, "q-lake")), cust_raw(spark, sf)
    good = cust_raw_day2(r1)
    broken = good.unionByName(good.filter("c_nationkey = 7").withColumn("c_name", F.lit("another")))
    for day, raw in ((DAY1, r1), (DAY2, broken), (DAY2, good)):
        write_snapshot(raw, layout.bronze("tpch"), day, "customer")
        try:
            run_silver(spark, layout, [CUST_SPEC], day)
        except DuplicateKeyError:
            if silver_loads(spark, layout.silver("DIM2_customer")) != [DAY1]:
                raise
    return read_silver(spark, layout.silver("DIM2_customer"), newest_only=False)


# ------------------------------------------------------------------ C14, N2 a run goes on where it stopped
@query(
    "run_resume",
    """
WITH c AS (SELECT count(*) AS n FROM customer), o AS (SELECT count(*) AS n FROM orders)
SELECT 'bronze' AS layer, 'customer' AS table_name, 'ok' AS status, n AS rows_out FROM c
UNION ALL SELECT 'bronze', 'orders', 'ok', n FROM o
UNION ALL SELECT 'silver', 'DIM2_customer', 'ok', n FROM c
UNION ALL SELECT 'silver', 'DIM2_orders', 'failed', NULL
UNION ALL SELECT 'bronze', 'customer', 'kept', NULL UNION ALL SELECT 'bronze', 'orders', 'kept', NULL
UNION ALL SELECT 'silver', 'DIM2_customer', 'kept', NULL UNION ALL SELECT 'silver', 'DIM2_orders', 'ok', n FROM o
UNION ALL SELECT 'gold', 'DIM2_customer', 'created', n FROM c UNION ALL SELECT 'gold', 'DIM2_orders', 'created', n FROM o
""",
)
def q_run_resume(spark, sf):
    """The first run fails in silver (orders keyed by customer); repaired, the run goes on from its log."""
    layout, tables = Layout(scratch_path(spark, "q-lake")), ("customer", "orders")
    bronze = [{"source_path": "tpch/", "source_name": f"{n}.csv", "target_path": "tpch/", "target_name": n} for n in tables]
    _landing(spark, sf, layout, only=tables)
    for key in ("o_custkey", "o_orderkey"):
        specs = [CUST_SPEC, SilverSpec("DIM2_orders", "tpch", "orders", [key])]
        try:
            run_layers(spark, layout, bronze, specs, [s.table_name for s in specs], DAY1, resume=True)
        except DuplicateKeyError:
            if key != "o_custkey":
                raise
    return spark.read.parquet(layout.audit()).select("layer", "table_name", "status", "rows_out")


# ------------------------------------------------------------------ S11 SQL objects of the catalog
@query(
    "gold_sql_table",
    "WITH " + SQL_LOADS + sql_scd2("x2", "lg1", "l2", "KEY_c_custkey", "SK_customer", LOAD_DATA, STAMP2).lstrip()
    + """
SELECT c_nationkey, count(*) AS versions, count(DISTINCT KEY_c_custkey) AS customers,
  count(*) FILTER (WHERE updated_date = '999912312359') AS open_versions,
  CAST(sum(c_acctbal) FILTER (WHERE updated_date = '999912312359') AS DECIMAL(28, 2)) AS balance
FROM x2_m GROUP BY c_nationkey
""",
)
def q_gold_sql_table(spark, sf):
    """Another session of the cluster asks the views that the loads left in the catalog."""
    layout, r1 = Layout(scratch_path(spark, "q-lake")), cust_raw(spark, sf)
    prefix = "q_" + layout.base.rstrip("/").rsplit("-", 1)[-1] + "_"
    for day, raw in ((DAY1, r1), (DAY2, cust_raw_day2(r1))):
        write_snapshot(raw, layout.bronze("tpch"), day, "customer")
        run_silver(spark, layout, [CUST_SPEC], day)
        load_gold(spark, layout, "DIM2_customer", day)
        register_gold_tables(spark, layout, ["DIM2_customer"], prefix)
    return spark.newSession().sql(f"""
        SELECT a.c_nationkey, versions, customers, coalesce(open_versions, 0) AS open_versions, balance
        FROM (SELECT c_nationkey, count(*) AS versions, count(DISTINCT KEY_c_custkey) AS customers
              FROM {prefix}DIM2_customer GROUP BY c_nationkey) a
        LEFT JOIN (SELECT c_nationkey, count(*) AS open_versions, CAST(sum(c_acctbal) AS DECIMAL(28, 2)) AS balance
              FROM {prefix}DIM2_customer_current GROUP BY c_nationkey) b ON a.c_nationkey = b.c_nationkey""")


# ------------------------------------------------------------------ N1 facts
@query("fact_asof_union", ORACLES["fact_asof_lookup"])
def q_fact_asof_union(spark, sf):
    """The as-of lookup of ``fact_asof_lookup`` by one sort of facts and versions instead of a range join."""
    return lookup_sk_sorted(orders_at(spark, sf), DimLookup(cust_gold_day2(spark, sf), ["o_custkey"], as_of="at_stamp"))


_LATE = {3: 1, 8: 2}  # nations whose customers arrive after so many days
_ARRIVES = "CASE c_nationkey " + " ".join(f"WHEN {n} THEN {d}" for n, d in _LATE.items()) + " ELSE 0 END"


@query(
    "fact_late_member",
    f"""
WITH c AS (SELECT c_custkey, row_number() OVER (ORDER BY {_ARRIVES}, c_custkey) AS sk FROM customer)
SELECT o_orderkey AS KEY_o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
  strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority, coalesce(sk, -1) AS SK_customer,
  CASE o_orderstatus WHEN 'F' THEN '2024-03-09' WHEN 'O' THEN '2024-03-10' ELSE '2024-03-11' END AS LoadDate
FROM orders LEFT JOIN c ON c_custkey = o_custkey
""",
)
def q_fact_late_member(spark, sf):
    """Orders land over three days, the customers of some nations only after their orders: the facts are loaded with -1
    and resolved when the customer arrives."""
    layout = Layout(scratch_path(spark, "q-lake"))
    orders = _t(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", _dec("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderpriority",
    )
    status = F.col("o_orderstatus")
    landed = {DAY1: status == "F", DAY2: status == "O", DAY3: ~status.isin("F", "O")}
    specs = [CUST_SPEC, SilverSpec("FACT_orders", "tpch", "orders", ["o_orderkey"])]
    lookup = {"dim": "DIM2_customer", "keys": ["o_custkey"], "as_of": "o_orderdate"}
    fact = FactSpec("FACT_orders", "FACT_orders", (lookup,), keep_keys=True)
    for n, (day, part) in enumerate(landed.items()):
        here = ~F.col("c_nationkey").isin([k for k, d in _LATE.items() if d > n])
        write_snapshot(cust_raw(spark, sf).filter(here), layout.bronze("tpch"), day, "customer")
        write_snapshot(orders.filter(part), layout.bronze("tpch"), day, "orders")
        run_silver(spark, layout, specs, day)
        load_gold(spark, layout, "DIM2_customer", day)
        run_facts(spark, layout, [fact], day)
    out = spark.read.parquet(layout.gold("FACT_orders"))
    return out.drop("HASHCOLUMN").withColumn("LoadDate", F.col("LoadDate").cast("string"))


# ------------------------------------------------------------------ N3 dimensions connected in time
SQL_NATION = f"""
n1 AS (SELECT *, {sql_hash(['KEY_n_nationkey', 'n_name', 'n_regionkey'])} AS HASHCOLUMN
       FROM (SELECT n_nationkey AS KEY_n_nationkey, n_name, n_regionkey FROM nation)),
n2 AS (SELECT * REPLACE ({sql_hash(['KEY_n_nationkey', 'n_name', 'n_regionkey'])} AS HASHCOLUMN)
       FROM (SELECT * REPLACE (CASE WHEN n_regionkey < 2 THEN n_name || '_X' ELSE n_name END AS n_name) FROM n1)),
ng AS (SELECT *, row_number() OVER (ORDER BY KEY_n_nationkey) AS SK_nation,
              '190001010000' AS created_date, '999912312359' AS updated_date FROM n1)
"""


@query(
    "scd2_interval_join",
    "WITH " + SQL_CUST_M2.rstrip() + "," + SQL_NATION.rstrip() + ","
    + sql_scd2("y", "ng", "n2", "KEY_n_nationkey", "SK_nation", ["KEY_n_nationkey", "n_name", "n_regionkey", "HASHCOLUMN"], STAMP3)
    + f"""
SELECT c.KEY_c_custkey, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment, c.SK_customer, n.n_name, n.n_regionkey, n.SK_nation,
  greatest(c.created_date, n.created_date) AS created_date, least(c.updated_date, n.updated_date) AS updated_date
FROM m2_m c JOIN y_m n ON c.c_nationkey = n.KEY_n_nationkey
  AND greatest(c.created_date, n.created_date) < least(c.updated_date, n.updated_date)
""",
)
def q_scd2_interval_join(spark, sf):
    """Customers (changed on day 2) with their nations (changed on day 3): a row for every stretch of both."""
    n1 = rename_keys(_t(spark, sf, "nation"), ["n_nationkey"])
    n2 = n1.withColumn("n_name", F.when(F.col("n_regionkey") < 2, F.concat("n_name", F.lit("_X"))).otherwise(F.col("n_name")))
    nation = scd2_merge(scd2_create(hash_key(n1), sk="SK_nation"), hash_key(n2), now=DAY3)
    return scd2_interval_join(cust_gold_day2(spark, sf), nation, {"c_nationkey": "KEY_n_nationkey"})

