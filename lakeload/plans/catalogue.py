"""Query catalogue: one Spark query per operator of the inventory, each with its DuckDB oracle.

Every query reads the driver's tables under ``sf_dir`` (or data Spark derives from them) and runs
over whole tables. Queries that exercise writers write into a fresh folder under the session's
``spark.checkpoint.dir`` and read the result back.

Changed snapshots ("day 2", "day 3") are derived from attribute values, so they grow with the
tables:

* customer day 2: ``c_mktsegment || '_X'`` where ``c_nationkey IN (1, 2, 3)``; rows with
  ``c_nationkey = 4`` are gone; rows with ``c_nationkey = 5`` are copied as new customers with key
  ``-c_custkey - 1`` and ``c_name || '_N'``.
* customer day 3: the day-1 rows of nations 1, 6, 7; nation 1 with the day-2 change, nations 6 and 7
  with ``c_mktsegment || '_Y'``.
* part day 2: ``p_type || '_X'`` where ``p_size < 10``; rows with ``p_size > 45`` are gone; rows with
  ``p_size = 1`` are copied as new parts with key ``-p_partkey - 1`` and ``p_name || '_N'``.

Doubles are cast to ``decimal(18,2)`` before hashing or printing (the engines print doubles
differently); timestamps are printed through an explicit format.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.functions.hashing import COMPAT, SAFE
from lakeload.functions.text import register_sql_functions, remove_accents
from lakeload.operators.facts import DimLookup, load_fact
from lakeload.operators.numbering import number_rows
from lakeload.operators.prepare import add_load_date, geo_normalise, hash_key, prepare_silver, rename_keys
from lakeload.operators.scd1 import scd1_create, scd1_merge
from lakeload.operators.scd2 import (
    CLOSE,
    scd2_actions,
    scd2_as_of,
    scd2_create,
    scd2_current,
    scd2_history,
    scd2_latest,
    scd2_merge,
)
from lakeload.operators.validate import DuplicateKeyError, count_distinct_keys, first_per_key, validate_keys_df
from lakeload.plans.layout import Layout
from lakeload.plans.roles import CREATED_COL, OPEN_END, UPDATED_COL
from lakeload.plans.runs import (
    FactSpec,
    SilverSpec,
    load_gold,
    register_gold_views,
    run_bronze,
    run_layers,
    run_silver,
    audit_frame,
    run_from_config,
)
from lakeload.session import scratch_path
from lakeload.sources.config import BRONZE_SCHEMA, read_config
from lakeload.sources.files import (
    append_rows,
    append_silver,
    read_csv,
    read_latest_partition,
    read_latest_snapshot,
    read_silver,
    typed_copy,
    write_snapshot,
)
from lakeload.sources.store import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

DAY1, DAY2, DAY3 = "2024-03-09", "2024-03-10", "2024-03-11"
STAMP2, STAMP3 = "202403100000", "202403110000"


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return deco


# ------------------------------------------------------------------ shared Spark fixtures
def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def _dec(c: str):
    return F.col(c).cast("decimal(18,2)").alias(c)


def cust_raw(spark, sf):
    return _t(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", _dec("c_acctbal"), "c_mktsegment")


def cust_raw_day2(r1: DataFrame) -> DataFrame:
    seg = F.col("c_mktsegment")
    kept = r1.filter(F.col("c_nationkey") != 4).withColumn(
        "c_mktsegment", F.when(F.col("c_nationkey").isin(1, 2, 3), F.concat(seg, F.lit("_X"))).otherwise(seg)
    )
    new = r1.filter(F.col("c_nationkey") == 5).select(
        (-F.col("c_custkey") - 1).alias("c_custkey"),
        F.concat("c_name", F.lit("_N")).alias("c_name"),
        "c_nationkey",
        "c_acctbal",
        "c_mktsegment",
    )
    return kept.unionByName(new)


def cust_raw_day3(r1: DataFrame) -> DataFrame:
    seg = F.col("c_mktsegment")
    return r1.filter(F.col("c_nationkey").isin(1, 6, 7)).withColumn(
        "c_mktsegment",
        F.when(F.col("c_nationkey") == 1, F.concat(seg, F.lit("_X"))).otherwise(F.concat(seg, F.lit("_Y"))),
    )


def cust_src(raw: DataFrame) -> DataFrame:
    """Silver form: key marked, fingerprint (safe mode)."""
    return hash_key(rename_keys(raw, ["c_custkey"]))


def part_raw(spark, sf):
    return _t(spark, sf, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size", _dec("p_retailprice")
    )


def part_raw_day2(r1: DataFrame) -> DataFrame:
    kept = r1.filter(F.col("p_size") <= 45).withColumn(
        "p_type", F.when(F.col("p_size") < 10, F.concat("p_type", F.lit("_X"))).otherwise(F.col("p_type"))
    )
    new = r1.filter(F.col("p_size") == 1).select(
        (-F.col("p_partkey") - 1).alias("p_partkey"),
        F.concat("p_name", F.lit("_N")).alias("p_name"),
        "p_brand",
        "p_type",
        "p_size",
        "p_retailprice",
    )
    return kept.unionByName(new)


def part_src(raw: DataFrame) -> DataFrame:
    return hash_key(rename_keys(raw, ["p_partkey"]))


def cust_gold_day1(spark, sf):
    return scd2_create(cust_src(cust_raw(spark, sf)), sk="SK_customer")


def cust_gold_day2(spark, sf, mode="ignore"):
    r1 = cust_raw(spark, sf)
    return scd2_merge(scd2_create(cust_src(r1), sk="SK_customer"), cust_src(cust_raw_day2(r1)), now=DAY2, on_same_hash=mode)


# ------------------------------------------------------------------ shared SQL fixtures
CUST_COLS = ["KEY_c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
PART_COLS = ["KEY_p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]


def sql_hash(cols, mode=SAFE) -> str:
    if mode == COMPAT:
        parts = [f"coalesce(CAST({c} AS VARCHAR), '')" for c in cols]
    else:
        parts = [f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '~')" for c in sorted(cols)]
    return f"sha256(concat({', '.join(parts)}))"


SQL_CUST = f"""
r1 AS (SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal, c_mktsegment FROM customer),
r2 AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal,
         CASE WHEN c_nationkey IN (1, 2, 3) THEN c_mktsegment || '_X' ELSE c_mktsegment END AS c_mktsegment
  FROM r1 WHERE c_nationkey <> 4
  UNION ALL
  SELECT -c_custkey - 1, c_name || '_N', c_nationkey, c_acctbal, c_mktsegment FROM r1 WHERE c_nationkey = 5),
r3 AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal,
         CASE WHEN c_nationkey = 1 THEN c_mktsegment || '_X' ELSE c_mktsegment || '_Y' END AS c_mktsegment
  FROM r1 WHERE c_nationkey IN (1, 6, 7)),
s1 AS (SELECT *, {sql_hash(CUST_COLS)} AS HASHCOLUMN FROM (SELECT c_custkey AS KEY_c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM r1)),
s2 AS (SELECT *, {sql_hash(CUST_COLS)} AS HASHCOLUMN FROM (SELECT c_custkey AS KEY_c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM r2)),
s3 AS (SELECT *, {sql_hash(CUST_COLS)} AS HASHCOLUMN FROM (SELECT c_custkey AS KEY_c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM r3)),
g1 AS (SELECT *, row_number() OVER (ORDER BY KEY_c_custkey) AS SK_customer,
              '190001010000' AS created_date, '999912312359' AS updated_date FROM s1)
"""

SQL_PART = f"""
p1 AS (SELECT p_partkey, p_name, p_brand, p_type, p_size, CAST(p_retailprice AS DECIMAL(18,2)) AS p_retailprice FROM part),
p2 AS (
  SELECT p_partkey, p_name, p_brand, CASE WHEN p_size < 10 THEN p_type || '_X' ELSE p_type END AS p_type, p_size, p_retailprice
  FROM p1 WHERE p_size <= 45
  UNION ALL
  SELECT -p_partkey - 1, p_name || '_N', p_brand, p_type, p_size, p_retailprice FROM p1 WHERE p_size = 1),
ps1 AS (SELECT *, {sql_hash(PART_COLS)} AS HASHCOLUMN FROM (SELECT p_partkey AS KEY_p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM p1)),
ps2 AS (SELECT *, {sql_hash(PART_COLS)} AS HASHCOLUMN FROM (SELECT p_partkey AS KEY_p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM p2)),
pg1 AS (SELECT *, row_number() OVER (ORDER BY KEY_p_partkey) AS SK_part FROM ps1)
"""


def sql_scd2(
    p: str, gold: str, src: str, key: str, sk: str, data_cols, now: str, mode: str = "ignore", close_missing: bool = False
) -> str:
    """CTEs ``{p}_t`` (latest version), ``{p}_a`` (actions), ``{p}_m`` (merged dimension)."""
    cols = ", ".join(data_cols)
    close = "act = 'update'" + (" OR act = 'delete'" if mode == CLOSE else "")
    missing = (
        f" OR g.{sk} IN (SELECT t_sk FROM {p}_t WHERE t_updated = '999912312359' AND t_key NOT IN (SELECT {key} FROM {src}))"
        if close_missing
        else ""
    )
    return f"""
{p}_t AS (SELECT {key} AS t_key, {sk} AS t_sk, HASHCOLUMN AS t_hash, created_date AS t_created, updated_date AS t_updated
          FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {sk} DESC) AS rn FROM {gold}) WHERE rn = 1),
{p}_a AS (SELECT s.*, t.t_sk, t.t_hash, t.t_created, t.t_updated,
            CASE WHEN t.t_hash IS NULL THEN 'new_insert'
                 WHEN t.t_updated < '999912312359' THEN 'exist_insert'
                 WHEN t.t_hash <> s.HASHCOLUMN AND t.t_updated = '999912312359' THEN 'update'
                 WHEN t.t_hash = s.HASHCOLUMN AND t.t_updated = '999912312359' THEN 'delete' END AS act
          FROM {src} s LEFT JOIN {p}_t t ON s.{key} = t.t_key),
{p}_m AS (
  SELECT g.* REPLACE (CASE WHEN g.updated_date = '999912312359' AND (g.{sk} IN (SELECT t_sk FROM {p}_a WHERE {close}){missing})
                           THEN '{now}' ELSE g.updated_date END AS updated_date)
  FROM {gold} g
  UNION ALL BY NAME
  SELECT {cols}, CASE WHEN act = 'new_insert' THEN '190001010000' ELSE '{now}' END AS created_date,
         '999912312359' AS updated_date,
         (SELECT coalesce(max({sk}), 0) FROM {gold}) + row_number() OVER (ORDER BY {key}) AS {sk}
  FROM {p}_a WHERE act IN ('new_insert', 'exist_insert', 'update'))
"""


CUST_DATA = CUST_COLS + ["HASHCOLUMN"]
SQL_CUST_M2 = SQL_CUST + "," + sql_scd2("m2", "g1", "s2", "KEY_c_custkey", "SK_customer", CUST_DATA, STAMP2)


# ------------------------------------------------------------------ S1-S11 sources and sinks
@query(
    "config_lookup",
    """
SELECT 'landing/tpch/' AS source_path, s_name || '.csv' AS source_name, 'bronze/tpch/' AS target_path,
       lower(s_name) AS target_name
FROM supplier
""",
)
def q_config_lookup(spark, sf):
    """A concatenated-JSON config (pretty-printed objects, CRLF, no array) with one object per supplier."""
    obj = F.to_json(
        F.struct(
            F.lit("landing/tpch/").alias("source_path"),
            F.concat("s_name", F.lit(".csv")).alias("source_name"),
            F.lit("bronze/tpch/").alias("target_path"),
            F.lower("s_name").alias("target_name"),
        )
    )
    pretty = F.regexp_replace(F.regexp_replace(obj, '^\\{', '{\r\n    '), ',"', ',\r\n    "')
    pretty = F.regexp_replace(pretty, '\\}$', '\r\n}')
    path = scratch_path(spark, "q-config")
    _t(spark, sf, "supplier").select(pretty.alias("value")).write.option("lineSep", "\r\n").text(path)
    return read_config(spark, path, BRONZE_SCHEMA)


SQL_CUST_TEXT = """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS c_acctbal, c_mktsegment
FROM customer
"""


def _customer_csv(spark, sf) -> str:
    path = scratch_path(spark, "q-landing") + "/customer.csv"
    cust_raw(spark, sf).write.option("header", True).csv(path)
    return path


@query("csv_ingest", SQL_CUST_TEXT)
def q_csv_ingest(spark, sf):
    return read_csv(spark, _customer_csv(spark, sf))


@query(
    "typed_copy",
    """
SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal, c_mktsegment,
       TRY_CAST(c_name AS INTEGER) AS c_name_as_int
FROM customer
""",
)
def q_typed_copy(spark, sf):
    df = read_csv(spark, _customer_csv(spark, sf)).withColumn("c_name_as_int", F.col("c_name"))
    return typed_copy(
        df, {"c_custkey": "bigint", "c_nationkey": "int", "c_acctbal": "decimal(18,2)", "c_name_as_int": "int"}
    )


SQL_ORDERS_TEXT = """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority
FROM orders
"""


def _orders_print(df, *more):
    return df.select(
        "o_orderkey", "o_custkey", "o_orderstatus", _dec("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"), "o_orderpriority", *more,
    )


@query("bronze_roundtrip", SQL_ORDERS_TEXT)
def q_bronze_roundtrip(spark, sf):
    """Two dated snapshots; the newest one (by folder name, not listing order) is read back."""
    base = scratch_path(spark, "q-bronze")
    orders = _t(spark, sf, "orders")
    write_snapshot(orders, base, DAY2, "orders")
    write_snapshot(orders.filter(F.col("o_orderstatus") == "F"), base, DAY1, "orders")
    return _orders_print(read_latest_snapshot(spark, base, "orders"))


LINE_COLS_DEC = """l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS DECIMAL(18,2)) AS l_quantity,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS l_extendedprice, CAST(l_discount AS DECIMAL(18,2)) AS l_discount,
  CAST(l_tax AS DECIMAL(18,2)) AS l_tax, l_returnflag, l_linestatus, l_shipdate"""
SQL_LINES_TEXT = f"""
SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate) FROM (SELECT {LINE_COLS_DEC} FROM lineitem)
"""


def line_dec(spark, sf):
    return _t(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", _dec("l_quantity"), _dec("l_extendedprice"),
        _dec("l_discount"), _dec("l_tax"), "l_returnflag", "l_linestatus", "l_shipdate",
    )


def _lines_print(df):
    return df.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))


@query("parquet_scan", SQL_LINES_TEXT)
def q_parquet_scan(spark, sf):
    return _lines_print(line_dec(spark, sf))


@query(
    "latest_snapshot",
    """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type,
  CAST(value AS DECIMAL(18,2)) AS value, props
FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)
""",
)
def q_latest_snapshot(spark, sf):
    """Events cut into one folder per day; only the newest day is read (partition pruned)."""
    path = scratch_path(spark, "q-events")
    ev = _t(spark, sf, "events")
    ev.withColumn("day", F.date_format("ts", "yyyy-MM-dd")).write.partitionBy("day").parquet(path)
    out = read_latest_partition(spark, path, "day")
    return out.select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "user_id", "event_type",
        _dec("value"), "props",
    )


@query(
    "silver_append",
    "WITH " + SQL_CUST + """
SELECT *, '2024-03-09' AS LoadDate FROM s1 UNION ALL SELECT *, '2024-03-10' AS LoadDate FROM s2
""",
)
def q_silver_append(spark, sf):
    """Two loads appended, stamped; the second load repeated (replaces its own partition)."""
    path = scratch_path(spark, "q-silver")
    r1 = cust_raw(spark, sf)
    append_silver(add_load_date(cust_src(r1), DAY1), path)
    day2 = add_load_date(cust_src(cust_raw_day2(r1)), DAY2)
    append_silver(day2, path)
    append_silver(day2, path)
    return read_silver(spark, path, newest_only=False)


@query(
    "gold_sql_view",
    "WITH " + SQL_CUST_M2 + """
SELECT c_nationkey, count(*) AS n_current, CAST(sum(c_acctbal) AS DECIMAL(38,2)) AS acctbal
FROM m2_m WHERE updated_date = '999912312359' GROUP BY c_nationkey
""",
)
def q_gold_sql_view(spark, sf):
    """Analyst access: the gold dimension as a temp view, current rows aggregated in SQL."""
    cust_gold_day2(spark, sf).createOrReplaceTempView("gold_customer")
    return spark.sql(
        "SELECT c_nationkey, count(*) AS n_current, CAST(sum(c_acctbal) AS DECIMAL(38,2)) AS acctbal FROM gold_customer "
        f"WHERE updated_date = '{OPEN_END}' GROUP BY c_nationkey"
    )


# ------------------------------------------------------------------ P projections / predicates
@query(
    "key_rename",
    """
SELECT c_custkey AS KEY_c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal, c_mktsegment
FROM customer
""",
)
def q_key_rename(spark, sf):
    return rename_keys(cust_raw(spark, sf), ["c_custkey"])


@query(
    "key_rename_map",
    """
SELECT n_nationkey AS KEY_nation, n_name, n_regionkey AS KEY_region FROM nation
""",
)
def q_key_rename_map(spark, sf):
    return rename_keys(_t(spark, sf, "nation"), {"n_nationkey": "KEY_nation", "n_regionkey": "KEY_region"})


@query(
    "add_load_date",
    """
SELECT s_suppkey, s_name, s_nationkey, CAST(s_acctbal AS DECIMAL(18,2)) AS s_acctbal, '2024-03-10' AS LoadDate
FROM supplier
""",
)
def q_add_load_date(spark, sf):
    sup = _t(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey", _dec("s_acctbal"))
    return add_load_date(sup, "2024-03-10 13:05")


@query(
    "predicate_mix",
    """
SELECT o_orderkey,
       CASE WHEN o_orderstatus IS NULL THEN 'none'
            WHEN o_orderstatus = 'F' AND o_orderpriority != '1-URGENT' THEN 'done'
            WHEN o_totalprice < 50000 THEN 'small'
            WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_custkey IS NOT NULL THEN 'high'
            ELSE NULL END AS label
FROM orders
""",
)
def q_predicate_mix(spark, sf):
    o = _t(spark, sf, "orders")
    label = (
        F.when(F.col("o_orderstatus").isNull(), F.lit("none"))
        .when((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") != "1-URGENT"), F.lit("done"))
        .when(F.col("o_totalprice") < 50000, F.lit("small"))
        .when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & F.col("o_custkey").isNotNull(), F.lit("high"))
        .otherwise(F.lit(None))
    )
    return o.select("o_orderkey", label.alias("label"))


# ------------------------------------------------------------------ C1 hash, U accents, C6 geo
ORDER_HASH_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query(
    "hash_key",
    f"""
SELECT o_orderkey, {sql_hash(ORDER_HASH_COLS, COMPAT)} AS HASHCOLUMN
FROM (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
             o_orderdate, o_orderpriority FROM orders)
""",
)
def q_hash_key(spark, sf):
    o = _t(spark, sf, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))
    return hash_key(o, mode=COMPAT).select("o_orderkey", "HASHCOLUMN")


@query(
    "hash_key_ignore",
    f"""
SELECT c_custkey, {sql_hash(["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])} AS HASHCOLUMN
FROM (SELECT c_custkey, c_nationkey, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal, c_mktsegment FROM customer)
""",
)
def q_hash_key_ignore(spark, sf):
    return hash_key(cust_raw(spark, sf), ignore=["c_name"], mode=SAFE).select("c_custkey", "HASHCOLUMN")


@query("remove_accents", "SELECT doc_id, strip_accents(text) AS text FROM documents")
def q_remove_accents(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", remove_accents("text").alias("text"))


@query("remove_accents_exact", "SELECT doc_id, strip_accents(text) AS text FROM documents")
def q_remove_accents_exact(spark, sf):
    """The exact variant (Arrow-batched pandas UDF, NFD + drop Mn per string), whole texts."""
    return _t(spark, sf, "documents").select("doc_id", remove_accents("text", exact=True).alias("text"))


_HANGUL = ("\ud55c\uae00", "\u1112\u1161\u11ab\u1100\u1173\u11af")  # syllables, and the letters they decompose into


@query("remove_accents_sql", f"SELECT conv_id, turn, strip_accents(text) || '{_HANGUL[1]}' AS text FROM conversations")
def q_remove_accents_sql(spark, sf):
    register_sql_functions(spark)
    rows = _t(spark, sf, "conversations").withColumn("text", F.concat("text", F.lit(_HANGUL[0])))
    rows.createOrReplaceTempView("ll_conversations")
    return spark.sql("SELECT conv_id, turn, RemoveAccentsUDF(text) AS text FROM ll_conversations")


@query(
    "geo_normalise",
    """
SELECT DISTINCT lang AS KEY_geo_state, strip_accents(text) AS KEY_geo_city,
       source AS KEY_geo_source, '2024-03-10' AS LoadDate
FROM documents
""",
)
def q_geo_normalise(spark, sf):
    """Location-style cleanup over whole document texts: renamed keys, accent-stripped text key,
    load stamp, projection, distinct (exact copies of a document collapse)."""
    return geo_normalise(
        _t(spark, sf, "documents"),
        renames={"lang": "KEY_geo_state", "source": "KEY_geo_source"},
        accent_columns={"text": "KEY_geo_city"},
        run_date=DAY2,
    )


# ------------------------------------------------------------------ C3/C4 validation, A aggregates
@query(
    "validate_keys_ok",
    """
SELECT count(*) AS n_rows, count(DISTINCT (KEY_conv_id, KEY_turn)) AS n_keys,
       count(*) = count(DISTINCT (KEY_conv_id, KEY_turn)) AS valid, 'KEY_conv_id,KEY_turn' AS key_columns
FROM (SELECT DISTINCT conv_id AS KEY_conv_id, turn AS KEY_turn, role, text FROM conversations)
""",
)
def q_validate_keys_ok(spark, sf):
    conv = rename_keys(_t(spark, sf, "conversations"), ["conv_id", "turn"])
    return validate_keys_df(conv).withColumn("key_columns", F.array_join("key_columns", ","))


@query(
    "validate_keys_dup",
    """
SELECT count(*) AS n_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS n_keys,
       count(*) = count(DISTINCT (l_orderkey, l_linenumber)) AS valid, 'KEY_l_orderkey,KEY_l_linenumber' AS key_columns
FROM (SELECT DISTINCT * FROM lineitem)
""",
)
def q_validate_keys_dup(spark, sf):
    li = rename_keys(_t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])
    return validate_keys_df(li).withColumn("key_columns", F.array_join("key_columns", ","))


CONV_COLS = ["KEY_conv_id", "KEY_turn", "role", "text"]


@query(
    "prepare_silver",
    f"""
SELECT *, {sql_hash(CONV_COLS)} AS HASHCOLUMN
FROM (SELECT conv_id AS KEY_conv_id, turn AS KEY_turn, role, text, '2024-03-10' AS LoadDate FROM conversations)
""",
)
def q_prepare_silver(spark, sf):
    conv = add_load_date(rename_keys(_t(spark, sf, "conversations"), ["conv_id", "turn"]), DAY2)
    return prepare_silver(conv)


@query(
    "distinct_rows",
    f"SELECT DISTINCT * FROM ({SQL_LINES_TEXT})",
)
def q_distinct_rows(spark, sf):
    """Distinct whole rows of line items and a second copy of all of them."""
    lines = line_dec(spark, sf)
    return _lines_print(lines.unionByName(lines).distinct())


@query(
    "distinct_keys",
    f"""
SELECT * EXCLUDE (rn, l_shipdate), strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                                        l_returnflag, l_linestatus, l_shipdate) AS rn
  FROM (SELECT {LINE_COLS_DEC} FROM lineitem)) WHERE rn = 1
""",
)
def q_distinct_keys(spark, sf):
    first = first_per_key(line_dec(spark, sf), ["l_orderkey", "l_linenumber"])
    return _lines_print(first)


@query(
    "distinct_key_count",
    "SELECT count(DISTINCT (l_orderkey, l_linenumber)) AS n_keys FROM lineitem",
)
def q_distinct_key_count(spark, sf):
    return count_distinct_keys(_t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("row_count", "SELECT count(*) AS n_rows FROM lineitem")
def q_row_count(spark, sf):
    return _t(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "grouped_max_sk",
    "WITH " + SQL_CUST_M2 + "SELECT KEY_c_custkey, max(SK_customer) AS SK_customer FROM m2_m GROUP BY KEY_c_custkey",
)
def q_grouped_max_sk(spark, sf):
    return cust_gold_day2(spark, sf).groupBy("KEY_c_custkey").agg(F.max("SK_customer").alias("SK_customer"))


@query("next_sk_base", "WITH " + SQL_CUST_M2 + "SELECT coalesce(max(SK_customer), 0) AS next_sk_base FROM m2_m")
def q_next_sk_base(spark, sf):
    return cust_gold_day2(spark, sf).agg(F.coalesce(F.max("SK_customer"), F.lit(0)).alias("next_sk_base"))


# ------------------------------------------------------------------ W numbering
@query(
    "surrogate_key_initial",
    f"SELECT *, row_number() OVER (ORDER BY o_orderkey) AS SK_orders FROM ({SQL_ORDERS_TEXT})",
)
def q_surrogate_key_initial(spark, sf):
    return number_rows(_orders_print(_t(spark, sf, "orders")), ["o_orderkey"], "SK_orders")


@query(
    "surrogate_key_append",
    "WITH " + SQL_PART + """
SELECT KEY_p_partkey, (SELECT max(SK_part) FROM pg1) + row_number() OVER (ORDER BY KEY_p_partkey) AS SK_part
FROM ps2 WHERE KEY_p_partkey NOT IN (SELECT KEY_p_partkey FROM pg1)
""",
)
def q_surrogate_key_append(spark, sf):
    gold = scd1_create(part_src(part_raw(spark, sf)), sk="SK_part")
    new = part_src(part_raw_day2(part_raw(spark, sf))).join(gold.select("KEY_p_partkey"), "KEY_p_partkey", "left_anti")
    top = gold.agg(F.max("SK_part")).first()[0]
    return number_rows(new.select("KEY_p_partkey"), ["KEY_p_partkey"], "SK_part", offset=top)


# ------------------------------------------------------------------ C7-C11 dimensions
@query("scd1_create", "WITH " + SQL_PART + "SELECT * FROM pg1")
def q_scd1_create(spark, sf):
    return scd1_create(part_src(part_raw(spark, sf)), sk="SK_part")


def _sql_scd1(gold, src, key, sk, attrs):
    repl = ", ".join(
        f"CASE WHEN s.HASHCOLUMN IS NOT NULL AND s.HASHCOLUMN <> g.HASHCOLUMN THEN s.{c} ELSE g.{c} END AS {c}"
        for c in attrs + ["HASHCOLUMN"]
    )
    return f"""
SELECT g.* REPLACE ({repl}) FROM {gold} g LEFT JOIN {src} s ON g.{key} = s.{key}
UNION ALL BY NAME
SELECT s.*, (SELECT coalesce(max({sk}), 0) FROM {gold}) + row_number() OVER (ORDER BY s.{key}) AS {sk}
FROM {src} s WHERE s.{key} NOT IN (SELECT {key} FROM {gold})
"""


@query("scd1_merge", "WITH " + SQL_PART + _sql_scd1("pg1", "ps2", "KEY_p_partkey", "SK_part", PART_COLS[1:]))
def q_scd1_merge(spark, sf):
    r1 = part_raw(spark, sf)
    gold = scd1_create(part_src(r1), sk="SK_part")
    return scd1_merge(gold, part_src(part_raw_day2(r1)))


@query("scd2_create", "WITH " + SQL_CUST + "SELECT * FROM g1")
def q_scd2_create(spark, sf):
    return cust_gold_day1(spark, sf)


@query(
    "scd2_actions",
    "WITH " + SQL_CUST_M2 + f"""
SELECT KEY_c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, HASHCOLUMN, act AS Action,
       CASE WHEN act = 'new_insert' THEN '190001010000' WHEN act = 'exist_insert' THEN '{STAMP2}'
            WHEN act IN ('update', 'delete') THEN t_created END AS created_date,
       CASE WHEN act IN ('new_insert', 'exist_insert') THEN '999912312359'
            WHEN act IN ('update', 'delete') THEN '{STAMP2}' END AS updated_date
FROM m2_a
""",
)
def q_scd2_actions(spark, sf):
    r1 = cust_raw(spark, sf)
    return scd2_actions(cust_src(cust_raw_day2(r1)), cust_gold_day1(spark, sf), now=DAY2)


@query("scd2_merge", "WITH " + SQL_CUST_M2 + "SELECT * FROM m2_m")
def q_scd2_merge(spark, sf):
    return cust_gold_day2(spark, sf)


SQL_CUST_C2 = SQL_CUST + "," + sql_scd2("c2", "g1", "s2", "KEY_c_custkey", "SK_customer", CUST_DATA, STAMP2, CLOSE)


@query("scd2_merge_close", "WITH " + SQL_CUST_C2 + "SELECT * FROM c2_m")
def q_scd2_merge_close(spark, sf):
    return cust_gold_day2(spark, sf, mode=CLOSE)


@query(
    "scd2_close_missing",
    "WITH " + SQL_CUST + "," + sql_scd2("x2", "g1", "s2", "KEY_c_custkey", "SK_customer", CUST_DATA, STAMP2, close_missing=True)
    + "SELECT * FROM x2_m",
)
def q_scd2_close_missing(spark, sf):
    """Snapshot merge that also closes the open versions of customers absent from day 2 (nation 4)."""
    r1 = cust_raw(spark, sf)
    gold = scd2_create(cust_src(r1), sk="SK_customer")
    return scd2_merge(gold, cust_src(cust_raw_day2(r1)), now=DAY2, close_missing=True)


@query(
    "scd2_reopen",
    "WITH " + SQL_CUST_C2 + "," + sql_scd2("c3", "c2_m", "s3", "KEY_c_custkey", "SK_customer", CUST_DATA, STAMP3, CLOSE)
    + "SELECT * FROM c3_m",
)
def q_scd2_reopen(spark, sf):
    r1 = cust_raw(spark, sf)
    g2 = cust_gold_day2(spark, sf, mode=CLOSE)
    return scd2_merge(g2, cust_src(cust_raw_day3(r1)), now=DAY3, on_same_hash=CLOSE)


@query(
    "scd2_latest_version",
    "WITH " + SQL_CUST_C2 + """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY KEY_c_custkey ORDER BY SK_customer DESC) AS rn
                            FROM c2_m) WHERE rn = 1
""",
)
def q_scd2_latest_version(spark, sf):
    return scd2_latest(cust_gold_day2(spark, sf, mode=CLOSE))


@query(
    "scd2_latest_version_join",
    "WITH " + SQL_CUST_C2 + """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY KEY_c_custkey ORDER BY SK_customer DESC) AS rn
                            FROM c2_m) WHERE rn = 1
""",
)
def q_scd2_latest_version_join(spark, sf):
    return scd2_latest(cust_gold_day2(spark, sf, mode=CLOSE), method="join")


@query("scd2_current", "WITH " + SQL_CUST_M2 + "SELECT * FROM m2_m WHERE updated_date = '999912312359'")
def q_scd2_current(spark, sf):
    return scd2_current(cust_gold_day2(spark, sf))


@query(
    "scd2_as_of",
    "WITH " + SQL_CUST_M2 + "SELECT * FROM m2_m WHERE created_date <= '202403091200' AND '202403091200' < updated_date",
)
def q_scd2_as_of(spark, sf):
    return scd2_as_of(cust_gold_day2(spark, sf), "202403091200")


@query(
    "scd2_history",
    "WITH " + SQL_CUST_M2 + """
SELECT KEY_c_custkey, SK_customer, strftime(strptime(created_date, '%Y%m%d%H%M'), '%Y-%m-%d %H:%M') AS valid_from,
       strftime(strptime(updated_date, '%Y%m%d%H%M'), '%Y-%m-%d %H:%M') AS valid_to,
       updated_date = '999912312359' AS is_current
FROM m2_m
""",
)
def q_scd2_history(spark, sf):
    h = scd2_history(cust_gold_day2(spark, sf))
    return h.select(
        "KEY_c_custkey", "SK_customer",
        F.date_format("valid_from", "yyyy-MM-dd HH:mm").alias("valid_from"),
        F.date_format("valid_to", "yyyy-MM-dd HH:mm").alias("valid_to"),
        "is_current",
    )


# ------------------------------------------------------------------ N1/N3 facts and star reads
@query(
    "fact_sk_lookup",
    "WITH " + SQL_CUST_M2 + """
SELECT o.* EXCLUDE (o_custkey), coalesce(c.SK_customer, -1) AS SK_customer
FROM (""" + SQL_ORDERS_TEXT + """) o
LEFT JOIN (SELECT * FROM m2_m WHERE updated_date = '999912312359') c ON o.o_custkey = c.KEY_c_custkey
""",
)
def q_fact_sk_lookup(spark, sf):
    fact = _orders_print(_t(spark, sf, "orders"))
    return load_fact(fact, [DimLookup(cust_gold_day2(spark, sf), ["o_custkey"])])


def orders_at(spark, sf):
    """Whole orders with the stamp that their customer is looked up for."""
    done = F.date_format("o_orderdate", "yyyyMMddHHmm")
    at = F.when(F.col("o_orderstatus") == "F", done).otherwise(F.lit("202403101200"))
    return _orders_print(_t(spark, sf, "orders").withColumn("at_stamp", at), "at_stamp")


@query(
    "fact_asof_lookup",
    "WITH " + SQL_CUST_M2 + """,
sh AS (SELECT *, CASE WHEN o_orderstatus = 'F' THEN strftime(CAST(o_orderdate AS TIMESTAMP), '%Y%m%d%H%M')
                   ELSE '202403101200' END AS at_stamp FROM (""" + SQL_ORDERS_TEXT + """))
SELECT o.* EXCLUDE (o_custkey), coalesce(c.SK_customer, -1) AS SK_customer
FROM sh o LEFT JOIN m2_m c
  ON o.o_custkey = c.KEY_c_custkey AND c.created_date <= o.at_stamp AND o.at_stamp < c.updated_date
""",
)
def q_fact_asof_lookup(spark, sf):
    """Orders resolved against the version valid at their stamp: finished orders at their order date,
    the others at a time after the day-2 changes (so both sides of a change are exercised)."""
    return load_fact(orders_at(spark, sf), [DimLookup(cust_gold_day2(spark, sf), ["o_custkey"], as_of="at_stamp")])


@query(
    "star_join",
    "WITH " + SQL_CUST_M2 + """,
ng AS (SELECT n_nationkey AS KEY_n_nationkey, n_name, n_regionkey,
              row_number() OVER (ORDER BY n_nationkey) AS SK_nation FROM nation),
f AS (SELECT o.o_orderkey, CAST(o.o_totalprice AS DECIMAL(18,2)) AS o_totalprice, coalesce(c.SK_customer, -1) AS SK_customer
      FROM orders o LEFT JOIN (SELECT * FROM m2_m WHERE updated_date = '999912312359') c ON o.o_custkey = c.KEY_c_custkey)
SELECT coalesce(n.n_name, 'UNKNOWN') AS n_name, count(*) AS n_orders, CAST(sum(f.o_totalprice) AS DECIMAL(38,2)) AS revenue
FROM f LEFT JOIN (SELECT * FROM m2_m WHERE updated_date = '999912312359') c ON f.SK_customer = c.SK_customer
       LEFT JOIN ng n ON c.c_nationkey = n.KEY_n_nationkey
GROUP BY coalesce(n.n_name, 'UNKNOWN')
""",
)
def q_star_join(spark, sf):
    """Fact with surrogate keys joined back to the current customer and the nation dimension."""
    cust = cust_gold_day2(spark, sf)
    nation = scd1_create(rename_keys(_t(spark, sf, "nation"), ["n_nationkey"]), sk="SK_nation")
    fact = load_fact(
        _t(spark, sf, "orders").select("o_orderkey", "o_custkey", _dec("o_totalprice")), [DimLookup(cust, ["o_custkey"])]
    )
    cur = scd2_current(cust).select("SK_customer", "c_nationkey")
    star = fact.join(cur, "SK_customer", "left").join(
        nation.select(F.col("KEY_n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey", "left"
    )
    return star.groupBy(F.coalesce("n_name", F.lit("UNKNOWN")).alias("n_name")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").cast("decimal(38,2)").alias("revenue")
    )


# ------------------------------------------------------------------ C5 silver loaders, C12-C14 layer runs
def _bronze_layout(spark, sf, tables: dict[str, DataFrame], day) -> Layout:
    layout = Layout(scratch_path(spark, "q-lake"))
    for name, df in tables.items():
        write_snapshot(df, layout.bronze("tpch"), day, name)
    return layout


def _silver_query(spark, sf, name, df, spec):
    layout = _bronze_layout(spark, sf, {name: df}, DAY2)
    run_silver(spark, layout, [spec], DAY2)
    return read_silver(spark, layout.silver(spec.table_name))


def _sql_silver(select_sql, cols):
    return f"SELECT *, {sql_hash(cols)} AS HASHCOLUMN, '2024-03-10' AS LoadDate FROM ({select_sql})"


@query(
    "silver_customer",
    _sql_silver(
        "SELECT c_custkey AS KEY_c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal, c_mktsegment FROM customer",
        CUST_COLS,
    ),
)
def q_silver_customer(spark, sf):
    return _silver_query(spark, sf, "customer", cust_raw(spark, sf), SilverSpec("DIM2_customer", "tpch", "customer", ["c_custkey"]))


ORD_COLS = ["KEY_o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query(
    "silver_orders",
    _sql_silver(
        "SELECT o_orderkey AS KEY_o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, "
        "strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders",
        ORD_COLS,
    ),
)
def q_silver_orders(spark, sf):
    o = _t(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", _dec("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderpriority",
    )
    return _silver_query(spark, sf, "orders", o, SilverSpec("DIM2_orders", "tpch", "orders", ["o_orderkey"]))


LINE_KEYED = ["KEY_l_orderkey", "l_partkey", "l_suppkey", "KEY_l_linenumber", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query(
    "silver_lineitem",
    _sql_silver(
        f"""SELECT l_orderkey AS KEY_l_orderkey, l_partkey, l_suppkey, l_linenumber AS KEY_l_linenumber, l_quantity,
       l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate
FROM (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                                        l_returnflag, l_linestatus, l_shipdate) AS rn
  FROM (SELECT {LINE_COLS_DEC} FROM lineitem)) WHERE rn = 1)""",
        LINE_KEYED,
    ),
)
def q_silver_lineitem(spark, sf):
    """Line items have repeated (order, line) keys: all rows land in bronze, the loader keeps the first per key."""
    li = line_dec(spark, sf).withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))
    spec = SilverSpec("DIM2_lineitem", "tpch", "lineitem", ["l_orderkey", "l_linenumber"], first_per_key=True)
    return _silver_query(spark, sf, "lineitem", li, spec)


@query(
    "silver_part",
    _sql_silver(
        "SELECT p_partkey AS KEY_p_partkey, p_name, p_brand, p_type, p_size, CAST(p_retailprice AS DECIMAL(18,2)) AS p_retailprice FROM part",
        PART_COLS,
    ),
)
def q_silver_part(spark, sf):
    return _silver_query(spark, sf, "part", part_raw(spark, sf), SilverSpec("DIM2_part", "tpch", "part", ["p_partkey"]))


@query(
    "silver_supplier",
    _sql_silver(
        "SELECT s_suppkey AS KEY_s_suppkey, s_name, s_nationkey, CAST(s_acctbal AS DECIMAL(18,2)) AS s_acctbal FROM supplier",
        ["KEY_s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    ),
)
def q_silver_supplier(spark, sf):
    sup = _t(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey", _dec("s_acctbal"))
    return _silver_query(spark, sf, "supplier", sup, SilverSpec("DIM2_supplier", "tpch", "supplier", ["s_suppkey"]))


NATION_SPEC = SilverSpec(
    "DIM1_nation", "tpch", "nation",
    key_names={"n_nationkey": "KEY_n_nationkey"},
    accent_keys={"n_name": "KEY_n_name"},
    columns=["KEY_n_nationkey", "KEY_n_name", "r_name"],
    distinct=True,
)


@query(
    "silver_nation",
    _sql_silver(
        "SELECT DISTINCT n.n_nationkey AS KEY_n_nationkey, strip_accents(n.n_name) AS KEY_n_name, r.r_name "
        "FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey",
        ["KEY_n_nationkey", "KEY_n_name", "r_name"],
    ),
)
def q_silver_nation(spark, sf):
    """Location-style loader: nation with its region, accent-stripped name as a key, distinct."""
    nat = _t(spark, sf, "nation").join(_t(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return _silver_query(spark, sf, "nation", nat.select("n_nationkey", "n_name", "r_name"), NATION_SPEC)


# gold dispatch through the layer runner
@query("gold_load_first", "WITH " + SQL_CUST + "SELECT *, '2024-03-09' AS LoadDate FROM g1")
def q_gold_load_first(spark, sf):
    layout = _bronze_layout(spark, sf, {"customer": cust_raw(spark, sf)}, DAY1)
    spec = SilverSpec("DIM2_customer", "tpch", "customer", ["c_custkey"])
    run_silver(spark, layout, [spec], DAY1)
    load_gold(spark, layout, "DIM2_customer", DAY1)
    return read_table(spark, layout.gold("DIM2_customer"))


@query(
    "gold_load_second",
    "WITH " + SQL_CUST + """,
l1 AS (SELECT *, '2024-03-09' AS LoadDate FROM s1),
l2 AS (SELECT *, '2024-03-10' AS LoadDate FROM s2),
lg1 AS (SELECT *, '2024-03-09' AS LoadDate FROM g1),
""" + sql_scd2("x2", "lg1", "l2", "KEY_c_custkey", "SK_customer", CUST_DATA + ["LoadDate"], STAMP2).lstrip()
    + "SELECT * FROM x2_m",
)
def q_gold_load_second(spark, sf):
    r1 = cust_raw(spark, sf)
    layout = _bronze_layout(spark, sf, {"customer": r1}, DAY1)
    spec = SilverSpec("DIM2_customer", "tpch", "customer", ["c_custkey"])
    run_silver(spark, layout, [spec], DAY1)
    load_gold(spark, layout, "DIM2_customer", DAY1)
    write_snapshot(cust_raw_day2(r1), layout.bronze("tpch"), DAY2, "customer")
    run_silver(spark, layout, [spec], DAY2)
    load_gold(spark, layout, "DIM2_customer", DAY2)
    return read_table(spark, layout.gold("DIM2_customer"))


LAYER_TABLES = {
    "customer": ("DIM2_customer", ["c_custkey"]),
    "orders": ("DIM2_orders", ["o_orderkey"]),
    "part": ("DIM2_part", ["p_partkey"]),
    "supplier": ("DIM2_supplier", ["s_suppkey"]),
    "nation": ("DIM1_nation", ["n_nationkey"]),
}


def _landing(spark, sf, layout: Layout, day2: bool = False, only=None):
    """Landing CSV files derived from the tables (day 2: the customer changes of the module docstring)."""
    frames = {
        "customer": cust_raw_day2(cust_raw(spark, sf)) if day2 else cust_raw(spark, sf),
        "orders": _t(spark, sf, "orders").select(
            "o_orderkey", "o_custkey", "o_orderstatus", _dec("o_totalprice"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderpriority",
        ),
        "part": part_raw(spark, sf),
        "supplier": _t(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey", _dec("s_acctbal")),
        "nation": _t(spark, sf, "nation"),
    }
    if only is not None:
        frames = {k: v for k, v in frames.items() if k in only}
    def write(item):
        name, df = item
        df.write.mode("overwrite").option("header", True).csv(layout.landing("tpch", f"{name}.csv"))

    with ThreadPoolExecutor(max_workers=len(frames)) as pool:
        list(pool.map(write, frames.items()))


def _layer_config():
    bronze = [
        {"source_path": "tpch/", "source_name": f"{n}.csv", "target_path": "tpch/", "target_name": n} for n in LAYER_TABLES
    ]
    silver = [SilverSpec(t, "tpch", n, k) for n, (t, k) in LAYER_TABLES.items()]
    gold = [t for t, _ in LAYER_TABLES.values()]
    return bronze, silver, gold


SQL_COUNTS = """
SELECT 'customer' AS t, count(*) AS n FROM customer UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'part', count(*) FROM part UNION ALL SELECT 'supplier', count(*) FROM supplier
UNION ALL SELECT 'nation', count(*) FROM nation
"""


@query(
    "bronze_layer_run",
    f"SELECT t AS table_name, n AS rows_in, n AS rows_out, 'ok' AS status FROM ({SQL_COUNTS})",
)
def q_bronze_layer_run(spark, sf):
    layout = Layout(scratch_path(spark, "q-lake"))
    _landing(spark, sf, layout)
    bronze, _, _ = _layer_config()
    rows = run_bronze(spark, layout, bronze, DAY1)
    counts = {r["table_name"]: r["rows_out"] for r in rows}
    states = {r["table_name"]: r["status"] for r in rows}
    # the snapshot written is read back and counted per table
    frames = [
        read_latest_snapshot(spark, layout.bronze("tpch"), n).agg(F.count(F.lit(1)).alias("rows_out")).select(
            F.lit(n).alias("table_name"), F.lit(counts[n]).cast("bigint").alias("rows_in"), "rows_out", F.lit(states[n]).alias("status")
        )
        for n in LAYER_TABLES
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@query(
    "silver_layer_run",
    "WITH c AS (" + SQL_COUNTS + ") SELECT CASE t WHEN 'nation' THEN 'DIM1_nation' ELSE 'DIM2_' || t END AS table_name, "
    "n AS n_rows, n AS n_keys, 1 AS n_loads FROM c",
)
def q_silver_layer_run(spark, sf):
    layout = Layout(scratch_path(spark, "q-lake"))
    _landing(spark, sf, layout)
    bronze, silver, _ = _layer_config()
    run_bronze(spark, layout, bronze, DAY1)
    run_silver(spark, layout, silver, DAY1)
    frames = []
    for spec in silver:
        s = read_silver(spark, layout.silver(spec.table_name), newest_only=False)
        keys = [c for c in s.columns if c.startswith("KEY_")]
        frames.append(
            s.agg(
                F.count(F.lit(1)).alias("n_rows"),
                F.count_distinct(F.struct(*keys)).alias("n_keys"),
                F.count_distinct("LoadDate").alias("n_loads"),
            ).select(F.lit(spec.table_name).alias("table_name"), "n_rows", "n_keys", F.col("n_loads").cast("int"))
        )
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _plain(*cols, **more):
    return {**{c: c for c in cols}, **{c: f"{x} AS {c}" for c, x in more.items()}}


# key and other columns, as they land
_AS_TEXT = {
    "orders": ("o_orderkey", _plain("o_custkey", "o_orderstatus", "o_orderpriority", o_totalprice="CAST(o_totalprice AS DECIMAL(18,2))",
                                    o_orderdate="strftime(o_orderdate, '%Y-%m-%d')")),
    "part": ("p_partkey", _plain("p_name", "p_brand", "p_type", "p_size", p_retailprice="CAST(p_retailprice AS DECIMAL(18,2))")),
    "supplier": ("s_suppkey", _plain("s_name", "s_nationkey", s_acctbal="CAST(s_acctbal AS DECIMAL(18,2))")),
    "nation": ("n_nationkey", _plain("n_name", "n_regionkey")),
}
SQL_FULL_LOAD = (
    "WITH " + SQL_CUST + """,
t1 AS (SELECT CAST(KEY_c_custkey AS VARCHAR) AS k, HASHCOLUMN, '2024-03-09' AS LoadDate FROM s1),
t2 AS (SELECT CAST(KEY_c_custkey AS VARCHAR) AS k, HASHCOLUMN, '2024-03-10' AS LoadDate FROM s2),
tg AS (SELECT *, row_number() OVER (ORDER BY k) AS sk, '190001010000' AS created_date, '999912312359' AS updated_date FROM t1),"""
    + sql_scd2("f", "tg", "t2", "k", "sk", ["k", "HASHCOLUMN", "LoadDate"], STAMP2)
    + "SELECT 'DIM2_customer' AS table_name, k AS business_key, sk, created_date, updated_date, HASHCOLUMN, LoadDate FROM f_m"
    + "".join(
        f" UNION ALL SELECT '{LAYER_TABLES[t][0]}', CAST({k} AS VARCHAR), row_number() OVER (ORDER BY CAST({k} AS VARCHAR)), "
        + ("NULL, NULL, " if t == "nation" else "'190001010000', '999912312359', ")
        + sql_hash([f"KEY_{k}", *cols]) + f", '2024-03-09' FROM (SELECT {k}, {k} AS KEY_{k}, {', '.join(cols.values())} FROM {t})"
        for t, (k, cols) in _AS_TEXT.items()
    )
)


def full_load(spark, sf, base: str | None = None) -> DataFrame:
    """Two daily runs of all layers (day 2 lands the changed customers); the rows of all gold tables,
    each with the fingerprint of all its columns."""
    layout = Layout(base or scratch_path(spark, "q-lake"))
    bronze, silver, gold = _layer_config()
    _landing(spark, sf, layout)
    run_layers(spark, layout, bronze, silver, gold, DAY1)
    _landing(spark, sf, layout, day2=True)
    run_layers(spark, layout, bronze, silver, gold, DAY2)
    frames = []
    for t, (name, keys) in LAYER_TABLES.items():
        g = read_table(spark, layout.gold(name))
        dates = [F.col(c) if c in g.columns else F.lit(None).cast("string").alias(c) for c in (CREATED_COL, UPDATED_COL)]
        key, sk = F.col(f"KEY_{keys[0]}").alias("business_key"), F.col(f"SK_{t}").alias("sk")
        frames.append(g.select(F.lit(name).alias("table_name"), key, sk, *dates, "HASHCOLUMN", "LoadDate"))
    return functools.reduce(DataFrame.unionByName, frames)


@query("full_load", SQL_FULL_LOAD)
def q_full_load(spark, sf):
    return full_load(spark, sf)


@query(
    "fact_table_load",
    """
WITH c AS (SELECT CAST(c_custkey AS VARCHAR) AS k, row_number() OVER (ORDER BY CAST(c_custkey AS VARCHAR)) AS sk
           FROM customer)
SELECT CAST(o.o_orderkey AS VARCHAR) AS KEY_o_orderkey, o.o_orderstatus,
       CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS o_totalprice,
       strftime(o.o_orderdate, '%Y-%m-%d') AS o_orderdate, o.o_orderpriority,
       coalesce(c.sk, -1) AS SK_customer, LoadDate
FROM orders o LEFT JOIN c ON CAST(o.o_custkey AS VARCHAR) = c.k, (VALUES ('2024-03-09'), ('2024-03-10')) d(LoadDate)
""",
)
def q_fact_table_load(spark, sf):
    """Two daily runs with a fact step: orders land as facts whose customer key is replaced by the SK of
    the customer version valid at the order date (customers change on day 2)."""
    layout = Layout(scratch_path(spark, "q-lake"))
    bronze = [
        {"source_path": "tpch/", "source_name": f"{n}.csv", "target_path": "tpch/", "target_name": n}
        for n in ("customer", "orders")
    ]
    silver = [SilverSpec("DIM2_customer", "tpch", "customer", ["c_custkey"]),
              SilverSpec("FACT_orders", "tpch", "orders", ["o_orderkey"])]
    facts = [FactSpec("FACT_orders", "FACT_orders", ({"dim": "DIM2_customer", "keys": ["o_custkey"], "as_of": "o_orderdate"},))]
    for day, day2 in ((DAY1, False), (DAY2, True)):
        _landing(spark, sf, layout, day2=day2, only=("customer", "orders"))
        run_layers(spark, layout, bronze, silver, ["DIM2_customer"], day, fact_specs=facts)
    register_gold_views(spark, layout, ["DIM2_customer", "FACT_orders"])
    return spark.sql(
        "SELECT KEY_o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, SK_customer, "
        "CAST(LoadDate AS STRING) AS LoadDate FROM FACT_orders"
    )


@query(
    "run_audit",
    "WITH c AS (" + SQL_COUNTS + """)
SELECT '2024-03-09' AS run_date, 'bronze' AS layer, t AS table_name, 'ok' AS status, n AS rows_in, n AS rows_out,
       CAST(NULL AS BIGINT) AS inserted, CAST(NULL AS BIGINT) AS closed, CAST(NULL AS BIGINT) AS n_open FROM c
UNION ALL
SELECT '2024-03-09', 'silver', CASE t WHEN 'nation' THEN 'DIM1_nation' ELSE 'DIM2_' || t END, 'ok', n, n, NULL, NULL, NULL FROM c
UNION ALL
SELECT '2024-03-09', 'gold', CASE t WHEN 'nation' THEN 'DIM1_nation' ELSE 'DIM2_' || t END, 'created', NULL, n, n,
       CASE t WHEN 'nation' THEN NULL ELSE 0 END, CASE t WHEN 'nation' THEN NULL ELSE n END FROM c
""",
)
def q_run_audit(spark, sf):
    """Audit rows of one daily run (time columns left out: they differ per run)."""
    layout = Layout(scratch_path(spark, "q-lake"))
    _landing(spark, sf, layout)
    bronze, silver, gold = _layer_config()
    run_layers(spark, layout, bronze, silver, gold, DAY1)
    return spark.read.parquet(layout.audit()).drop("started", "finished", "message")


@query(
    "silver_region",
    _sql_silver("SELECT r_regionkey AS KEY_r_regionkey, r_name FROM region", ["KEY_r_regionkey", "r_name"]),
)
def q_silver_region(spark, sf):
    """Translation-style loader: a key and its text."""
    return _silver_query(spark, sf, "region", _t(spark, sf, "region"), SilverSpec("DIM1_region", "tpch", "region", ["r_regionkey"]))


LINE_SPEC = SilverSpec("DIM2_lineitem", "tpch", "lineitem", ["l_orderkey", "l_linenumber"], first_per_key=True)
_LINE_SK = "row_number() OVER (ORDER BY KEY_l_orderkey, KEY_l_linenumber)"
_LINE_GOLD = ", ".join(f"a.{c}" for c in LINE_KEYED if c != "l_linestatus")


@query(
    "gold_lineitem",
    "WITH l1 AS (" + ORACLES["silver_lineitem"].replace("2024-03-10", "2024-03-09") + "),\n"
    + f"""a AS (SELECT *, {_LINE_SK} AS SK_lineitem FROM l1),
c AS (SELECT * REPLACE ('S' AS l_linestatus) FROM a WHERE l_returnflag = 'R' AND l_linestatus <> 'S'),
h AS (SELECT KEY_l_orderkey, KEY_l_linenumber, {sql_hash(LINE_KEYED)} AS new_hash, {_LINE_SK} AS n FROM c)
SELECT a.*, '190001010000' AS created_date, CASE WHEN h.n IS NULL THEN '999912312359' ELSE '{STAMP2}' END AS updated_date
FROM a LEFT JOIN h USING (KEY_l_orderkey, KEY_l_linenumber)
UNION ALL BY NAME
SELECT {_LINE_GOLD}, 'S' AS l_linestatus, '2024-03-10' AS LoadDate, h.new_hash AS HASHCOLUMN,
  (SELECT count(*) FROM a) + h.n AS SK_lineitem, '{STAMP2}' AS created_date, '999912312359' AS updated_date
FROM a JOIN h USING (KEY_l_orderkey, KEY_l_linenumber)
""",
)
def q_gold_lineitem(spark, sf):
    """Order items as a type 2 dimension with a key of two columns; day 2 changes the returned ones."""
    lines = line_dec(spark, sf).withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))
    # the first row of a key stays the first, because only its status differs
    first = first_per_key(lines, ["l_orderkey", "l_linenumber"])
    status = F.when(F.col("l_returnflag") == "R", F.lit("S")).otherwise(F.col("l_linestatus"))
    layout = _bronze_layout(spark, sf, {"lineitem": lines}, DAY1)
    write_snapshot(first.withColumn("l_linestatus", status), layout.bronze("tpch"), DAY2, "lineitem")
    for day in (DAY1, DAY2):
        run_silver(spark, layout, [LINE_SPEC], day)
        load_gold(spark, layout, "DIM2_lineitem", day)
    return read_table(spark, layout.gold("DIM2_lineitem"))


# ------------------------------------------------------------------ loads that are empty, missed, repeated or change shape
CUST_SPEC = SilverSpec("DIM2_customer", "tpch", "customer", ["c_custkey"])
SQL_LOADS = SQL_CUST + """,
l1 AS (SELECT *, '2024-03-09' AS LoadDate FROM s1),
l2 AS (SELECT *, '2024-03-10' AS LoadDate FROM s2),
lg1 AS (SELECT *, '2024-03-09' AS LoadDate FROM g1),
"""
LOAD_DATA = CUST_DATA + ["LoadDate"]


def _silver_days(spark, frames: dict[str, DataFrame], gold_on=(), **options) -> Layout:
    """One silver load per day; the gold load runs on the days of ``gold_on`` (a day may repeat)."""
    layout = Layout(scratch_path(spark, "q-lake"))
    for day, df in frames.items():
        write_snapshot(df, layout.bronze("tpch"), day, "customer")
        run_silver(spark, layout, [CUST_SPEC], day)
        for _ in range(list(gold_on).count(day)):
            load_gold(spark, layout, "DIM2_customer", day, **options)
    return layout


@query("gold_load_empty", "WITH " + SQL_CUST + "SELECT *, '2024-03-09' AS LoadDate FROM g1")
def q_gold_load_empty(spark, sf):
    """An empty difference feed on day 2 leaves gold as it is (no open version is closed)."""
    r1 = cust_raw(spark, sf)
    days = {DAY1: r1, DAY2: r1.filter(F.lit(False))}
    return read_table(spark, _silver_days(spark, days, (DAY1, DAY2), on_same_hash=CLOSE).gold("DIM2_customer"))


@query(
    "gold_load_catch_up",
    "WITH " + SQL_LOADS + "l3 AS (SELECT *, '2024-03-11' AS LoadDate FROM s1),"
    + sql_scd2("x2", "lg1", "l2", "KEY_c_custkey", "SK_customer", LOAD_DATA, STAMP2) + ","
    + sql_scd2("x3", "x2_m", "l3", "KEY_c_custkey", "SK_customer", LOAD_DATA, STAMP3) + "SELECT * FROM x3_m",
)
def q_gold_load_catch_up(spark, sf):
    """Gold missed day 2: the run of day 3 merges both loads in order, each stamped with its own day."""
    r1 = cust_raw(spark, sf)
    layout = _silver_days(spark, {DAY1: r1, DAY2: cust_raw_day2(r1), DAY3: r1}, (DAY1, DAY3))
    return read_table(spark, layout.gold("DIM2_customer"))


@query(
    "gold_load_repeat_close",
    "WITH " + SQL_LOADS.rstrip().rstrip(",") + ","
    + sql_scd2("x2", "lg1", "l2", "KEY_c_custkey", "SK_customer", LOAD_DATA, STAMP2, mode=CLOSE) + "SELECT * FROM x2_m",
)
def q_gold_load_repeat_close(spark, sf):
    """A difference feed of day 2 merged, and the same run repeated: the repeat changes nothing."""
    r1 = cust_raw(spark, sf)
    layout = _silver_days(spark, {DAY1: r1, DAY2: cust_raw_day2(r1)}, (DAY1, DAY2, DAY2), on_same_hash=CLOSE)
    return read_table(spark, layout.gold("DIM2_customer"))


_PART_OLD = [c for c in PART_COLS if c != "p_retailprice"]


@query(
    "scd1_merge_new_column",
    "WITH " + SQL_PART + f""",
og AS (SELECT *, {sql_hash(_PART_OLD)} AS HASHCOLUMN FROM (SELECT {', '.join(_PART_OLD)}, SK_part FROM pg1))
SELECT * FROM (
SELECT g.KEY_p_partkey, {', '.join(f'CASE WHEN s.HASHCOLUMN IS NULL THEN g.{c} ELSE s.{c} END AS {c}' for c in _PART_OLD[1:])},
       s.p_retailprice, coalesce(s.HASHCOLUMN, g.HASHCOLUMN) AS HASHCOLUMN, g.SK_part
FROM og g LEFT JOIN ps2 s ON g.KEY_p_partkey = s.KEY_p_partkey
UNION ALL BY NAME
SELECT s.*, (SELECT max(SK_part) FROM og) + row_number() OVER (ORDER BY s.KEY_p_partkey) AS SK_part
FROM ps2 s WHERE s.KEY_p_partkey NOT IN (SELECT KEY_p_partkey FROM og))
""",
)
def q_scd1_merge_new_column(spark, sf):
    """Day 2 brings a column that gold lacks: it is added, NULL for the rows that day 2 does not hold."""
    r1 = part_raw(spark, sf)
    gold = scd1_create(part_src(r1.drop("p_retailprice")), sk="SK_part")
    return scd1_merge(gold, part_src(part_raw_day2(r1)))


_CUST_OLD = [c for c in CUST_COLS if c != "c_acctbal"]


@query(
    "scd2_merge_new_column",
    "WITH " + SQL_CUST + f""",
og AS (SELECT *, {sql_hash(_CUST_OLD)} AS HASHCOLUMN FROM (SELECT {', '.join(_CUST_OLD)}, SK_customer FROM g1)),
os AS (SELECT *, {sql_hash(_CUST_OLD)} AS old_hash FROM s2),
j AS (SELECT s.*, g.SK_customer, g.HASHCOLUMN AS g_hash FROM os s LEFT JOIN og g USING (KEY_c_custkey))
SELECT g.KEY_c_custkey, {', '.join('g.' + c for c in _CUST_OLD[1:])},
       CASE WHEN j.g_hash = j.old_hash THEN j.c_acctbal END AS c_acctbal,
       CASE WHEN j.g_hash = j.old_hash THEN j.HASHCOLUMN ELSE g.HASHCOLUMN END AS HASHCOLUMN, g.SK_customer,
       '190001010000' AS created_date,
       CASE WHEN j.g_hash <> j.old_hash THEN '{STAMP2}' ELSE '999912312359' END AS updated_date
FROM og g LEFT JOIN j ON j.SK_customer = g.SK_customer
UNION ALL BY NAME
SELECT {', '.join(CUST_COLS)}, HASHCOLUMN, (SELECT max(SK_customer) FROM og) + row_number() OVER (ORDER BY KEY_c_custkey) AS SK_customer,
       CASE WHEN g_hash IS NULL THEN '190001010000' ELSE '{STAMP2}' END AS created_date, '999912312359' AS updated_date
FROM j WHERE g_hash IS NULL OR g_hash <> old_hash
""",
)
def q_scd2_merge_new_column(spark, sf):
    """A new column alone makes no new version: unchanged rows take its values in their open version."""
    r1 = cust_raw(spark, sf)
    gold = scd2_create(cust_src(r1.drop("c_acctbal")), sk="SK_customer")
    return scd2_merge(gold, cust_src(cust_raw_day2(r1)), now=DAY2)


@query(
    "fact_two_roles",
    "WITH " + SQL_CUST_M2 + """,
cur AS (SELECT KEY_c_custkey, SK_customer FROM m2_m WHERE updated_date = '999912312359')
SELECT o.* EXCLUDE (o_custkey), coalesce(b.SK_customer, -1) AS SK_bill_to, coalesce(s.SK_customer, -1) AS SK_ship_to
FROM (""" + SQL_ORDERS_TEXT + """) o LEFT JOIN cur b ON b.KEY_c_custkey = o.o_custkey
LEFT JOIN cur s ON s.KEY_c_custkey = o.o_custkey // 2 + o.o_orderkey % 7
""",
)
def q_fact_two_roles(spark, sf):
    """Two lookups into one dimension, each under its own name."""
    ship_to = F.floor(F.col("o_custkey") / 2) + F.col("o_orderkey") % 7
    fact = _orders_print(_t(spark, sf, "orders").withColumn("ship_to", ship_to), "ship_to")
    cust = cust_gold_day2(spark, sf)
    return load_fact(
        fact, [DimLookup(cust, ["o_custkey"], name="SK_bill_to"), DimLookup(cust, ["ship_to"], name="SK_ship_to")]
    )


@query(
    "csv_ingest_multiline",
    """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name || chr(10) || 'said "x", twice' AS c_name,
       CAST(c_nationkey AS VARCHAR) AS c_nationkey, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS c_acctbal,
       c_mktsegment FROM customer
""",
)
def q_csv_ingest_multiline(spark, sf):
    """Quoted line breaks, quotes and separators survive: the config entry carries the file's CSV options."""
    layout = Layout(scratch_path(spark, "q-lake"))
    df = cust_raw(spark, sf).withColumn("c_name", F.concat("c_name", F.lit('\nsaid "x", twice')))
    df.write.option("header", True).option("escape", '"').csv(layout.landing("tpch", "customer.csv"))
    entry = {"source_path": "tpch/", "source_name": "customer.csv", "target_path": "tpch/", "target_name": "customer",
             "multi_line": True, "escape": '"', "on_malformed": "fail"}
    run_bronze(spark, layout, [entry], DAY1)
    return read_latest_snapshot(spark, layout.bronze("tpch"), "customer")


@query(
    "typed_copy_audit",
    "SELECT 'DIM2_customer' AS table_name, 'ok' AS status, count(*) AS rows_in, count(*) AS rows_out, "
    "count(*) FILTER (WHERE TRY_CAST(c_name AS INTEGER) IS NULL) || ' values did not convert' AS message FROM customer",
)
def q_typed_copy_audit(spark, sf):
    """Values that do not convert are counted in the run log."""
    layout = _bronze_layout(spark, sf, {"customer": cust_raw(spark, sf)}, DAY1)
    spec = SilverSpec("DIM2_customer", "tpch", "customer", ["c_custkey"], types={"c_name": "int"})
    rows = run_silver(spark, layout, [spec], DAY1)
    return audit_frame(spark, rows).select("table_name", "status", "rows_in", "rows_out", "message")


@query(
    "silver_append_twice",
    "WITH " + SQL_CUST + "SELECT *, '2024-03-09' AS LoadDate FROM s1 UNION ALL SELECT *, '2024-03-09' FROM s2",
)
def q_silver_append_twice(spark, sf):
    """Two appends of one day keep both sets of rows."""
    base, r1 = scratch_path(spark, "q-silver"), cust_raw(spark, sf)
    for raw in (r1, cust_raw_day2(r1)):
        append_rows(add_load_date(cust_src(raw), DAY1), f"{base}/DIM2_customer")
    return read_silver(spark, f"{base}/DIM2_customer")


@query(
    "run_audit_merge",
    "WITH " + SQL_CUST + """,
n AS (SELECT (SELECT count(*) FROM s2) AS s, (SELECT count(*) FROM g1) AS g,
  (SELECT count(*) FROM s1 JOIN s2 USING (KEY_c_custkey) WHERE s1.HASHCOLUMN <> s2.HASHCOLUMN) AS u,
  (SELECT count(*) FROM s2 WHERE KEY_c_custkey NOT IN (SELECT KEY_c_custkey FROM s1)) AS i)
SELECT '2024-03-10' AS run_date, 'bronze' AS layer, 'customer' AS table_name, 'ok' AS status, s AS rows_in, s AS rows_out,
  CAST(NULL AS BIGINT) AS inserted, CAST(NULL AS BIGINT) AS closed, CAST(NULL AS BIGINT) AS n_open FROM n
UNION ALL SELECT '2024-03-10', 'silver', 'DIM2_customer', 'ok', s, s, NULL, NULL, NULL FROM n
UNION ALL SELECT '2024-03-10', 'gold', 'DIM2_customer', 'merged', NULL, g + u + i, u + i, u, g + i FROM n
""",
)
def q_run_audit_merge(spark, sf):
    """The run log of the second day: rows, inserted, closed and open versions of a merge."""
    layout = Layout(scratch_path(spark, "q-lake"))
    bronze = [{"source_path": "tpch/", "source_name": "customer.csv", "target_path": "tpch/", "target_name": "customer"}]
    for day, day2 in ((DAY1, False), (DAY2, True)):
        _landing(spark, sf, layout, day2=day2, only=("customer",))
        run_layers(spark, layout, bronze, [CUST_SPEC], ["DIM2_customer"], day)
    log = spark.read.parquet(layout.audit()).filter(F.col("run_date") == DAY2)
    return log.drop("started", "finished", "message")


@query(
    "run_audit_failure",
    """
SELECT 'bronze' AS layer, 'orders' AS table_name, 'ok' AS status, count(*) AS rows_out, FALSE AS has_message FROM orders
UNION ALL SELECT 'silver', 'DIM2_orders', 'failed', NULL, TRUE
""",
)
def q_run_audit_failure(spark, sf):
    """A run that fails in silver (orders keyed by customer) leaves its run log: what succeeded and what failed."""
    layout = Layout(scratch_path(spark, "q-lake"))
    bronze = [{"source_path": "tpch/", "source_name": "orders.csv", "target_path": "tpch/", "target_name": "orders"}]
    _landing(spark, sf, layout, only=("orders",))
    try:
        run_layers(spark, layout, bronze, [SilverSpec("DIM2_orders", "tpch", "orders", ["o_custkey"])], ["DIM2_orders"], DAY1)
    except DuplicateKeyError:
        pass
    log = spark.read.parquet(layout.audit())
    return log.select("layer", "table_name", "status", "rows_out", F.col("message").isNotNull().alias("has_message"))


@query(
    "config_run",
    "WITH c AS (" + SQL_CUST_TEXT + """)
SELECT c_custkey AS KEY_c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
       row_number() OVER (ORDER BY c_custkey) AS SK_customer, '190001010000' AS created_date, '999912312359' AS updated_date,
       '2024-03-09' AS LoadDate FROM c
""",
)
def q_config_run(spark, sf):
    """A run driven by its three configuration files."""
    layout = Layout(scratch_path(spark, "q-lake"))
    _landing(spark, sf, layout, only=("customer",))
    configs = {
        "bronze": {"source_path": "tpch/", "source_name": "customer.csv", "target_path": "tpch/", "target_name": "customer"},
        "silver": {"table_name": "DIM2_customer", "source_path": "tpch", "source_name": "customer", "keys": ["c_custkey"]},
        "gold": {"table_name": "DIM2_customer"},
    }
    for name, record in configs.items():
        spark.createDataFrame([(json.dumps(record, indent=2),)], "value string").coalesce(1).write.text(layout.config(f"{name}.json"))
    run_from_config(spark, layout, DAY1)
    return read_table(spark, layout.gold("DIM2_customer")).drop("HASHCOLUMN")


__all__ = ["QUERIES", "ORACLES", "full_load"]
