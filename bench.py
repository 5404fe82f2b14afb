"""Benchmark of the headline operators; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is run to completion with the ``noop`` sink (no collect), BENCH_RUNS times (default 2);
the fastest run is reported, in seconds, so JIT and class-loading warm-up is not charged to a query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from lakeload.functions.text import remove_accents  # noqa: E402
from lakeload.operators.numbering import number_rows  # noqa: E402
from lakeload.operators.prepare import hash_key, rename_keys  # noqa: E402
from lakeload.operators.scd2 import scd2_create, scd2_merge  # noqa: E402
from lakeload.operators.validate import validate_keys_df  # noqa: E402
from lakeload.plans import catalogue as cat  # noqa: E402
from lakeload.session import get_session  # noqa: E402


def global_row_number(df, order_by, name, offset=0):
    """The plain single-partition window (every row in one task): comparison baseline only."""
    w = Window.orderBy(*[F.col(c).asc_nulls_first() for c in order_by])
    return df.withColumn(name, (F.row_number().over(w) + F.lit(int(offset))).cast("bigint"))


def run(df):
    df.write.format("noop").mode("overwrite").save()


def orders_src(o):
    return hash_key(rename_keys(o, ["o_orderkey"]))


def orders_day2(o):
    """Changed status for urgent orders, cancelled low-priority orders gone, new orders for 'P' status."""
    kept = o.filter(F.col("o_orderpriority") != "5-LOW").withColumn(
        "o_orderstatus",
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat("o_orderstatus", F.lit("_X"))).otherwise(
            F.col("o_orderstatus")
        ),
    )
    new = o.filter(F.col("o_orderstatus") == "P").withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    return kept.unionByName(new)


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(f"local[{cpus}]", app="lakeload-bench", **{"spark.sql.shuffle.partitions": str(int(cpus) * 2)})
    spark.sparkContext.setLogLevel("ERROR")
    t = lambda name: spark.read.parquet(f"{sf}/{name}.parquet")

    def orders():
        return t("orders").select(
            "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderpriority",
        )

    queries = {
        "hash_key": lambda: run(hash_key(cat.line_dec(spark, sf))),
        "validate_keys_dup": lambda: validate_keys_df(
            rename_keys(t("lineitem"), ["l_orderkey", "l_linenumber"])
        ).collect(),
        "surrogate_key_initial": lambda: run(number_rows(t("orders"), ["o_orderkey"], "SK_orders")),
        "surrogate_key_global_window": lambda: run(global_row_number(t("orders"), ["o_orderkey"], "SK_orders")),
        "remove_accents": lambda: run(t("documents").select("doc_id", remove_accents("text").alias("text"))),
        "scd1_merge": lambda: run(cat.q_scd1_merge(spark, sf)),
        "scd2_merge": lambda: run(
            scd2_merge(scd2_create(orders_src(orders()), sk="SK_orders"), orders_src(orders_day2(orders())), now="2024-03-10")
        ),
        "fact_asof_lookup": lambda: run(cat.q_fact_asof_lookup(spark, sf)),
        "full_load": lambda: run(cat.full_load(spark, sf)),
    }
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    # warm-up: JVM class loading and the accent table build are not part of any query
    run(t("region"))
    remove_accents("x")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    timings = {}
    for name, fn in queries.items():
        if only and name not in only:
            continue
        best = float("inf")
        for _ in range(runs):
            t0 = time.perf_counter()
            fn()
            best = min(best, time.perf_counter() - t0)
        timings[name] = round(best, 3)
    headline = [q for q in timings if q != "surrogate_key_global_window"]
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(timings[q] for q in headline), 3),
                "unit": "sec",
                "queries": timings,
                "sf": sf.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
