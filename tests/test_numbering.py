"""Distributed numbering equals the global window; plans stay off a single partition."""

import contextlib
import io
import os

import pytest
from pyspark.sql import functions as F

from pyspark.sql import Window

from lakeload.operators._joins import translate_errors, unique_rows
from lakeload.operators.numbering import number_rows
from lakeload.operators.validate import DuplicateKeyError
from lakeload.sources.files import append_silver
from lakeload.sources.store import current_version_path, write_table

SF01 = "/root/testdata/sf0.01"

def global_row_number(df, order_by, name, offset=0):
    """The plain single-partition window (every row in one task): comparison baseline only."""
    w = Window.orderBy(*[F.col(c).asc_nulls_first() for c in order_by])
    return df.withColumn(name, (F.row_number().over(w) + F.lit(int(offset))).cast("bigint"))



def test_equals_global_row_number(spark):
    o = spark.read.parquet(f"{SF01}/orders.parquet").select("o_orderkey", "o_custkey")
    a = number_rows(o, ["o_custkey", "o_orderkey"], "sk", offset=10)
    b = global_row_number(o, ["o_custkey", "o_orderkey"], "sk2", offset=10)
    j = a.join(b, ["o_orderkey", "o_custkey"])
    assert j.count() == o.count()
    assert j.filter("sk != sk2").count() == 0


def test_hot_group_of_copies_is_split(spark):
    hot = spark.range(30000).select(F.lit(7).alias("k"), F.lit("same").alias("v"))
    cold = spark.range(100).select((F.col("id") + 100).alias("k"), F.lit("other").alias("v"))
    out = number_rows(hot.unionByName(cold), ["k"], "sk", num_partitions=8)
    stats = out.agg(F.min("sk"), F.max("sk"), F.count_distinct("sk")).first()
    assert tuple(stats) == (1, 30100, 30100)
    # the 30,000 equal keys are spread over several range partitions (tie-break columns)
    per_part = out.filter("k = 7").groupBy(F.spark_partition_id()).count().count()
    assert per_part > 1
    # and every cold key is numbered after the hot group
    assert out.filter("k >= 100").agg(F.min("sk")).first()[0] == 30001


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_no_single_partition_exchange_over_rows(spark):
    o = spark.read.parquet(f"{SF01}/orders.parquet")
    plan = formatted(number_rows(o, ["o_orderkey"], "sk"))
    blocks = [b for b in plan.split("\n\n") if ") Exchange" in b and "SinglePartition" in b]
    assert blocks, "expected the offsets window over the per-partition counts"
    for b in blocks:
        # only the (partition id, row count) pairs ever meet in one partition
        assert "Input [2]" in b and "_ll_cnt" in b
    assert "BroadcastExchange" in plan


def test_unique_keys_path_equals_global_row_number(spark):
    o = spark.read.parquet(f"{SF01}/orders.parquet").select("o_orderkey", "o_custkey")
    a = number_rows(o, ["o_orderkey"], "sk", unique=True)
    b = global_row_number(o, ["o_orderkey"], "sk2")
    assert a.join(b, ["o_orderkey", "o_custkey"]).filter("sk != sk2").count() == 0
    plan = formatted(a)
    assert "_ll_tie" not in plan and "_ll_seq" not in plan


def test_creation_moves_rows_once_and_keeps_the_checks(spark):
    """The ranges that the numbering needs serve the key check too; copies collapse, different rows of a key fail."""
    rows = [(None if k == 0 else k % 37, f"v{k % 37}" if k else "v") for k in range(37 * 4)]
    df = spark.createDataFrame(rows, "KEY_k int, v string").filter("KEY_k is not null")
    unique = unique_rows(df, ["KEY_k"], allow_null_keys=False, by_range=True)
    plan = unique.sortWithinPartitions("KEY_k")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Exchange rangepartitioning(KEY_k" in plan
    got = {(r.KEY_k, r.v, r.sk) for r in number_rows(unique, ["KEY_k"], "sk", unique=True, by_range=True).collect()}
    assert got == {(k, f"v{k}", k + 1) for k in range(37)}
    for bad, name in (((3, "other"), "different rows"), ((None, "v"), "NULL value")):
        more = df.unionByName(spark.createDataFrame([bad], df.schema))
        with pytest.raises(DuplicateKeyError, match=name):
            translate_errors(unique_rows(more, ["KEY_k"], allow_null_keys=False, by_range=True).collect)


def test_tables_and_scratch_frames_halve_their_hashes(spark, tmp_base):
    df = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("HASHCOLUMN"), F.lit("2024-03-09").alias("LoadDate"))
    write_table(df, f"{tmp_base}/t")
    append_silver(df, f"{tmp_base}/s")
    for path in (current_version_path(spark, f"{tmp_base}/t"), f"{tmp_base}/s"):
        size = sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))
        assert size < 45 * 20_000
        assert spark.read.parquet(path).count() == 20_000
