"""Physical-plan checks: filters reach the scan, projections are pruned, accents stay in codegen."""

import contextlib
import io
import os

from pyspark.sql import functions as F

from lakeload.functions.text import remove_accents
from lakeload.operators.prepare import hash_key
from lakeload.operators.scd2 import _latest_state, scd2_create, scd2_current
from lakeload.sources.files import append_silver, read_silver
from lakeload.sources.store import read_table, write_table


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_newest_silver_load_reads_its_own_folder_only(spark, tmp_base):
    path = os.path.join(tmp_base, "silver", "DIM2_t")
    for day in ("2024-03-09", "2024-03-10"):
        append_silver(spark.createDataFrame([(1, "a", day)], "KEY_k int, v string, LoadDate string"), path)
    df = read_silver(spark, path)
    assert [f.split("LoadDate=")[1][:10] for f in df.inputFiles()] == ["2024-03-10"]
    assert [tuple(r) for r in df.select("KEY_k", "v", "LoadDate").collect()] == [(1, "a", "2024-03-10")]


def test_current_view_pushes_filter_and_prunes(spark, tmp_base):
    gold = scd2_create(hash_key(spark.createDataFrame([("A", "x")], "KEY_id string, v string")), sk="SK_t")
    path = os.path.join(tmp_base, "gold", "DIM2_t")
    write_table(gold, path)
    plan = formatted(scd2_current(read_table(spark, path)).select("KEY_id", "SK_t"))
    assert "PushedFilters: [IsNotNull(updated_date), EqualTo(updated_date,999912312359)]" in plan
    assert "ReadSchema: struct<KEY_id:string,SK_t:bigint,updated_date:string>" in plan


def test_latest_state_reads_only_needed_columns(spark, tmp_base):
    df = spark.createDataFrame([("A", "x", "wide text")], "KEY_id string, v string, notes string")
    gold = scd2_create(hash_key(df), sk="SK_t")
    path = os.path.join(tmp_base, "gold", "DIM2_w")
    write_table(gold, path)
    plan = formatted(_latest_state(read_table(spark, path), ["KEY_id"], "SK_t"))
    read_schema = [ln for ln in plan.splitlines() if ln.startswith("ReadSchema")][0]
    assert "notes" not in read_schema and "v:" not in read_schema
    assert "partial_max" in plan


def test_hash_and_accents_stay_in_whole_stage_codegen(spark):
    df = spark.createDataFrame([("é", 1)], "s string, n int")
    plan = formatted(hash_key(df.select(remove_accents("s").alias("s"), "n")))
    assert "[codegen id" in plan and "EvalPython" not in plan and "PythonUDF" not in plan
