"""Scalar functions: fingerprints, accents, run dates (FIXTURES.md section 4, worked by hand)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeload.functions.dates import to_day, to_stamp
from lakeload.functions.text import register_sql_functions, remove_accents, strip_marks
from lakeload.operators.prepare import hash_key

SHA_ABC = "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"
ROWS = [("ab", "c"), ("a", "bc"), (None, "abc"), ("", "abc")]


def test_hash_compat_collides_like_reference(spark):
    df = spark.createDataFrame(ROWS, "a string, b string")
    hashes = {r[0] for r in hash_key(df, mode="compat").select("HASHCOLUMN").collect()}
    assert hashes == {SHA_ABC}


def test_hash_safe_separates(spark):
    df = spark.createDataFrame(ROWS, "a string, b string")
    assert hash_key(df, mode="safe").select("HASHCOLUMN").distinct().count() == 4


def test_hash_safe_ignores_column_order_and_ignore_list(spark):
    df = spark.createDataFrame([(1, "x", "2024-01-01")], "k int, v string, LoadDate string")
    h1 = hash_key(df, ignore=["LoadDate"]).first()["HASHCOLUMN"]
    h2 = hash_key(df.select("v", "k", "LoadDate"), ignore=["LoadDate"]).first()["HASHCOLUMN"]
    h3 = hash_key(df.withColumn("LoadDate", F.lit("2025-01-01")), ignore=["LoadDate"]).first()["HASHCOLUMN"]
    assert h1 == h2 == h3


def test_hash_refuses_maps(spark):
    df = spark.createDataFrame([({"a": 1},)], "m map<string,int>")
    with pytest.raises(TypeError):
        hash_key(df)


def test_accents(spark):
    df = spark.createDataFrame([("São Paulo",), ("é",), ("Ø ß ł",), (None,), ("한",)], "s string")
    got = [r[0] for r in df.select(remove_accents("s")).collect()]
    assert got == ["Sao Paulo", "e", "Ø ß ł", None, "한"]
    exact = [r[0] for r in df.select(remove_accents("s", exact=True)).collect()]
    assert exact[:4] == ["Sao Paulo", "e", "Ø ß ł", None]
    assert exact[4] == strip_marks("한") and len(exact[4]) == 3


def test_accents_sql_function(spark):
    register_sql_functions(spark)
    assert spark.sql("SELECT RemoveAccentsUDF('Crème brûlée') AS x").first()["x"] == "Creme brulee"
    assert spark.sql("SELECT RemoveAccentsExactUDF('Ångström') AS x").first()["x"] == "Angstrom"


def test_accent_default_path_stays_in_jvm(spark):
    df = spark.createDataFrame([("é",)], "s string").select(remove_accents("s"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_run_dates():
    assert to_stamp("2024-03-10") == "202403100000"
    assert to_stamp("2024-03-10 13:05:00") == "202403101305"
    assert to_stamp("202403101305") == "202403101305"
    assert to_stamp(dt.datetime(2024, 3, 10, 0, 5)) == "202403100005"
    assert to_stamp(dt.date(2024, 3, 10)) == "202403100000"
    assert to_day("202403101305") == "2024-03-10"
    with pytest.raises(ValueError):
        to_stamp("10/03/2024")
