"""Config reader, CSV landing, dated snapshots, silver appends, versioned tables."""

import json
import os

import pytest
from pyspark.sql import functions as F

from lakeload.sources.config import BRONZE_SCHEMA, GOLD_SCHEMA, read_config
from lakeload.sources.files import (
    append_silver,
    latest_snapshot_day,
    read_csv,
    read_latest_snapshot,
    read_silver,
    silver_loads,
    typed_copy,
    write_snapshot,
)
from lakeload.sources.store import read_table, table_exists, write_table


def test_concatenated_json_config(spark, tmp_base):
    path = os.path.join(tmp_base, "gold.json")
    with open(path, "wb") as f:
        f.write(b'{\r\n    "table_name":"DIM1_a"\r\n}\r\n{\r\n    "table_name":"DIM2_b"\r\n}')
    rows = [r["table_name"] for r in read_config(spark, path, GOLD_SCHEMA).collect()]
    assert rows == ["DIM1_a", "DIM2_b"]
    # a plain multi-line JSON read sees only the first object
    assert spark.read.option("multiLine", True).json(path).count() == 1


def test_bronze_config_of_several_objects(spark, tmp_base):
    path = os.path.join(tmp_base, "bronze.json")
    objs = [
        '{"source_path":"landing/x/","source_name":"a.csv","target_path":"bronze/x/","target_name":"a"}',
        '{"source_path":"landing/x/","source_name":"b.csv","target_path":"bronze/x/","target_name":"b"}',
    ]
    with open(path, "w") as f:
        f.write("\n".join(objs))
    assert [r["target_name"] for r in read_config(spark, path, BRONZE_SCHEMA).collect()] == ["a", "b"]


def test_csv_bom_crlf_quotes(spark, tmp_base):
    path = os.path.join(tmp_base, "t.csv")
    with open(path, "wb") as f:
        f.write(b'\xef\xbb\xbfk,v\r\na,b\r\n"c,1",d')
    df = read_csv(spark, path)
    assert df.columns == ["k", "v"]
    assert sorted(tuple(r) for r in df.collect()) == [("a", "b"), ("c,1", "d")]


def test_typed_copy_nulls_bad_values(spark):
    df = spark.createDataFrame([("1", "x"), ("y", "2")], "a string, b string")
    out = typed_copy(df, {"a": "int"})
    assert [r["a"] for r in out.orderBy("b").collect()] == [2, None] or [r["a"] for r in out.collect()] == [1, None]
    assert dict(out.dtypes) == {"a": "int", "b": "string"}


def test_latest_snapshot_is_max_day(spark, tmp_base):
    base = os.path.join(tmp_base, "bronze")
    write_snapshot(spark.createDataFrame([(2,)], "x int"), base, "2024-03-10", "t")
    write_snapshot(spark.createDataFrame([(1,)], "x int"), base, "2024-03-09", "t")
    os.makedirs(os.path.join(base, "zzz-not-a-day"))
    assert latest_snapshot_day(spark, base) == "2024-03-10"
    assert read_latest_snapshot(spark, base, "t").first()["x"] == 2


def test_silver_append_partitions_and_repeat(spark, tmp_base):
    path = os.path.join(tmp_base, "silver", "DIM2_t")
    d1 = spark.createDataFrame([(1, "a", "2024-03-09")], "KEY_k int, v string, LoadDate string")
    d2 = spark.createDataFrame([(1, "b", "2024-03-10"), (2, "c", "2024-03-10")], "KEY_k int, v string, LoadDate string")
    append_silver(d1, path)
    append_silver(d2, path)
    append_silver(d2, path)
    assert silver_loads(spark, path) == ["2024-03-09", "2024-03-10"]
    assert read_silver(spark, path, newest_only=False).count() == 3
    newest = read_silver(spark, path)
    assert sorted(r["v"] for r in newest.collect()) == ["b", "c"]
    assert dict(newest.dtypes)["LoadDate"] == "string"


def test_versioned_table(spark, tmp_base):
    path = os.path.join(tmp_base, "gold", "DIM1_t")
    assert not table_exists(spark, path)
    write_table(spark.createDataFrame([(1,)], "x int"), path)
    v1 = read_table(spark, path)
    write_table(v1.withColumn("x", F.col("x") + 1), path)  # reads the version it replaces
    assert table_exists(spark, path)
    assert read_table(spark, path).first()["x"] == 2


def test_prune_versions_keeps_newest(spark, tmp_base):
    from lakeload.sources.store import prune_versions

    path = os.path.join(tmp_base, "gold", "DIM1_p")
    for i in range(4):
        write_table(spark.createDataFrame([(i,)], "x int"), path)
    removed = prune_versions(spark, path, keep=2)
    assert [os.path.basename(p) for p in removed] == ["v=1", "v=2"]
    assert read_table(spark, path).first()["x"] == 3
    assert sorted(n for n in os.listdir(path)) == ["v=3", "v=4"]


def test_config_with_byte_order_mark(spark, tmp_base):
    path = os.path.join(tmp_base, "bom.json")
    with open(path, "wb") as f:
        f.write(b'\xef\xbb\xbf{"table_name":"DIM1_a"}\r\n{"table_name":"DIM2_b"}\r\n')
    assert [r["table_name"] for r in read_config(spark, path, GOLD_SCHEMA).collect()] == ["DIM1_a", "DIM2_b"]


@pytest.mark.parametrize("value", ["a } { b", '} {"x": 1}', 'quote " and \\ back} {slash', "x" * 50_000 + "}{" * 500])
def test_braces_inside_strings_cut_no_object(spark, tmp_base, value):
    one = {"source_path": value, "source_name": "{", "target_path": "}", "target_name": "t"}
    text = "﻿" + json.dumps(one, indent=4) + "\r\n\r\n" + json.dumps({**one, "target_name": "u"}) + "\n"
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{tmp_base}/config")
    got = [r.asDict() for r in read_config(spark, f"{tmp_base}/config", BRONZE_SCHEMA).collect()]
    assert got == [one, {**one, "target_name": "u"}]


@pytest.mark.parametrize("text", ['{"table_name": "a"} x', '{"table_name": "a"', '{"table_name": "a"}}', '[{"table_name": "a"}]'])
def test_text_that_is_no_object_fails(spark, tmp_base, text):
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{tmp_base}/config")
    with pytest.raises(Exception, match="no object"):
        read_config(spark, f"{tmp_base}/config", GOLD_SCHEMA).collect()
