"""Gold dispatch and the layer runs on small data."""

import os

import pytest
from pyspark.sql import functions as F

from lakeload.plans.layout import Layout
from lakeload.plans.roles import RoleError
from lakeload.plans.runs import SilverSpec, load_gold, run_bronze, run_from_config, run_silver
from lakeload.sources.files import append_silver
from lakeload.sources.store import read_table
from lakeload.operators.validate import DuplicateKeyError


def _landing(spark, layout, rows):
    df = spark.createDataFrame(rows, "id string, name string")
    df.write.mode("overwrite").option("header", True).csv(layout.landing("src", "t.csv"))


def test_missing_silver_is_skipped(spark, tmp_base):
    out = load_gold(spark, Layout(tmp_base), "DIM2_nothing", "2024-03-10")
    assert out["status"] == "skipped"


def test_unknown_prefix_raises(spark, tmp_base):
    layout = Layout(tmp_base)
    df = spark.createDataFrame([(1, "a", "2024-03-10")], "KEY_k int, v string, LoadDate string")
    append_silver(df, layout.silver("FACT_x"))
    with pytest.raises(RoleError):
        load_gold(spark, layout, "FACT_x", "2024-03-10")


def test_duplicate_keys_in_silver_fail_gold_create(spark, tmp_base):
    layout = Layout(tmp_base)
    df = spark.createDataFrame([(1, "a", "2024-03-10"), (1, "b", "2024-03-10")], "KEY_k int, v string, LoadDate string")
    append_silver(df, layout.silver("DIM2_x"))
    with pytest.raises(DuplicateKeyError):
        load_gold(spark, layout, "DIM2_x", "2024-03-10")


def test_three_days_end_to_end(spark, tmp_base):
    layout = Layout(tmp_base)
    bronze = [{"source_path": "src/", "source_name": "t.csv", "target_path": "src/", "target_name": "t"}]
    spec = SilverSpec("DIM2_t", "src", "t", ["id"])
    days = {
        "2024-03-09": [("1", "a"), ("2", "b")],
        "2024-03-10": [("1", "a"), ("2", "B"), ("3", "c")],
        "2024-03-11": [("1", "a"), ("2", "B"), ("3", "c")],
    }
    for day, rows in days.items():
        _landing(spark, layout, rows)
        run_bronze(spark, layout, bronze, day)
        run_silver(spark, layout, [spec], day)
        audit = load_gold(spark, layout, "DIM2_t", day)
        assert audit["status"] in ("created", "merged")
    gold = read_table(spark, layout.gold("DIM2_t"))
    got = sorted((r["KEY_id"], r["name"], r["SK_t"], r["created_date"], r["updated_date"]) for r in gold.collect())
    assert got == [
        ("1", "a", 1, "190001010000", "999912312359"),
        ("2", "B", 3, "202403100000", "999912312359"),
        ("2", "b", 2, "190001010000", "202403100000"),
        ("3", "c", 4, "190001010000", "999912312359"),
    ]
    # at most one open version per key, SKs unique
    assert gold.filter(F.col("updated_date") == "999912312359").groupBy("KEY_id").count().filter("count > 1").count() == 0
    assert gold.select("SK_t").distinct().count() == gold.count()


def test_run_from_config_files(spark, tmp_base):
    layout = Layout(tmp_base)
    _landing(spark, layout, [("1", "a"), ("2", "b")])
    os.makedirs(layout.config(), exist_ok=True)
    with open(layout.config("bronze.json"), "w") as f:
        f.write('{\r\n "source_path":"src/",\r\n "source_name":"t.csv",\r\n "target_path":"src/",\r\n "target_name":"t"\r\n}')
    with open(layout.config("silver.json"), "w") as f:
        f.write('{"table_name":"DIM1_t","source_path":"src","source_name":"t","keys":["id"]}')
    with open(layout.config("gold.json"), "w") as f:
        f.write('{"table_name":"DIM1_t"}\r\n{"table_name":"DIM2_absent"}')
    audit = run_from_config(spark, layout, "2024-03-09")
    rows = {(r["layer"], r["table_name"]): r["status"] for r in audit.collect()}
    assert rows == {("bronze", "t"): "ok", ("silver", "DIM1_t"): "ok", ("gold", "DIM1_t"): "created",
                    ("gold", "DIM2_absent"): "skipped"}
    assert read_table(spark, layout.gold("DIM1_t")).count() == 2


def test_empty_silver_is_skipped(spark, tmp_base):
    layout = Layout(tmp_base)
    empty = spark.createDataFrame([], "KEY_k int, v string, LoadDate string")
    append_silver(empty, layout.silver("DIM2_e"))
    assert load_gold(spark, layout, "DIM2_e", "2024-03-10")["status"] == "skipped"


def test_gold_load_leaves_no_scratch(spark, tmp_base):
    from lakeload.session import checkpoint_dir

    layout = Layout(tmp_base)
    from lakeload.operators.prepare import hash_key

    df = spark.createDataFrame([(1, "a", "2024-03-09"), (2, "b", "2024-03-09")], "KEY_k int, v string, LoadDate string")
    append_silver(hash_key(df, ignore=["LoadDate"]), layout.silver("DIM2_s"))
    scratch = checkpoint_dir(spark).replace("file:", "").rstrip("/") + "/lakeload"
    before = set(os.listdir(scratch)) if os.path.isdir(scratch) else set()
    assert load_gold(spark, layout, "DIM2_s", "2024-03-09")["status"] == "created"
    df2 = spark.createDataFrame([(1, "a", "2024-03-10"), (2, "c", "2024-03-10")], "KEY_k int, v string, LoadDate string")
    append_silver(hash_key(df2, ignore=["LoadDate"]), layout.silver("DIM2_s"))
    assert load_gold(spark, layout, "DIM2_s", "2024-03-10")["status"] == "merged"
    after = set(os.listdir(scratch)) if os.path.isdir(scratch) else set()
    assert after == before
    assert read_table(spark, layout.gold("DIM2_s")).count() == 3


def test_run_from_config_with_facts(spark, tmp_base):
    layout = Layout(tmp_base)
    spark.createDataFrame([("1", "a"), ("2", "b")], "id string, name string").write.option("header", True).csv(
        layout.landing("src", "dim.csv")
    )
    spark.createDataFrame([("10", "1"), ("11", "2"), ("12", "9")], "f string, id string").write.option("header", True).csv(
        layout.landing("src", "fact.csv")
    )
    os.makedirs(layout.config(), exist_ok=True)
    with open(layout.config("bronze.json"), "w") as f:
        f.write('{"source_path":"src/","source_name":"dim.csv","target_path":"src/","target_name":"dim"}\n'
                '{"source_path":"src/","source_name":"fact.csv","target_path":"src/","target_name":"fact"}')
    with open(layout.config("silver.json"), "w") as f:
        f.write('{"table_name":"DIM1_d","source_path":"src","source_name":"dim","keys":["id"]}\n'
                '{"table_name":"FACT_f","source_path":"src","source_name":"fact","keys":["f"]}')
    with open(layout.config("gold.json"), "w") as f:
        f.write('{"table_name":"DIM1_d"}')
    with open(layout.config("facts.json"), "w") as f:
        f.write('{"table_name":"FACT_f","silver_table":"FACT_f","lookups":[{"dim":"DIM1_d","keys":["id"]}]}')
    audit = run_from_config(spark, layout, "2024-03-09")
    assert {(r["layer"], r["table_name"], r["status"]) for r in audit.collect()} >= {("gold", "FACT_f", "loaded")}
    fact = spark.read.parquet(layout.gold("FACT_f"))
    assert sorted((r["KEY_f"], r["SK_d"]) for r in fact.collect()) == [("10", 1), ("11", 2), ("12", -1)]


def test_silver_spec_types_from_record(spark, tmp_base):
    from lakeload.plans.runs import silver_frame
    from lakeload.sources.files import write_snapshot

    layout = Layout(tmp_base)
    raw = spark.createDataFrame([("1", "São", "12.50"), ("2", "x", "bad")], "id string, city string, amount string")
    write_snapshot(raw, layout.bronze("src"), "2024-03-09", "t")
    spec = SilverSpec.from_record(
        {"table_name": "DIM1_t", "source_path": "src", "source_name": "t", "keys": None,
         "key_names": {"id": "KEY_id"}, "accent_keys": {"city": "KEY_city"},
         "columns": ["KEY_id", "KEY_city", "amount"], "distinct": True, "dedupe": False,
         "types": {"id": "int", "amount": "decimal(10,2)"}}
    )
    out = silver_frame(spark, layout, spec, "2024-03-09")
    assert dict(out.dtypes) == {"KEY_id": "int", "KEY_city": "string", "amount": "decimal(10,2)",
                                "LoadDate": "string", "HASHCOLUMN": "string"}
    rows = sorted((r["KEY_id"], r["KEY_city"], r["amount"]) for r in out.collect())
    assert [(r[0], r[1]) for r in rows] == [(1, "Sao"), (2, "x")] and rows[1][2] is None


def test_unpartitioned_silver_is_loaded(spark, tmp_base):
    from lakeload.operators.prepare import hash_key

    layout = Layout(tmp_base)
    df = hash_key(spark.createDataFrame([(1, "a"), (2, "b")], "KEY_k int, v string"))
    df.write.parquet(layout.silver("DIM1_u"))
    assert load_gold(spark, layout, "DIM1_u", "2024-03-10")["status"] == "created"
    assert read_table(spark, layout.gold("DIM1_u")).count() == 2


def test_run_from_config_with_notebook_style_silver(spark, tmp_base):
    layout = Layout(tmp_base)
    _landing(spark, layout, [("1", "a"), ("2", "b")])
    os.makedirs(layout.config(), exist_ok=True)
    with open(layout.config("bronze.json"), "w") as f:
        f.write('{\r\n "source_path":"src/",\r\n "source_name":"t.csv",\r\n "target_path":"src/",\r\n "target_name":"t"\r\n}')
    with open(layout.config("silver.json"), "w") as f:
        f.write('{\r\n    "notebook_path":"src/",\r\n    "table_name":"t"\r\n}')
    with open(layout.config("gold.json"), "w") as f:
        f.write('{"table_name":"DIM2_t"}')
    registry = {"t": SilverSpec("DIM2_t", "src", "t", ["id"])}
    audit = run_from_config(spark, layout, "2024-03-09", silver_registry=registry)
    assert ("gold", "DIM2_t", "created") in {(r["layer"], r["table_name"], r["status"]) for r in audit.collect()}
    with pytest.raises(KeyError):
        run_from_config(spark, layout, "2024-03-10")
