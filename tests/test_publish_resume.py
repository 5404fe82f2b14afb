"""Staged silver loads, resumed runs, SQL objects of the catalog, keys numbered inside the plan."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from lakeload.operators import _joins
from lakeload.operators.numbering import number_rows
from lakeload.operators.prepare import hash_key
from lakeload.operators.scd1 import scd1_create, scd1_merge
from lakeload.operators.scd2 import scd2_create, scd2_merge
from lakeload.operators.validate import DuplicateKeyError
from lakeload.plans import runs
from lakeload.plans.layout import Layout
from lakeload.plans.runs import SilverSpec, load_gold, register_gold_tables, run_layers, run_silver
from lakeload.sources.files import read_silver, silver_loads, write_snapshot

SPEC = SilverSpec("DIM2_t", "src", "t", ["id"])
SCHEMA = "id long, name string"


def land(spark, layout, day, rows):
    write_snapshot(spark.createDataFrame(rows, SCHEMA), layout.bronze("src"), day, "t")


def test_bronze_rows_are_computed_once(spark, tmp_base, monkeypatch):
    layout, seen = Layout(tmp_base), spark.sparkContext.accumulator(0)
    land(spark, layout, "2024-01-01", [(i, "n") for i in range(50)])

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    read = runs.read_latest_snapshot
    monkeypatch.setattr(runs, "read_latest_snapshot", lambda *a: (df := read(*a)).mapInArrow(count, df.schema))
    for k, spec in enumerate([SPEC, SilverSpec("DIM2_u", "src", "t", ["id"], distinct=True)], 1):
        run_silver(spark, layout, [spec], "2024-01-01")
        assert seen.value == 50 * k


def test_a_broken_load_is_dropped_and_the_one_before_stays(spark, tmp_base):
    layout, path = Layout(tmp_base), f"{tmp_base}/silver/DIM2_t"
    land(spark, layout, "2024-01-01", [(1, "a"), (2, "b")])
    run_silver(spark, layout, [SPEC], "2024-01-01")
    for day in ("2024-01-01", "2024-01-02"):
        land(spark, layout, day, [(1, "x"), (1, "y")])
        with pytest.raises(DuplicateKeyError):
            run_silver(spark, layout, [SPEC], day)
    assert silver_loads(spark, path) == ["2024-01-01"]
    assert sorted(r.name for r in read_silver(spark, path).collect()) == ["a", "b"]
    assert os.listdir(f"{tmp_base}/silver/_staging") == []
    land(spark, layout, "2024-01-02", [(1, "x"), (1, "x")])  # equal copies are no violation
    run_silver(spark, layout, [SPEC], "2024-01-02")
    land(spark, layout, "2024-01-02", [(3, "c")])  # a repeated day takes the place of the first
    run_silver(spark, layout, [SPEC], "2024-01-02")
    assert sorted(r.name for r in read_silver(spark, path, newest_only=False).collect()) == ["a", "b", "c"]


def test_a_resumed_run_repeats_only_what_is_missing(spark, tmp_base, monkeypatch):
    layout = Layout(tmp_base)
    spark.createDataFrame([(1, "a")], SCHEMA).write.option("header", True).csv(layout.landing("src", "t.csv"))
    entry = {"source_path": "src", "source_name": "t.csv", "target_path": "src", "target_name": "t"}
    args = (spark, layout, [entry], [SPEC], ["DIM2_t"], "2024-01-01")

    def stop(*a, **kw):
        raise RuntimeError("no gold today")

    with monkeypatch.context() as m:
        m.setattr(runs, "load_gold", stop)
        with pytest.raises(RuntimeError):
            run_layers(*args, resume=True)
    log = {(r.layer, r.status) for r in run_layers(*args, resume=True).collect()}
    assert log == {("bronze", "kept"), ("silver", "kept"), ("gold", "created")}
    assert {r.status for r in run_layers(*args, resume=True).collect()} == {"kept"}
    assert {r.status for r in run_layers(*args).collect()} == {"ok", "skipped"}  # without resume everything runs
    other = run_layers(spark, layout, [entry], [SPEC], [], "2024-01-02", resume=True)  # another day
    assert {r.status for r in other.collect()} == {"ok"}


def test_views_of_the_catalog_follow_the_loads(spark, tmp_base):
    layout, prefix = Layout(tmp_base), f"t_{uuid.uuid4().hex}_"
    seen = []
    for day, rows in (("2024-01-01", [(1, "a"), (2, "b")]), ("2024-01-02", [(1, "a"), (2, "c")]), ("2024-01-03", [(1, "d"), (2, "c")])):
        land(spark, layout, day, rows)
        run_silver(spark, layout, [SPEC], day)
        load_gold(spark, layout, "DIM2_t", day)
        assert register_gold_tables(spark, layout, ["DIM2_t"], prefix) == [f"{prefix}DIM2_t_current", f"{prefix}DIM2_t"]
        other = spark.newSession()
        now = sorted(r.name for r in other.sql(f"SELECT name FROM {prefix}DIM2_t_current").collect())
        seen.append((other.sql(f"SELECT count(*) FROM {prefix}DIM2_t").first()[0], now))
    assert seen == [(2, ["a", "b"]), (3, ["a", "c"]), (4, ["c", "d"])]
    read_silver(spark, layout.silver("DIM2_t"), newest_only=False).write.partitionBy("LoadDate").parquet(layout.gold("FACT_t"))
    register_gold_tables(spark, layout, ["FACT_t"], prefix)
    assert spark.newSession().sql(f"SELECT count(*) FROM {prefix}FACT_t WHERE LoadDate = '2024-01-02'").first()[0] == 2


def test_merges_number_after_a_scalar_of_the_plan(spark, monkeypatch):
    def no(*a):
        raise AssertionError("collected")

    monkeypatch.setattr(_joins, "max_value", no)
    src = lambda rows: hash_key(spark.createDataFrame(rows, "KEY_id long, name string"))
    one = scd1_merge(scd1_create(src([(1, "a"), (2, "b")]), sk="SK_t"), src([(3, "c"), (4, "d")]))
    assert sorted((r.KEY_id, r.SK_t) for r in one.collect()) == [(1, 1), (2, 2), (3, 3), (4, 4)]
    assert "Max" in one._jdf.queryExecution().optimizedPlan().toString() or "max(" in one._jdf.queryExecution().optimizedPlan().toString()
    two = scd2_merge(scd2_create(src([(1, "a"), (2, "b")]), sk="SK_t"), src([(2, "x"), (9, "n")]), now="2024-01-02")
    assert sorted((r.KEY_id, r.SK_t) for r in two.collect()) == [(1, 1), (2, 2), (2, 3), (9, 4)]


def test_an_offset_frame_numbers_like_an_integer(spark):
    df = spark.createDataFrame([(k,) for k in (5, 3, 9)], "k long")
    base = df.agg(F.max("k"))
    assert sorted(map(tuple, number_rows(df, ["k"], "n", offset=base).collect())) == [(3, 10), (5, 11), (9, 12)]
    top = spark.createDataFrame([(2**63 - 2,)], "m long")
    with pytest.raises(Exception, match="largest bigint"):
        number_rows(df, ["k"], "n", offset=top).collect()
