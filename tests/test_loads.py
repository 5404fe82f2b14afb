"""Loads outside the ordinary path: empty, missed, repeated, back-dated, of another shape, failing."""

import os

import pytest
from pyspark.sql import functions as F

from lakeload.functions.dates import to_day, to_stamp
from lakeload.operators.facts import DimLookup, check_versions, load_fact
from lakeload.operators.numbering import number_rows
from lakeload.operators.prepare import hash_key
from lakeload.operators.scd2 import scd2_create, scd2_merge
from lakeload.operators.validate import DuplicateKeyError
from lakeload.plans.layout import Layout
from lakeload.plans.runs import FactSpec, SilverSpec, load_fact_table, load_gold, run_bronze, run_layers, run_silver
from lakeload.sources.files import append_rows, read_silver, silver_loads, write_snapshot
from lakeload.sources.store import last_load, read_table
from lakeload.streaming.gold_stream import gold_stream

SPEC = SilverSpec("DIM2_t", "src", "t", ["id"])
D = ["2024-03-09", "2024-03-10", "2024-03-11"]


def silver(spark, layout, day, rows, schema="id string, v string", spec=SPEC):
    write_snapshot(spark.createDataFrame(rows, schema), layout.bronze(spec.source_path), day, spec.source_name)
    return run_silver(spark, layout, [spec], day)


def versions(spark, layout):
    g = read_table(spark, layout.gold("DIM2_t"))
    return sorted(tuple(r) for r in g.select("KEY_id", "v", "created_date", "updated_date").collect())


OPEN, START = "999912312359", "190001010000"


def test_empty_load_closes_nothing(spark, tmp_base):
    layout = Layout(tmp_base)
    silver(spark, layout, D[0], [("a", "1"), ("b", "1")])
    load_gold(spark, layout, "DIM2_t", D[0], on_same_hash="close")
    assert silver(spark, layout, D[1], [])[0]["rows_out"] == 0
    got = load_gold(spark, layout, "DIM2_t", D[1], on_same_hash="close")
    assert got["status"] == "skipped" and versions(spark, layout) == [("a", "1", START, OPEN), ("b", "1", START, OPEN)]
    assert silver_loads(spark, layout.silver("DIM2_t")) == D[:2] and read_silver(spark, layout.silver("DIM2_t")).count() == 2


def test_empty_rerun_removes_the_days_rows(spark, tmp_base):
    layout = Layout(tmp_base)
    silver(spark, layout, D[0], [("a", "1")])
    silver(spark, layout, D[1], [("b", "1")])
    silver(spark, layout, D[1], [])
    assert [r.KEY_id for r in read_silver(spark, layout.silver("DIM2_t"), newest_only=False).collect()] == ["a"]
    silver(spark, layout, D[1], [("c", "1")])
    assert [r.KEY_id for r in read_silver(spark, layout.silver("DIM2_t")).collect()] == ["c"]


def test_missed_loads_are_merged_in_order_and_repeats_change_nothing(spark, tmp_base):
    layout = Layout(tmp_base)
    silver(spark, layout, D[0], [("a", "1")])
    load_gold(spark, layout, "DIM2_t", D[0])
    silver(spark, layout, D[1], [("a", "2"), ("c", "1")])
    silver(spark, layout, D[2], [("a", "3"), ("c", "1")])
    got = load_gold(spark, layout, "DIM2_t", D[2])
    want = [("a", "1", START, "202403100000"), ("a", "2", "202403100000", "202403110000"), ("a", "3", "202403110000", OPEN),
            ("c", "1", START, OPEN)]
    assert versions(spark, layout) == want and (got["inserted"], got["closed"]) == (3, 2)
    for mode in ("ignore", "close"):
        assert load_gold(spark, layout, "DIM2_t", D[2], on_same_hash=mode)["status"] == "skipped"
    assert versions(spark, layout) == want and last_load(spark, layout.gold("DIM2_t")) == D[2]
    with pytest.raises(ValueError, match="holds the load"):
        load_gold(spark, layout, "DIM2_t", D[1])


def test_a_run_takes_no_later_data(spark, tmp_base):
    layout = Layout(tmp_base)
    silver(spark, layout, D[2], [("a", "3")])
    silver(spark, layout, D[0], [("a", "1")])
    load_gold(spark, layout, "DIM2_t", D[0])
    assert versions(spark, layout) == [("a", "1", START, OPEN)]


def test_back_dated_merge_is_an_error(spark):
    src = lambda v: hash_key(spark.createDataFrame([("a", v)], "KEY_id string, v string"))
    gold = scd2_merge(scd2_create(src("1"), sk="SK_t"), src("2"), now="2024-03-11")
    with pytest.raises(Exception, match="before the start of a version"):
        scd2_merge(gold, src("3"), now="2024-03-05").collect()


def test_new_column_reaches_silver_and_gold(spark, tmp_base):
    layout = Layout(tmp_base)
    silver(spark, layout, D[0], [("a", "1"), ("b", "1"), ("x", "1")])
    load_gold(spark, layout, "DIM2_t", D[0])
    silver(spark, layout, D[1], [("a", "1", "n"), ("b", "2", None)], "id string, v string, w string")
    assert "w" in read_silver(spark, layout.silver("DIM2_t")).columns
    assert "w" in read_silver(spark, layout.silver("DIM2_t"), newest_only=False).columns
    load_gold(spark, layout, "DIM2_t", D[1])
    g = read_table(spark, layout.gold("DIM2_t")).select("KEY_id", "v", "w", "updated_date").collect()
    assert sorted(map(tuple, g), key=str) == [("a", "1", "n", OPEN), ("b", "1", None, "202403100000"), ("b", "2", None, OPEN),
                                              ("x", "1", None, OPEN)]
    silver(spark, layout, D[2], [("a", "1", "n"), ("b", "2", "m")], "id string, v string, w string")
    load_gold(spark, layout, "DIM2_t", D[2])
    g = read_table(spark, layout.gold("DIM2_t")).filter(F.col("updated_date") == OPEN).select("KEY_id", "w", "created_date").collect()
    assert sorted(map(tuple, g), key=str) == [("a", "n", START), ("b", "m", "202403110000"), ("x", None, START)]


def test_fact_roles_clash_and_overlap(spark):
    dim = spark.createDataFrame([("a", 1), ("b", 2)], "KEY_id string, SK_t long")
    fact = spark.createDataFrame([(1, "a", "b"), (2, "b", "z")], "n int, x string, y string")
    got = load_fact(fact, [DimLookup(dim, ["x"], name="SK_x"), DimLookup(dim, ["y"], name="SK_y")])
    assert sorted(map(tuple, got.collect())) == [(1, 1, 2), (2, 2, -1)] and got.columns == ["n", "SK_x", "SK_y"]
    with pytest.raises(ValueError, match="a name of its own"):
        load_fact(fact, [DimLookup(dim, ["x"]), DimLookup(dim, ["y"])])
    check_versions(dim)
    with pytest.raises(ValueError, match="overlapping"):
        check_versions(dim.union(dim))
    two = [("a", 1, START, "202403100000"), ("a", 2, "202403090000", OPEN)]
    with pytest.raises(ValueError, match="overlapping"):
        check_versions(spark.createDataFrame(two, "KEY_id string, SK_t long, created_date string, updated_date string"))


def test_fact_loads_catch_up_and_skip_empty_ones(spark, tmp_base):
    layout, spec = Layout(tmp_base), SilverSpec("FACT_f", "src", "f", ["n"])
    silver(spark, layout, D[0], [("a", "1")])
    load_gold(spark, layout, "DIM2_t", D[0])
    fact = FactSpec("FACT_f", "FACT_f", ({"dim": "DIM2_t", "keys": ["x"]},))
    silver(spark, layout, D[0], [(1, "a")], "n int, x string", spec)
    silver(spark, layout, D[1], [(2, "q")], "n int, x string", spec)
    got = load_fact_table(spark, layout, fact, D[1])
    assert (got["rows_out"], got["message"]) == (2, "1 keys without a dimension row")
    silver(spark, layout, D[2], [], "n int, x string", spec)
    assert load_fact_table(spark, layout, fact, D[2])["status"] == "skipped"
    rows = spark.read.parquet(layout.gold("FACT_f")).select("KEY_n", "SK_t", F.col("LoadDate").cast("string")).collect()
    assert sorted(map(tuple, rows)) == [(1, 1, D[0]), (2, -1, D[1])]


def landing(layout, name, text):
    os.makedirs(layout.landing("tpch"), exist_ok=True)
    with open(os.path.join(layout.landing("tpch"), name), "w") as f:
        f.write(text)
    return {"source_path": "tpch/", "source_name": name, "target_path": "src", "target_name": name[:-4]}


def test_csv_options_and_malformed_records(spark, tmp_base):
    layout = Layout(tmp_base)
    e = landing(layout, "t.csv", 'id,v\n1,"a\nb"\n2,x,EXTRA\n3\n4,y\n') | {"multi_line": True}
    assert [(r["rows_out"], r["message"]) for r in run_bronze(spark, layout, [e], D[0])] == [(4, "2 malformed records")]
    rows = spark.read.parquet(f"{layout.bronze('src')}/{D[0]}/t")
    assert ("1", "a\nb") in [tuple(r) for r in rows.collect()] and rows.columns == ["id", "v"]
    run_bronze(spark, layout, [e | {"on_malformed": "keep"}], D[1])
    kept = spark.read.parquet(f"{layout.bronze('src')}/{D[1]}/t")
    assert [r[2] for r in kept.orderBy("id").collect()] == [None, "2,x,EXTRA", "3", None]
    with pytest.raises(Exception, match="malformed record"):
        run_bronze(spark, layout, [e | {"on_malformed": "fail"}], D[2])


def test_appends_keep_rows(spark, tmp_base):
    df = spark.createDataFrame([("a", D[0])], "KEY_id string, LoadDate string")
    append_rows(df, f"{tmp_base}/t")
    append_rows(df, f"{tmp_base}/t")
    assert read_silver(spark, f"{tmp_base}/t").count() == 2


def test_log_of_a_failed_run(spark, tmp_base):
    layout = Layout(tmp_base)
    entries = [landing(layout, "t.csv", "id,v\n1,a\n1,b\n"), landing(layout, "u.csv", "id,v\n1,a\n")]
    specs = [SPEC, SilverSpec("DIM2_u", "src", "u", ["id"])]
    with pytest.raises(DuplicateKeyError):
        run_layers(spark, layout, entries, specs, ["DIM2_t", "DIM2_u"], D[0])
    log = spark.read.parquet(layout.audit()).select("layer", "table_name", "status").collect()
    assert sorted(map(tuple, log)) == [("bronze", "t", "ok"), ("bronze", "u", "ok"), ("silver", "DIM2_t", "failed"), ("silver", "DIM2_u", "ok")]


def test_rows_in_counts_rows_before_they_collapse(spark, tmp_base):
    layout, spec = Layout(tmp_base), SilverSpec("DIM2_t", "src", "t", ["id"], distinct=True, types={"v": "int"})
    got = silver(spark, layout, D[0], [("a", "1")] * 3 + [("b", "x"), ("c", None)], spec=spec)[0]
    assert (got["rows_in"], got["rows_out"], got["message"]) == (5, 3, "1 values did not convert")


def test_stream_merges_nothing_twice(spark, tmp_base):
    layout = Layout(tmp_base)
    silver(spark, layout, D[0], [("a", "1")])
    silver(spark, layout, D[1], [("a", "2")])
    for k in range(2):  # a new checkpoint sees every load again
        gold_stream(spark, layout, "DIM2_t", f"{tmp_base}/ck{k}").awaitTermination()
        assert versions(spark, layout) == [("a", "1", START, "202403100000"), ("a", "2", "202403100000", OPEN)]
    with pytest.raises(TypeError):
        gold_stream(spark, layout, "DIM2_t")


def test_default_run_date_and_overflow(spark):
    import datetime as dt

    today = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d")
    assert to_day(None) == today and to_stamp() == today.replace("-", "") + "0000"
    df = spark.createDataFrame([(1,), (2,)], "k int")
    assert number_rows(df, ["k"], "SK_t", offset=2**63 - 3).agg(F.max("SK_t")).first()[0] == 2**63 - 1
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            with pytest.raises(Exception, match="largest bigint"):
                number_rows(df, ["k"], "SK_t", offset=2**63 - 2).collect()
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")
