"""A type 2 table appends its closed versions once; merges rewrite and read open versions only."""

import os

import pytest
from pyspark.sql import functions as F

from lakeload.operators.prepare import hash_key
from lakeload.operators.scd2 import scd2_change
from lakeload.plans.layout import Layout
from lakeload.plans.runs import merge_into_gold
from lakeload.sources.store import (
    last_load,
    prune_versions,
    read_closed,
    read_own_rows,
    read_table,
    write_table,
)

COLS = ("KEY_id", "v", "SK_t", "created_date", "updated_date")
OPEN, START = "999912312359", "190001010000"


def merge(spark, layout, day, rows, schema="KEY_id string, v string", **options):
    df = spark.createDataFrame([(*r, day) for r in rows], schema + ", LoadDate string")
    return merge_into_gold(spark, layout, "DIM2_t", hash_key(df, ignore=["LoadDate"]), day, load=day, **options)


def rows(df, cols=COLS):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs}


def counts(audit):
    return tuple(audit[k] for k in ("rows_out", "inserted", "closed", "n_open"))


def test_closed_rows_are_written_once(spark, tmp_base):
    layout, path = Layout(tmp_base), Layout(tmp_base).gold("DIM2_t")
    assert counts(merge(spark, layout, "2024-03-01", [("a", "1"), ("b", "1")])) == (2, 2, 0, 2)
    assert counts(merge(spark, layout, "2024-03-02", [("a", "2"), ("b", "1")])) == (3, 1, 1, 2)
    before = files(f"{path}/closed")
    assert counts(merge(spark, layout, "2024-03-03", [("a", "3"), ("c", "1")])) == (5, 2, 1, 3)
    after = files(f"{path}/closed")
    assert {k: after[k] for k in before} == before
    assert counts(merge(spark, layout, "2024-03-04", [("a", "3"), ("c", "1")])) == (5, 0, 0, 3)
    assert files(f"{path}/closed") == after  # nothing closed, nothing written
    assert rows(read_own_rows(spark, path).select("KEY_id", "updated_date"), ("KEY_id", "updated_date")) == [
        ("a", OPEN), ("b", OPEN), ("c", OPEN)
    ]
    assert rows(read_table(spark, path)) == [
        ("a", "1", 1, START, "202403020000"), ("a", "2", 3, "202403020000", "202403030000"),
        ("a", "3", 4, "202403030000", OPEN), ("b", "1", 2, START, OPEN), ("c", "1", 5, START, OPEN),
    ]
    assert last_load(spark, path) == "2024-03-04"


def test_returning_key_is_found_in_closed_history(spark, tmp_base):
    layout, path = Layout(tmp_base), Layout(tmp_base).gold("DIM2_t")
    merge(spark, layout, "2024-03-01", [("a", "1"), ("b", "1")])
    merge(spark, layout, "2024-03-02", [("a", "1")], close_missing=True)
    merge(spark, layout, "2024-03-03", [("a", "1")])
    merge(spark, layout, "2024-03-04", [("a", "1"), ("b", "2"), ("n", "1")])
    assert rows(read_table(spark, path)) == [
        ("a", "1", 1, START, OPEN), ("b", "1", 2, START, "202403020000"), ("b", "2", 3, "202403040000", OPEN),
        ("n", "1", 4, START, OPEN),
    ]


def test_merge_of_known_keys_reads_no_closed_row(spark, tmp_base):
    """Removing the closed files does not disturb a merge whose keys all have open versions; only their keys are planned."""
    layout, path = Layout(tmp_base), Layout(tmp_base).gold("DIM2_t")
    for day, v in (("2024-03-01", "1"), ("2024-03-02", "2")):
        merge(spark, layout, day, [("a", v), ("b", v)])
    closed = read_closed(spark, path)
    src = hash_key(spark.createDataFrame([("a", "3"), ("b", "2")], "KEY_id string, v string")).withColumn("LoadDate", F.lit("x"))
    change = scd2_change(read_own_rows(spark, path), src, closed, now="2024-03-03", max_sk=4)
    plan = change.open_rows()._jdf.queryExecution().executedPlan().toString()
    scans = [ln for ln in plan.splitlines() if "FileScan" in ln and "/closed/" in ln]
    assert scans and all("ReadSchema: struct<KEY_id:string>" in ln for ln in scans)
    plan = change.ended()._jdf.queryExecution().executedPlan().toString()
    assert "/closed/" not in plan
    for f in files(f"{path}/closed"):
        os.remove(f) if "part-" in f else None
    merge(spark, layout, "2024-03-03", [("a", "3"), ("b", "2")])
    assert rows(read_own_rows(spark, path)) == [("a", "3", 5, "202403030000", OPEN), ("b", "2", 4, "202403020000", OPEN)]


def test_new_column_and_changed_type(spark, tmp_base):
    layout, path = Layout(tmp_base), Layout(tmp_base).gold("DIM2_t")
    merge(spark, layout, "2024-03-01", [("a", 1)], "KEY_id string, v int")
    merge(spark, layout, "2024-03-02", [("a", 2)], "KEY_id string, v int")
    merge(spark, layout, "2024-03-03", [("a", 3, "w")], "KEY_id string, v int, w string")
    assert rows(read_table(spark, path), ("SK_t", "v", "w")) == [(1, 1, None), (2, 2, None), (3, 3, "w")]
    got = merge(spark, layout, "2024-03-04", [("a", 1 << 40, "w")], "KEY_id string, v bigint, w string")
    assert counts(got) == (4, 1, 1, 1) and read_closed(spark, path) is None  # written whole
    assert rows(read_table(spark, path), ("SK_t", "v", "w")) == [(1, 1, None), (2, 2, None), (3, 3, "w"), (4, 1 << 40, "w")]
    merge(spark, layout, "2024-03-05", [("a", 5, "w")], "KEY_id string, v bigint, w string")
    assert len(rows(read_table(spark, path))) == 5 and read_own_rows(spark, path).count() == 1


def test_left_behind_closed_rows_of_a_failed_write_do_not_count(spark, tmp_base):
    layout, path = Layout(tmp_base), Layout(tmp_base).gold("DIM2_t")
    merge(spark, layout, "2024-03-01", [("a", "1")])
    merge(spark, layout, "2024-03-02", [("a", "2")])
    held = rows(read_table(spark, path))
    read_table(spark, path).write.parquet(f"{path}/closed/from=2/n=3")  # the write that should have made v=3 stopped here
    assert rows(read_table(spark, path)) == held
    merge(spark, layout, "2024-03-03", [("a", "3")])
    assert rows(read_table(spark, path), ("SK_t", "v")) == [(1, "1"), (2, "2"), (3, "3")]
    read_table(spark, path).write.parquet(f"{path}/closed/from=2/n=4")
    os.makedirs(f"{path}/v=4_load=2024-03-04")  # and here with a version that is not complete
    merge(spark, layout, "2024-03-04", [("a", "3"), ("b", "1")])  # closes nothing
    assert rows(read_table(spark, path), ("SK_t", "v")) == [(1, "1"), (2, "2"), (3, "3"), (4, "1")]


def test_older_versions_and_pruning(spark, tmp_base):
    layout, path = Layout(tmp_base), Layout(tmp_base).gold("DIM2_t")
    for day in range(1, 5):
        merge(spark, layout, f"2024-03-0{day}", [("a", str(day))], retain_versions=2)
    assert len(rows(read_table(spark, path))) == 4
    write_table(read_table(spark, path), path)  # whole again: what it holds is not read twice
    assert len(rows(read_table(spark, path))) == 4
    merge(spark, layout, "2024-03-05", [("a", "5")])
    prune_versions(spark, path, 1)
    assert os.listdir(f"{path}/closed") == ["from=5"] and "n=6" in os.listdir(f"{path}/closed/from=5")
    assert rows(read_table(spark, path), ("SK_t", "v")) == [(n, str(n)) for n in range(1, 6)]


def test_backdated_merge_is_refused(spark, tmp_base):
    layout = Layout(tmp_base)
    merge(spark, layout, "2024-03-01", [("a", "1")])
    merge(spark, layout, "2024-03-09", [("a", "2")])
    with pytest.raises(Exception, match="before the start"):
        merge(spark, layout, "2024-03-05", [("a", "3")])
