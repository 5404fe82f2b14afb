"""Snapshot differences, sorted as-of lookups, late members and dimensions joined in time."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakeload.operators import asof
from lakeload.operators.asof import lookup_sk_sorted
from lakeload.operators.facts import DimLookup, lookup_sk
from lakeload.operators.prepare import hash_key
from lakeload.operators.scd2 import scd2_create, scd2_interval_join, scd2_merge
from lakeload.operators.snapshots import snapshot_diff
from lakeload.operators.validate import DuplicateKeyError
from lakeload.plans import runs
from lakeload.plans.layout import Layout
from lakeload.plans.runs import FactSpec, SilverSpec, load_gold, resolve_late_members, run_difference, run_facts, run_silver
from lakeload.sources.files import load_is_empty, read_load, write_snapshot
from tests.test_buckets import files

SCHEMA = "KEY_id long, name string"


def src(spark, rows):
    return hash_key(spark.createDataFrame(rows, SCHEMA))


# ---------------------------------------------------------------- snapshot_diff
def diff(spark, before, after, **kw):
    return sorted(((r["_change"], r.KEY_id, r.name) for r in snapshot_diff(src(spark, before), src(spark, after), **kw).collect()), key=str)


def test_snapshot_diff(spark):
    before = [(1, "a"), (2, "b"), (2, "b"), (3, None), (4, "d")]
    after = [(1, "a"), (2, "x"), (2, "x"), (3, None), (5, "e"), (5, "e")]
    assert diff(spark, before, after) == [("delete", 4, "d"), ("insert", 5, "e"), ("update", 2, "x")]
    assert diff(spark, before, before) == [] and diff(spark, [], []) == []
    assert diff(spark, [], [(1, "a")]) == [("insert", 1, "a")] and diff(spark, [(1, "a")], []) == [("delete", 1, "a")]


def test_snapshot_diff_of_bad_keys(spark):
    with pytest.raises(DuplicateKeyError):
        diff(spark, [(1, "a")], [(1, "a"), (1, "b")])
    with pytest.raises(DuplicateKeyError):
        diff(spark, [(None, "a")], [(1, "a")])
    assert diff(spark, [(None, "a"), (1, "a")], [(None, "b")], allow_null_keys=True) == [("delete", 1, "a"), ("update", None, "b")]


def test_snapshot_diff_of_new_columns(spark):
    after = hash_key(spark.createDataFrame([(1, "a", 7)], SCHEMA + ", more int"))
    got = snapshot_diff(src(spark, [(1, "a"), (2, "b")]), after).collect()
    assert sorted((r["_change"], r.KEY_id, r.more) for r in got) == [("delete", 2, None), ("update", 1, 7)]


def test_the_day_before_makes_the_feed(spark, tmp_base):
    layout, spec = Layout(tmp_base), SilverSpec("DIM2_t", "src", "t", ["id"])
    days = {"2024-01-01": [(1, "a"), (2, "b")], "2024-01-03": [(1, "a"), (3, "c")], "2024-01-04": [(1, "a"), (3, "c")]}
    for day, rows in days.items():
        write_snapshot(spark.createDataFrame(rows, "id long, name string"), layout.bronze("src"), day, "t")
        run_difference(spark, layout, spec, day)
    path = layout.silver("DIM2_t")
    loads = {d: sorted(r.KEY_id for r in read_load(spark, path, d).collect()) for d in ("2024-01-01", "2024-01-03")}
    assert loads == {"2024-01-01": [1, 2], "2024-01-03": [2, 3]} and load_is_empty(spark, path, "2024-01-04")
    run_difference(spark, layout, spec, "2024-01-03")  # a repeat replaces its load
    assert sorted(r.KEY_id for r in read_load(spark, path, "2024-01-03").collect()) == [2, 3]


# ---------------------------------------------------------------- fact_asof_union
def versions(spark, keys, days=6):
    gold = scd2_create(src(spark, [(k, "v0") for k in keys]), sk="SK_d")
    for d in range(1, days):
        rows = [(k, f"v{d if (k + d) % 3 else d - 1}") for k in keys]
        gold = scd2_merge(gold, src(spark, rows), now=f"2024-01-{d:02d}", close_missing=d == 4)
    return gold


@pytest.mark.parametrize("hot_rows", [10_000_000, 20])
def test_sorted_lookup_equals_the_range_join(spark, hot_rows, monkeypatch):
    monkeypatch.setattr(asof, "HOT_SHARE", 10)
    rnd = random.Random(1)
    dim = versions(spark, [1, 2, 3, 4, 5])
    stamps = [f"202401{d:02d}{h:02d}{m:02d}" for d in range(1, 8) for h in (0, 12) for m in (0, 1)] + ["190001010000", "185001010000", None]
    rows = [(i, 2 if i % 2 else rnd.choice([1, 3, 4, 9, None]), rnd.choice(stamps)) for i in range(1000)]  # half are of one key
    fact = spark.createDataFrame(rows, "f long, k int, at string").repartition(5)
    lookup = DimLookup(dim, ["k"], as_of="at", keep_keys=True)
    got = Counter(map(tuple, lookup_sk_sorted(fact, lookup, hot_rows=hot_rows, pieces=8).collect()))
    want = Counter(map(tuple, lookup_sk(fact, lookup).collect()))
    assert got == want and len({r[3] for r in want}) > 10
    plan = lookup_sk_sorted(fact, lookup, hot_rows=hot_rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan


def test_a_hot_key_is_cut_into_pieces(spark, monkeypatch):
    monkeypatch.setattr(asof, "HOT_SHARE", 10)
    rows = [(7, 202401010000 + i) for i in range(500)] + [(8, 202401010000)] * 300 + [(k, 1) for k in range(100, 300)]
    facts = spark.createDataFrame(rows, "k long, _ll_at long")
    cuts = {r.k: (len(r._ll_cuts), r._ll_salts) for r in asof._hot_cuts(facts, ["k"], 50, 8).collect()}
    assert set(cuts) == {7, 8}
    assert cuts[7][0] >= 6 and cuts[8] == (1, 4)  # one moment: salted instead


def test_sorted_lookup_of_an_empty_side(spark):
    dim = versions(spark, [1], days=2)
    fact = spark.createDataFrame([(1, 1, "202401020000")], "f long, k int, at string")
    none = DimLookup(dim.limit(0), ["k"], as_of="at")
    assert [tuple(r) for r in lookup_sk_sorted(fact, none).collect()] == [(1, "202401020000", -1)]
    assert lookup_sk_sorted(fact.limit(0), DimLookup(dim, ["k"], as_of="at")).collect() == []
    with pytest.raises(ValueError, match="time"):
        lookup_sk_sorted(fact, DimLookup(dim, ["k"]))


# ---------------------------------------------------------------- late members
def test_late_members_rewrite_only_their_loads(spark, tmp_base):
    layout = Layout(tmp_base)
    dim, sales = SilverSpec("DIM2_d", "src", "d", ["id"]), SilverSpec("FACT_s", "src", "s", ["s"])
    spec = FactSpec("FACT_s", "FACT_s", ({"dim": "DIM2_d", "keys": ["d"], "as_of": "at"},), keep_keys=True)
    members = {"2024-01-01": [1], "2024-01-02": [1, 2], "2024-01-03": [1, 2, 3]}
    facts = {"2024-01-01": [(1, 1), (2, 2)], "2024-01-02": [(3, 1)], "2024-01-03": [(4, 9), (5, 3)]}
    seen = []
    for day, ids in members.items():
        write_snapshot(spark.createDataFrame([(i, "n") for i in ids], "id long, name string"), layout.bronze("src"), day, "d")
        rows = [(s, d, "2023-05-05") for s, d in facts[day]]
        write_snapshot(spark.createDataFrame(rows, "s long, d long, at string"), layout.bronze("src"), day, "s")
        run_silver(spark, layout, [dim, sales], day)
        load_gold(spark, layout, "DIM2_d", day)
        before = files(layout.gold("FACT_s"))
        seen.append(run_facts(spark, layout, [spec], day)[0]["message"])
        after = files(layout.gold("FACT_s"))
        anew = {f.split("LoadDate=")[1][:10] for f in before if after.get(f) != before[f]}
        assert anew == ({"2024-01-01"} if day == "2024-01-02" else set())  # only day 1's load has a late key
    assert seen == ["1 keys without a dimension row", "1 late keys resolved", "1 keys without a dimension row"]
    got = {r.KEY_s: (r.d, r.SK_d) for r in spark.read.parquet(layout.gold("FACT_s")).collect()}
    assert got == {1: (1, 1), 2: (2, 2), 3: (1, 1), 4: (9, -1), 5: (3, 3)}
    assert resolve_late_members(spark, layout, spec) == (0, [])


def test_a_version_of_a_dimension_is_checked_once(spark, tmp_base, monkeypatch):
    layout, seen, check = Layout(tmp_base), [], runs.check_versions
    monkeypatch.setattr(runs, "check_versions", lambda dim, keys: (seen.append(dim.count()), check(dim, keys)))
    dim, sales = SilverSpec("DIM2_d", "src", "d", ["id"]), SilverSpec("FACT_s", "src", "s", ["s"])
    spec = FactSpec("FACT_s", "FACT_s", ({"dim": "DIM2_d", "keys": ["d"]},))
    for day, name, merge in (("2024-01-01", "a", True), ("2024-01-02", "a", False), ("2024-01-03", "b", True)):
        write_snapshot(spark.createDataFrame([(1, name)], "id long, name string"), layout.bronze("src"), day, "d")
        write_snapshot(spark.createDataFrame([(7, 1)], "s long, d long"), layout.bronze("src"), day, "s")
        run_silver(spark, layout, [dim, sales], day)
        if merge:
            load_gold(spark, layout, "DIM2_d", day)
        run_facts(spark, layout, [spec], day)
    assert seen == [1, 2]
    assert sorted(r.SK_d for r in spark.read.parquet(layout.gold("FACT_s")).collect()) == [1, 1, 2]


# ---------------------------------------------------------------- scd2_interval_join
def test_ranges_of_both_dimensions_are_gapless(spark):
    left = versions(spark, [1, 2, 3], days=4).withColumn("ref", F.col("KEY_id") % 2)
    names = [(k, f"p{k}") for k in (0, 1)]
    right = scd2_create(src(spark, names), sk="SK_p")
    right = scd2_merge(right, src(spark, [(0, "q"), (1, "p1")]), now="2024-01-02")
    right = scd2_merge(right, src(spark, [(0, "r"), (1, "s")]), now="2024-02-01")
    right = right.withColumnsRenamed({"KEY_id": "KEY_p", "name": "p_name"})
    got = scd2_interval_join(left, right, {"ref": "KEY_p"}).collect()
    want = [
        (a.KEY_id, a.SK_d, b.SK_p, max(a.created_date, b.created_date), min(a.updated_date, b.updated_date))
        for a in left.collect()
        for b in right.collect()
        if a.ref == b.KEY_p and max(a.created_date, b.created_date) < min(a.updated_date, b.updated_date)
    ]
    rows = sorted((r.KEY_id, r.SK_d, r.SK_p, r.created_date, r.updated_date) for r in got)
    assert rows == sorted(want)
    for k in (1, 2, 3):
        ends = sorted(r[3:] for r in rows if r[0] == k)
        assert ends[0][0] == "190001010000" and ends[-1][1] == "999912312359"
        assert all(x[1] == y[0] for x, y in zip(ends, ends[1:]))
    with pytest.raises(ValueError, match="both dimensions"):
        scd2_interval_join(left, right.withColumnRenamed("p_name", "name"), {"ref": "KEY_p"})
