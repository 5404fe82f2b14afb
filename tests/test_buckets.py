import os

import pytest

from lakeload.operators.prepare import hash_key
from lakeload.operators.scd1 import scd1_create, scd1_merge
from lakeload.operators.scd2 import CLOSE, scd2_create, scd2_merge
from lakeload.operators.validate import DuplicateKeyError
from lakeload.sources import buckets as bk

DAYS = ["2024-01-01", "2024-01-02", "2024-01-03"]


def src(spark, rows, schema="KEY_id long, name string, city string"):
    return hash_key(spark.createDataFrame(rows, schema))


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def files(path):
    return {f"{d}/{n}": os.stat(f"{d}/{n}").st_mtime_ns for d, _, ns in os.walk(path) for n in ns if n.endswith(".parquet")}


def folder(f):
    return f.rsplit("/", 1)[0]


BASE = [(i, f"n{i}", "x") for i in range(200)]


def test_type1_touches_only_buckets_with_a_change(spark, tmp_base):
    path = f"{tmp_base}/DIM1_t"
    gold = scd1_create(src(spark, BASE), sk="SK_t")
    bk.create_buckets(gold, path, buckets=16)
    before = files(path)
    day2 = [(3, "new", "x"), *BASE[10:60], (900, "added", "y")]
    done = bk.merge_scd1_buckets(spark, path, src(spark, day2))
    after = files(path)
    touched = {folder(f) for f in set(before) ^ set(after)}
    assert (done["inserted"], done["updated"]) == (1, 1) and 1 <= len(done["buckets"]) <= 2
    assert {int(f.rsplit("=", 1)[1]) for f in touched} == set(done["buckets"])
    stay = {f for f in before if folder(f) not in touched}
    assert len({folder(f) for f in stay}) >= 13 and all(after[f] == before[f] for f in stay)
    assert rows_of(bk.read_buckets(spark, path)) == rows_of(scd1_merge(gold, src(spark, day2)))
    assert bk.merge_scd1_buckets(spark, path, src(spark, day2))["buckets"] == []  # a repeat changes nothing
    assert files(path) == after


@pytest.mark.parametrize("options", [{}, {"close_missing": True}, {"on_same_hash": CLOSE}])
def test_type2_equals_the_merge_of_whole_tables(spark, tmp_base, options):
    path = f"{tmp_base}/DIM2_t"
    gold = scd2_create(src(spark, BASE), sk="SK_t")
    bk.create_buckets(gold, path, buckets=16)
    feeds = [
        [(3, "new", "x"), (7, "n7", "x"), (900, "added", "y")],
        [(3, "newer", "x"), (900, "added", "y"), (8, "n8", "x")],
        [(3, "newer", "x"), (7, "back", "x"), (900, None, "y"), (901, "a", "b")],
    ]
    closed = {}
    for day, rows in zip(DAYS, feeds):
        done = bk.merge_scd2_buckets(spark, path, src(spark, rows), day, **options)
        gold = _cut(spark, scd2_merge(gold, src(spark, rows), now=day, **options), tmp_base, day)
        assert rows_of(bk.read_buckets(spark, path)) == rows_of(gold)
        assert rows_of(bk.read_current(spark, path)) == rows_of(gold.filter("updated_date = '999912312359'"))
        history = files(f"{path}/history")
        assert all(history.get(f) == t for f, t in closed.items())  # closed history is never written again
        closed = history
        assert done["closed"] >= 1


def _cut(spark, df, base, name):
    df.write.parquet(f"{base}/whole-{name}")
    return spark.read.parquet(f"{base}/whole-{name}")


def test_untouched_buckets_keep_their_files(spark, tmp_base):
    path = f"{tmp_base}/DIM2_t"
    bk.create_buckets(scd2_create(src(spark, BASE), sk="SK_t"), path, buckets=32)
    before = files(path)
    done = bk.merge_scd2_buckets(spark, path, src(spark, [(5, "other", "x"), *BASE[6:]]), DAYS[0])
    assert (done["inserted"], done["closed"]) == (1, 1) and len(done["buckets"]) == 1
    after = files(f"{path}/current")
    kept = {f for f in before if f in after}
    assert len(before) - len(kept) == 1 and all(after[f] == before[f] for f in kept)


def test_a_merge_that_stopped_half_way_is_repeated(spark, tmp_base, monkeypatch):
    path = f"{tmp_base}/DIM2_t"
    gold = scd2_create(src(spark, BASE), sk="SK_t")
    bk.create_buckets(gold, path, buckets=8)
    day2 = src(spark, [(i, "changed", "x") for i in range(0, 40)])

    def stop(*args):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as m:
        m.setattr(bk, "_replace", stop)  # closed rows are written, current ones are not
        with pytest.raises(RuntimeError):
            bk.merge_scd2_buckets(spark, path, day2, DAYS[0])
    bk.merge_scd2_buckets(spark, path, day2, DAYS[0])
    assert rows_of(bk.read_buckets(spark, path)) == rows_of(scd2_merge(gold, day2, now=DAYS[0]))


def test_two_merges_of_one_stamp_keep_the_closed_rows_of_both(spark, tmp_base):
    path = f"{tmp_base}/DIM2_t"
    bk.create_buckets(scd2_create(src(spark, BASE[:20]), sk="SK_t"), path, buckets=1)
    for k in (1, 2):
        bk.merge_scd2_buckets(spark, path, src(spark, [(k, "changed", "x")]), DAYS[0])
    assert sorted(r.KEY_id for r in bk.read_history(spark, path).collect()) == [1, 2]


def test_new_columns_empty_buckets_and_errors(spark, tmp_base):
    path = f"{tmp_base}/DIM1_t"
    bk.create_buckets(scd1_create(src(spark, BASE[:20]), sk="SK_t"), path, buckets=8)
    wide = src(spark, [(3, "n3", "x", 1)], "KEY_id long, name string, city string, rank int")
    bk.merge_scd1_buckets(spark, path, wide)
    got = {r.KEY_id: r["rank"] for r in bk.read_buckets(spark, path).collect()}
    assert got[3] == 1 and len(got) == 20 and got[4] is None
    with pytest.raises(ValueError, match="types differ"):
        bk.merge_scd1_buckets(spark, path, src(spark, [("3", "n3", "x")], "KEY_id string, name string, city string"))
    with pytest.raises(DuplicateKeyError):
        bk.merge_scd1_buckets(spark, path, src(spark, [(3, "a", "x"), (3, "b", "x")]))
    with pytest.raises(FileExistsError):
        bk.create_buckets(scd1_create(src(spark, BASE[:2]), sk="SK_t"), path)

    two = f"{tmp_base}/DIM2_t"
    bk.create_buckets(scd2_create(src(spark, BASE[:3]), sk="SK_t"), two, buckets=4)
    bk.merge_scd2_buckets(spark, two, src(spark, BASE[:3]), DAYS[0], on_same_hash=CLOSE)  # every version closes
    assert bk.read_history(spark, two).count() == 3
    assert not files(f"{two}/current")


def test_only_touched_buckets_are_read_whole(spark, tmp_base):
    path = f"{tmp_base}/DIM1_t"
    bk.create_buckets(scd1_create(src(spark, BASE), sk="SK_t"), path, buckets=16)
    current = bk._read(spark, bk._current(path))
    plan = current.filter(current[bk.BUCKET].isin([3])).drop(bk.BUCKETS, bk.BUCKET)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in plan or "PartitionFilters: [_bucket" in plan
