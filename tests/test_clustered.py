import uuid

import pytest

from lakeload.operators.prepare import hash_key
from lakeload.operators.scd2 import CLOSE, scd2_change, scd2_create, scd2_merge
from lakeload.sources import clustered as cl
from tests.test_buckets import BASE, DAYS, _cut, rows_of, src


@pytest.fixture()
def name():
    return f"t_{uuid.uuid4().hex}"


@pytest.mark.parametrize("mode", ["ignore", CLOSE])
def test_equals_the_merge_of_whole_tables(spark, tmp_base, name, mode):
    path = f"{tmp_base}/DIM2_t"
    gold = scd2_create(src(spark, BASE), sk="SK_t")
    cl.create_clustered(gold, name, path, buckets=4)
    assert cl.bucketing(spark, name) == (["KEY_id"], 4)
    feeds = [[(3, "new", "x"), (7, "n7", "x"), (900, "a", "y")], [(3, "newer", "x"), (900, "a", "y")], [(7, "back", "x"), (3, "newer", "x")]]
    for day, rows in zip(DAYS, feeds):
        done = cl.merge_scd2_clustered(spark, name, path, src(spark, rows), day, on_same_hash=mode)
        gold = _cut(spark, scd2_merge(gold, src(spark, rows), now=day, on_same_hash=mode), tmp_base, day)
        assert rows_of(cl.read_clustered(spark, name, path)) == rows_of(gold)
        assert done["inserted"] >= 1
    assert spark.newSession().table(name).count() == gold.filter("updated_date = '999912312359'").count()


def test_closed_rows_of_a_failed_merge_do_not_count(spark, tmp_base, name, monkeypatch):
    path, day2 = f"{tmp_base}/DIM2_t", src(spark, [(1, "changed", "x")])
    cl.create_clustered(scd2_create(src(spark, BASE[:9]), sk="SK_t"), name, path, buckets=2)
    cl.merge_scd2_clustered(spark, name, path, src(spark, [(0, "changed", "x")]), DAYS[0])
    held = rows_of(cl.read_clustered(spark, name, path))

    def stop(*a):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as m:
        m.setattr(cl, "_publish", stop)
        with pytest.raises(RuntimeError):
            cl.merge_scd2_clustered(spark, name, path, day2, DAYS[1])
    assert rows_of(cl.read_clustered(spark, name, path)) == held
    assert cl.merge_scd2_clustered(spark, name, path, day2, DAYS[1]) == {"inserted": 1, "closed": 1}
    assert len(rows_of(cl.read_clustered(spark, name, path))) == len(held) + 1


def test_a_dimension_is_not_shuffled(spark, tmp_base, name):
    rows = hash_key(spark.range(5000).selectExpr("id AS KEY_id", "repeat('x', 50) AS v"))
    cl.create_clustered(scd2_create(rows, sk="SK_t"), name, f"{tmp_base}/DIM2_t", buckets=4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        gold, source = spark.table(name), rows.limit(4000).repartition(4, "KEY_id")
        change = scd2_change(gold, source, keys=["KEY_id"], now=DAYS[0], max_sk=5000)
        ending = source.select("KEY_id").limit(9).repartition(4, "KEY_id")
        for df in (cl_actions(gold, source), change.current.join(ending, ["KEY_id"], "left_anti")):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "Bucketed: true" in plan and "SelectedBucketsCount: 4 out of 4" in plan
            assert not_exchanged(plan)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def cl_actions(gold, source):
    """The join that finds a merge's changes."""
    from lakeload.operators.scd2 import _actions_frame

    return _actions_frame(source, gold, ["KEY_id"], "SK_t", "202401010000", "left", False)


def not_exchanged(plan):
    """No exchange stands above the scan of the bucketed table."""
    lines = plan.splitlines()
    at = next(k for k, x in enumerate(lines) if "Bucketed: true" in x)
    depth = lambda x: len(x) - len(x.lstrip(" +-:|*"))
    level, above = depth(lines[at]), []
    for x in reversed(lines[:at]):
        if depth(x) < level:
            level = depth(x)
            above.append(x)
    return above and not any("Exchange" in x for x in above)
