"""Fact loads: business keys replaced by surrogate keys (current and as-of)."""

from lakeload.operators.facts import DimLookup, load_fact
from lakeload.operators.prepare import hash_key
from lakeload.operators.scd1 import scd1_create
from lakeload.operators.scd2 import scd2_create, scd2_merge


def _dim(spark):
    day1 = hash_key(spark.createDataFrame([("A", "v1"), ("B", "v1")], "KEY_id string, val string"))
    gold = scd2_create(day1, sk="SK_d")
    day2 = hash_key(spark.createDataFrame([("A", "v1"), ("B", "v2")], "KEY_id string, val string"))
    return scd2_merge(gold, day2, now="2024-03-10")  # B: SK 2 until 202403100000, SK 3 after


def test_current_lookup_and_unknown(spark):
    fact = spark.createDataFrame([(1, "A"), (2, "B"), (3, "Z")], "f int, id string")
    out = load_fact(fact, [DimLookup(_dim(spark), ["id"])])
    assert sorted(tuple(r) for r in out.collect()) == [(1, 1), (2, 3), (3, -1)]
    assert out.columns == ["f", "SK_d"]


def test_as_of_lookup_half_open(spark):
    fact = spark.createDataFrame(
        [(1, "B", "202403091200"), (2, "B", "202403100000"), (3, "A", "202403120000"), (4, "Z", "202403120000")],
        "f int, id string, at string",
    )
    out = load_fact(fact, [DimLookup(_dim(spark), ["id"], as_of="at", keep_keys=True)])
    got = sorted((r["f"], r["SK_d"]) for r in out.collect())
    assert got == [(1, 2), (2, 3), (3, 1), (4, -1)]


def test_scd1_dimension_lookup(spark):
    dim = scd1_create(hash_key(spark.createDataFrame([("x",), ("y",)], "KEY_c string")), sk="SK_c")
    fact = spark.createDataFrame([(1, "y"), (2, "x"), (3, None)], "f int, c string")
    out = load_fact(fact, [DimLookup(dim, ["c"])])
    assert sorted(tuple(r) for r in out.collect()) == [(1, 2), (2, 1), (3, -1)]


def test_hot_fact_key_is_split_by_aqe(spark):
    """A third of the facts on one key: the key join is skew-split at run time (sizes scaled down)."""
    from pyspark.sql import functions as F

    dim = scd1_create(hash_key(spark.range(1000).select(F.col("id").alias("KEY_c"), F.lit("x").alias("v"))), sk="SK_c")
    hot = spark.range(100000).select(F.lit(7).cast("long").alias("c"), F.col("id").alias("f"))
    cold = spark.range(200000).select((F.col("id") % 1000).alias("c"), F.col("id").alias("f"))
    confs = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        out = load_fact(hot.unionByName(cold), [DimLookup(dim, ["c"])])
        assert out.filter("SK_c = 8").count() == 100000 + 200
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
