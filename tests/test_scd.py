"""Hand-worked SCD fixtures (FIXTURES.md section 4): expected values written out by hand."""

import pytest

from lakeload.operators.prepare import hash_key
from lakeload.operators.scd1 import scd1_create, scd1_merge
from lakeload.operators.scd2 import CLOSE, scd2_actions, scd2_as_of, scd2_create, scd2_current, scd2_merge
from lakeload.operators.validate import DuplicateKeyError


def _src(spark, rows):
    return hash_key(spark.createDataFrame(rows, "KEY_id string, val string"))


def _rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_scd1_merge(spark):
    gold = scd1_create(_src(spark, [("A", "v1"), ("B", "v1"), ("C", "v1")]), sk="SK_t")
    assert _rows(gold, "KEY_id", "val", "SK_t") == [("A", "v1", 1), ("B", "v1", 2), ("C", "v1", 3)]
    out = scd1_merge(gold, _src(spark, [("A", "v1"), ("B", "v2"), ("D", "v1")]))
    assert _rows(out, "KEY_id", "val", "SK_t") == [("A", "v1", 1), ("B", "v2", 2), ("C", "v1", 3), ("D", "v1", 4)]
    b = out.filter("KEY_id = 'B'").first()
    assert b["HASHCOLUMN"] == _src(spark, [("B", "v2")]).first()["HASHCOLUMN"]


def _day2(spark):
    gold = scd2_create(_src(spark, [("A", "v1"), ("B", "v1"), ("C", "v1")]), sk="SK_t")
    src = _src(spark, [("A", "v1"), ("B", "v2"), ("D", "v1")])
    return gold, src


def test_scd2_actions(spark):
    gold, src = _day2(spark)
    acts = scd2_actions(src, gold, now="2024-03-10")
    assert _rows(acts, "KEY_id", "Action", "created_date", "updated_date") == [
        ("A", "delete", "190001010000", "202403100000"),
        ("B", "update", "190001010000", "202403100000"),
        ("D", "new_insert", "190001010000", "999912312359"),
    ]


EXPECTED_IGNORE = [
    ("A", "v1", 1, "190001010000", "999912312359"),
    ("B", "v1", 2, "190001010000", "202403100000"),
    ("B", "v2", 4, "202403100000", "999912312359"),
    ("C", "v1", 3, "190001010000", "999912312359"),
    ("D", "v1", 5, "190001010000", "999912312359"),
]
COLS = ("KEY_id", "val", "SK_t", "created_date", "updated_date")


def test_scd2_merge_ignore_and_idempotent(spark):
    gold, src = _day2(spark)
    out = scd2_merge(gold, src, now="2024-03-10")
    assert _rows(out, *COLS) == EXPECTED_IGNORE
    again = scd2_merge(out, src, now="2024-03-10")
    assert _rows(again, *COLS) == EXPECTED_IGNORE
    assert _rows(scd2_as_of(out, "202403091200"), "KEY_id", "val") == [("A", "v1"), ("B", "v1"), ("C", "v1"), ("D", "v1")]
    assert _rows(scd2_as_of(out, "202403100000"), "KEY_id", "val") == [("A", "v1"), ("B", "v2"), ("C", "v1"), ("D", "v1")]
    assert _rows(scd2_current(out), "KEY_id", "val") == [("A", "v1"), ("B", "v2"), ("C", "v1"), ("D", "v1")]


def test_scd2_merge_close_then_reopen(spark):
    gold, src = _day2(spark)
    out = scd2_merge(gold, src, now="2024-03-10", on_same_hash=CLOSE)
    exp = [r if r[0] != "A" else ("A", "v1", 1, "190001010000", "202403100000") for r in EXPECTED_IGNORE]
    assert _rows(out, *COLS) == exp
    day3 = _src(spark, [("A", "v3")])
    assert _rows(scd2_actions(day3, out, now="2024-03-11"), "KEY_id", "Action") == [("A", "exist_insert")]
    out3 = scd2_merge(out, day3, now="2024-03-11", on_same_hash=CLOSE)
    assert _rows(out3, *COLS) == sorted(exp + [("A", "v3", 6, "202403110000", "999912312359")])


def test_scd2_close_missing(spark):
    gold, src = _day2(spark)
    out = scd2_merge(gold, src, now="2024-03-10", close_missing=True)
    c = [r for r in _rows(out, *COLS) if r[0] == "C"]
    assert c == [("C", "v1", 3, "190001010000", "202403100000")]


def test_merge_errors(spark):
    gold, _ = _day2(spark)
    with pytest.raises(DuplicateKeyError):
        scd2_merge(gold, _src(spark, [("A", "v1"), ("A", "v2")]), now="2024-03-10")
    with pytest.raises(DuplicateKeyError):
        scd2_merge(gold, _src(spark, [(None, "v1")]), now="2024-03-10")


def test_hot_key_history(spark):
    """One key holds most of the versions; the latest-version aggregate is partial (map-side)."""
    from pyspark.sql import functions as F

    versions = spark.range(2000).select(
        F.lit("H").alias("KEY_id"),
        F.concat(F.lit("v"), F.col("id").cast("string")).alias("val"),
    )
    gold = hash_key(versions)
    gold = gold.select(
        "*",
        (F.monotonically_increasing_id() + 1).alias("SK_t"),
        F.lit("190001010000").alias("created_date"),
        F.lit("202401010000").alias("updated_date"),
    )
    gold = spark.createDataFrame(gold.collect(), gold.schema)  # 2000 closed versions of one key
    src = _src(spark, [("H", "new"), ("Q", "q")])
    out = scd2_merge(gold, src, now="2024-03-10")
    opened = _rows(out.filter("updated_date = '999912312359'"), "KEY_id", "val", "created_date")
    assert opened == [("H", "new", "202403100000"), ("Q", "q", "190001010000")]
    assert out.count() == 2002
    from lakeload.operators.scd2 import _latest_state

    plan = _latest_state(gold, ["KEY_id"], "SK_t")._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan


def test_array_columns_pass_through(spark):
    """Array columns are hashed, validated, numbered and merged like any other attribute."""
    from pyspark.sql import functions as F

    from lakeload.operators.prepare import prepare_silver, rename_keys

    emb = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    src = prepare_silver(rename_keys(emb, ["vec_id"]))
    gold = scd2_create(src, sk="SK_emb")
    changed = src.withColumn("label", F.col("label") + F.when(F.col("KEY_vec_id") < 10, 1).otherwise(0))
    changed = prepare_silver(changed.drop("HASHCOLUMN"))
    out = scd2_merge(gold, changed, now="2024-03-10")
    n = emb.count()
    n_changed = emb.filter("vec_id < 10").count()
    assert out.count() == n + n_changed
    assert dict(out.dtypes)["embedding"] == "array<float>"
    again = scd2_merge(out, changed, now="2024-03-10")
    assert again.count() == out.count()


def test_null_safe_keys(spark):
    gold = scd2_create(_src(spark, [(None, "v1"), ("A", "v1")]), sk="SK_t")
    src = _src(spark, [(None, "v2"), ("A", "v1")])
    out = scd2_merge(gold, src, now="2024-03-10", null_safe_keys=True)
    assert {tuple(r) for r in out.select(*COLS).collect()} == {
        (None, "v1", 1, "190001010000", "202403100000"),
        (None, "v2", 3, "202403100000", "999912312359"),
        ("A", "v1", 2, "190001010000", "999912312359"),
    }
    g1 = scd1_create(_src(spark, [(None, "v1"), ("A", "v1")]), sk="SK_t")
    m1 = scd1_merge(g1, _src(spark, [(None, "v9"), ("B", "b")]), null_safe_keys=True)
    assert {(r["KEY_id"], r["val"], r["SK_t"]) for r in m1.collect()} == {(None, "v9", 1), ("A", "v1", 2), ("B", "b", 3)}
    with pytest.raises(DuplicateKeyError):
        scd2_merge(gold, src, now="2024-03-10")


def test_a_chain_of_merges_does_not_blow_up_the_plan(spark):
    leaves = lambda df: df._jdf.queryExecution().analyzed().collectLeaves().size()
    one = scd2_merge(scd2_create(_src(spark, [("A", "v1")]), sk="SK_t"), _src(spark, [("A", "v2"), ("B", "v1")]), now="2024-03-10")
    two = scd2_merge(one, _src(spark, [("A", "v3"), ("B", "v1")]), now="2024-03-11")
    assert _rows(two, "KEY_id", "val", "SK_t") == [("A", "v1", 1), ("A", "v2", 2), ("A", "v3", 4), ("B", "v1", 3)]
    assert leaves(two) <= 4 * leaves(one)
