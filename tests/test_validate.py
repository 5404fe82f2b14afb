"""Duplicate-key validation and silver preparation (FIXTURES.md section 4)."""

import pytest

from lakeload.operators.prepare import prepare_silver, rename_keys
from lakeload.operators.validate import DuplicateKeyError, first_per_key, validate_keys, validate_keys_df
from lakeload.plans.roles import RoleError


def _df(spark, rows):
    return spark.createDataFrame(rows, "KEY_a int, v string")


def test_identical_rows_are_valid(spark):
    res = validate_keys(_df(spark, [(1, "x"), (1, "x"), (2, "y")]))
    assert res.valid and res.key_columns == ["KEY_a"] and res.n_rows == 2 and res.n_keys == 2


def test_conflicting_rows_are_invalid(spark):
    assert not validate_keys(_df(spark, [(1, "x"), (1, "z")])).valid


def test_ignored_column_makes_valid(spark):
    assert validate_keys(_df(spark, [(1, "x"), (1, "z")]), ignore=["v"]).valid


def test_no_key_column_is_valid(spark):
    df = spark.createDataFrame([(1, "x"), (1, "z")], "a int, v string")
    assert validate_keys(df).valid


def test_ignoring_a_key_is_an_error(spark):
    with pytest.raises(RoleError):
        validate_keys(_df(spark, [(1, "x")]), ignore=["KEY_a"])


def test_null_key_is_a_value(spark):
    res = validate_keys(_df(spark, [(None, "x"), (None, "y")]))
    assert not res.valid


def test_prepare_silver_raises_and_keeps_copies(spark):
    with pytest.raises(DuplicateKeyError):
        prepare_silver(_df(spark, [(1, "x"), (1, "z")]))
    out = prepare_silver(_df(spark, [(1, "x"), (1, "x")]))
    assert out.count() == 2 and "HASHCOLUMN" in out.columns
    assert prepare_silver(_df(spark, [(1, "x"), (1, "x")]), dedupe=True).count() == 1


def test_validate_df_shape(spark):
    row = validate_keys_df(rename_keys(spark.createDataFrame([(1, 2, "a")], "x int, y int, z string"), ["x", "y"])).first()
    assert row.asDict() == {"valid": True, "n_rows": 1, "n_keys": 1, "key_columns": ["KEY_x", "KEY_y"]}


def test_first_per_key(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (2, "c", 1)], "k int, s string, n int")
    got = sorted(tuple(r) for r in first_per_key(df, ["k"]).collect())
    assert got == [(1, "a", 9), (2, "c", 1)]


def test_fingerprint_keeps_null_positions_apart(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, "x", None)], "KEY_a int, b string, c string")
    assert not validate_keys(df).valid
    same = spark.createDataFrame([(1, None, "x"), (1, None, "x")], "KEY_a int, b string, c string")
    assert validate_keys(same).valid
