"""Column roles and table-name conventions."""

import pytest

from lakeload.plans.roles import (
    RoleError,
    attribute_columns,
    key_columns,
    resolve_keys,
    scd_type,
    sk_column,
    sk_name_for,
)


def test_keys_by_prefix_not_substring():
    assert key_columns(["KEY_a", "b_KEY_c", "d", "KEY_e"]) == ["KEY_a", "KEY_e"]


def test_sk_name_and_column():
    assert sk_name_for("DIM2_order_items") == "SK_order_items"
    assert sk_column(["KEY_a", "SK_t", "v"]) == "SK_t"
    with pytest.raises(RoleError):
        sk_column(["SK_a", "SK_b"])
    with pytest.raises(RoleError):
        sk_column(["KEY_a"])


def test_scd_type_prefix():
    assert scd_type("dim1_x") == 1 and scd_type("DIM2_x") == 2
    with pytest.raises(RoleError):
        scd_type("FACT_x")


def test_resolve_and_attributes():
    cols = ["KEY_a", "v", "HASHCOLUMN", "SK_t", "created_date", "updated_date", "LoadDate"]
    assert resolve_keys(cols, None) == ["KEY_a"]
    with pytest.raises(RoleError):
        resolve_keys(cols, None, ignore=["KEY_a"])
    with pytest.raises(RoleError):
        resolve_keys(cols, ["nope"])
    assert attribute_columns(cols, ["KEY_a"]) == ["v", "LoadDate"]
