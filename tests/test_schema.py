import pytest

from lullcast.config import KOREAN_COLUMNS, settings
from lullcast.schema import PanelSchema, canonical_date, find_date_column, resolve_roles


def test_candidates_are_tried_in_order():
    cfg = {"data": {"date_col_candidates": ["date", "ds"], "target_col_candidates": ["sales", "y"]}}
    assert resolve_roles(["ds", "y", "sales"], cfg) == PanelSchema("ds", "sales", ())


def test_explicit_names_win_if_present():
    cfg = {
        "data": {
            "date_col": "day",
            "target_col": "absent",
            "date_col_candidates": ["ds"],
            "target_col_candidates": ["y"],
            "id_cols": ["b", "a", "absent"],
            "id_col_candidates": ["ds"],
        }
    }
    assert resolve_roles(["a", "b", "day", "ds", "y"], cfg) == PanelSchema("day", "y", ("b", "a"))


def test_every_present_key_candidate_is_taken():
    cfg = settings()
    found = resolve_roles(["date", "sales", "menu_id", "store_id"], cfg)
    assert found.series == ("store_id", "menu_id")


def test_missing_roles_are_listed():
    with pytest.raises(ValueError, match="date and target.*available.*'a'"):
        resolve_roles(["a"], settings())


def test_korean_layout():
    found = resolve_roles(["영업일자", "영업장명_메뉴명", "매출수량"], settings(KOREAN_COLUMNS))
    assert found == PanelSchema("영업일자", "매출수량", ("영업장명_메뉴명",))


def test_date_column_by_name():
    assert find_date_column(["key", "Order_DATE", "ds"]) == "Order_DATE"
    assert find_date_column(["key", "날짜"]) == "날짜"
    assert find_date_column(["a_date", "ds"], "ds") == "ds"
    with pytest.raises(ValueError):
        find_date_column(["key", "value"])


def test_canonical_date_needs_key_and_target(spark):
    df = spark.createDataFrame([("a", "2021-01-01")], "k string, order_date string")
    with pytest.raises(ValueError, match="'y'"):
        canonical_date(df, "k", "y")


def test_overrides_merge_deeply():
    cfg = settings({"cv": {"horizon": 3}}, {"data": {"id_cols": ["a"]}})
    assert cfg["cv"]["horizon"] == 3 and cfg["cv"]["init_train_ratio"] == 0.7
    assert cfg["data"]["id_cols"] == ["a"] and settings()["cv"]["horizon"] == 7
