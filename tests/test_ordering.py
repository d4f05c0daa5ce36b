"""Row order of the queries whose reference output is ordered (the oracle compare is order-insensitive)."""

import pytest

from tessera.plans import driver

SF = "/root/testdata/sf0.01"


def _nulls_last_non_decreasing(vals):
    present = [v for v in vals if v is not None]
    first_null = next((i for i, v in enumerate(vals) if v is None), len(vals))
    return present == sorted(present) and all(v is None for v in vals[first_null:])


def _non_increasing(vals):
    present = [v for v in vals if v is not None]
    return present == sorted(present, reverse=True) and vals[: len(present)] == present


@pytest.mark.parametrize("name", ["star_wide", "star_wide_meta"])
def test_star_views_by_date(spark, name):
    rows = driver.QUERIES[name](spark, SF).select("order_date", "l_orderkey", "l_linenumber").collect()
    assert _nulls_last_non_decreasing([r.order_date for r in rows])
    keys = [(r.order_date, r.l_orderkey, r.l_linenumber) for r in rows]
    assert keys == sorted(keys)


@pytest.mark.parametrize("name,col,check", [
    ("yearly_trend", "year", _nulls_last_non_decreasing),
    ("value_counts", "count", _non_increasing),
    ("destination_summary", "total_missions", _non_increasing),
    ("region_profile", "total_orders", _non_increasing),
    ("category_profile", "total_orders", _non_increasing),
    ("group_median", "median_price", _non_increasing),
    ("null_profile", "null_pct", _non_increasing),
    ("duplicate_rows", "p_name", _nulls_last_non_decreasing),
])
def test_sorted_marts(spark, name, col, check):
    vals = [r[col] for r in driver.QUERIES[name](spark, SF).collect()]
    assert vals and check(vals), vals[:10]
