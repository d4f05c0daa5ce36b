"""Invariants on the driver tables (sf0.01): keys, orphans, totals, partitions of the input."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import quality
from tessera.plans import driver

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def dims(spark):
    return driver._dims(spark, SF)


def test_dimension_keys_dense_and_unique(dims):
    for name, col in [("date", "date_id"), ("nation", "nation_id"), ("pair", "pair_id")]:
        df = dims[name]
        n = df.count()
        r = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"), F.count_distinct(col).alias("d")).collect()[0]
        assert (r.lo, r.hi, r.d) == (1, n, n), name


def test_fact_has_no_orphans_or_unresolved(spark, dims):
    fact = driver._fact(spark, SF, dims)
    assert fact.count() == driver.t(spark, SF, "lineitem").count()
    for fk, dim, pk in [("nation_id", "nation", "nation_id"), ("pair_id", "pair", "pair_id"),
                        ("order_date_id", "date", "date_id"), ("ship_date_id", "date", "date_id")]:
        assert quality.fk_violations(fact, fk, dims[dim], pk).count() == 0, fk
    r = quality.unresolved_keys(fact, ["nation_id", "pair_id", "order_date_id", "ship_date_id"]).collect()[0]
    assert all(v == 0 for v in r)


def test_keys_stable_across_runs(spark):
    a = {r.full_date: r.date_id for r in driver.dim_date(spark, SF).collect()}
    b = {r.full_date: r.date_id for r in driver.dim_date(spark, SF).collect()}
    assert a == b


def test_group_counts_sum_to_rows(spark):
    n = driver.t(spark, SF, "orders").count()
    assert driver.group_summary(spark, SF).agg(F.sum("total_orders")).collect()[0][0] == n
    assert driver.contingency(spark, SF).agg(F.sum("observed")).collect()[0][0] == n
    piv = driver.category_period_pivot(spark, SF)
    assert piv.select(sum(F.col(c) for c in piv.columns[1:]).alias("s")).agg(F.sum("s")).collect()[0][0] == n


def test_histogram_counts_sum_to_n(spark):
    n = driver.t(spark, SF, "lineitem").count()
    assert driver.histogram(spark, SF).agg(F.sum("count")).collect()[0][0] == n
    ev = driver.t(spark, SF, "events").where("value IS NOT NULL AND event_type IS NOT NULL").count()
    assert driver.histogram_by_group(spark, SF).agg(F.sum("count")).collect()[0][0] == ev


def test_kept_plus_rejected_is_input(spark):
    kept = driver.lookup_validity_filter(spark, SF).count()
    rej = driver.rejects(spark, SF).count()
    assert kept + rej == driver.t(spark, SF, "orders").count()


def test_bridge_ids_dense(spark):
    b = driver.bridge_explode(spark, SF)
    r = b.agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi"),
              F.count_distinct("id").alias("d")).collect()[0]
    assert (r.lo, r.hi, r.d) == (1, r.n, r.n)
