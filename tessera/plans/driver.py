"""The operators bound to the driver's TPC-H-like tables.

Roles (see SURVEY 7.3): an order is a "mission"; nation / region / market
segment play agency / country / agency type; ``o_orderstatus`` (F/O/P) is the
status with ``F`` as success; ``o_orderpriority`` is the category and
``'1-URGENT'`` the crewed-like flag; ``o_totalprice`` (as decimal(12,2)) the
cost; ``datediff(l_shipdate, o_orderdate)`` the duration. Raw-looking text
(sentinels, durations, numbers, dates) is derived from the tables with
integer arithmetic so both engines derive the same text for every row.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole tables; :mod:`tessera.plans.driver_sql` holds the equivalent SQL.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates as D
from ..functions import numbers as N
from ..functions import text as X
from ..functions.pvalues import verdict
from ..operators import filters, marts, model, quality, stats
from ..operators.staging import stage_table
from ..session import ensure_checkpoint_dir
from ..sources import io, schema, sink
from . import missions

STATUSES = {"finished_orders": "F", "open_orders": "O", "pending_orders": "P"}
SUCCESS = "F"
URGENT = "1-URGENT"
GOVT, PRIVATE = "BUILDING", "AUTOMOBILE"

# Synthetic first year per nation for the reference-date filter
# (12 nations known, the rest unknown), by rule 1995 + i mod 4.
FIRST_YEAR = {f"NATION_{i}": 1995 + i % 4 for i in range(12)}


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return io.read_table(spark, sf, name)


def cost(c: str = "o_totalprice") -> Column:
    return F.col(c).cast("decimal(12,2)")


def order_star(spark: SparkSession, sf: str) -> DataFrame:
    """orders ⋈ customer ⋈ nation ⋈ region with the role columns."""
    o = t(spark, sf, "orders")
    c = t(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = t(spark, sf, "nation")
    r = t(spark, sf, "region")
    return (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(n, F.col("c_nationkey") == n.n_nationkey)
        .join(r, F.col("n_regionkey") == r.r_regionkey)
        .select(
            "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate",
            cost().alias("cost"), "c_mktsegment", "n_name", "r_name",
        )
    )


def line_star(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem ⋈ orders ⋈ customer ⋈ nation: one row per line with duration in days."""
    li = t(spark, sf, "lineitem")
    o = t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    c = t(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = t(spark, sf, "nation").select("n_nationkey", "n_name")
    return (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .join(c, F.col("o_custkey") == c.c_custkey)
        .join(n, F.col("c_nationkey") == n.n_nationkey)
        .select(
            "l_orderkey", "l_linenumber", "o_orderstatus", "o_orderpriority", "c_mktsegment", "n_name",
            cost("l_extendedprice").alias("cost"),
            F.datediff(F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date")).alias("duration_days"),
        )
    )


# ------------------------------------------------------------------ marts

def group_summary(spark, sf):
    return marts.status_summary(
        order_star(spark, sf), ["n_name", "r_name", "c_mktsegment"], "o_orderstatus", STATUSES, SUCCESS, "cost",
        extra_counts={"urgent_orders": F.col("o_orderpriority") == URGENT}, id_col="o_orderkey",
        total_alias="total_orders", avg_alias="avg_price", sum_alias="total_price",
    )


def _dim_date(spark, sf) -> DataFrame:
    days = t(spark, sf, "orders").select(F.col("o_orderdate").alias("d")).union(
        t(spark, sf, "lineitem").select(F.col("l_shipdate").alias("d"))
    )
    return model.date_dimension(days, ["d"])


def dim_date(spark, sf):
    return _dim_date(spark, sf)


def yearly_trend(spark, sf):
    dd = _dim_date(spark, sf)
    star = order_star(spark, sf)
    fact = model.role_playing_keys(star, dd, {"order_date_id": "o_orderdate"})
    joined = model.inner_lookup(fact, dd.select("date_id", "year", "decade"), "order_date_id", "date_id")
    return marts.status_summary(
        joined, ["year", "decade"], "o_orderstatus", {"successes": "F", "failures": "O"}, SUCCESS, "cost",
        extra_counts={"urgent_orders": F.col("o_orderpriority") == URGENT}, id_col="o_orderkey",
        total_alias="total_launches", rate_alias=None, avg_alias="avg_price", sum_alias=None,
        order_by=[F.col("year")],
    )


def _part_roles(spark, sf) -> DataFrame:
    p = t(spark, sf, "part")
    return p.select(
        "p_partkey",
        F.when(F.col("p_size") > 45, F.lit(None)).otherwise(F.col("p_brand")).alias("destination"),
        F.when(F.col("p_size") < 5, F.lit(None)).otherwise(F.col("p_type")).alias("category"),
    )


def destination_summary(spark, sf):
    li = t(spark, sf, "lineitem").select("l_partkey", "l_linestatus", cost("l_extendedprice").alias("cost"), "l_orderkey")
    fact = li.join(_part_roles(spark, sf), F.col("l_partkey") == F.col("p_partkey"))
    out = marts.status_summary(
        fact, ["destination", "category"], "l_linestatus", {}, "F", "cost", id_col="l_orderkey",
        avg_alias="avg_price", sum_alias=None,
    )
    return marts.sort_nulls_last(out, [("total_missions", False), ("destination", True), ("category", True)])


def _group_profile(spark, sf) -> DataFrame:
    return marts.group_profile(
        line_star(spark, sf), "n_name", "o_orderstatus", STATUSES, SUCCESS, "cost", "duration_days", "c_mktsegment",
        flag_counts={"urgent_lines": F.col("o_orderpriority") == URGENT}, min_total=5,
    )


def group_profile(spark, sf):
    return _group_profile(spark, sf)


def region_profile(spark, sf):
    return marts.rate_profile(
        order_star(spark, sf), ["r_name"], "o_orderstatus", {"success_rate": SUCCESS}, "cost",
        counts={"govt_orders": F.col("c_mktsegment") == GOVT, "private_orders": F.col("c_mktsegment") == PRIVATE},
        shares={"private_pct": "private_orders"}, total_alias="total_orders", avg_alias="avg_price",
        order_by=[F.col("total_orders").desc()], id_col="o_orderkey",
    )


def decade_type_profile(spark, sf):
    star = order_star(spark, sf).withColumn("order_decade", D.decade_label(F.year("o_orderdate")))
    return marts.rate_profile(
        star, ["order_decade", "c_mktsegment"], "o_orderstatus", {"success_rate": SUCCESS}, "cost",
        total_alias="orders", avg_alias="avg_price", decimals=4, rate_decimals=None, id_col="o_orderkey",
    )


def category_profile(spark, sf):
    prof = marts.rate_profile(
        order_star(spark, sf), ["o_orderpriority"], "o_orderstatus", {"success_rate": "F", "failure_rate": "O"}, "cost",
        total_alias="total_orders", avg_alias="avg_price", order_by=[F.col("total_orders").desc()],
        rate_decimals=None, id_col="o_orderkey",
    )
    return prof.withColumn("rate_band", N.threshold_label(F.col("success_rate"), 33.0))


def category_period_pivot(spark, sf):
    o = t(spark, sf, "orders").select("o_orderpriority", F.year("o_orderdate").alias("order_year"))
    return marts.pivot_counts(o, "o_orderpriority", "order_year")


def contingency(spark, sf):
    return marts.contingency(order_star(spark, sf), "r_name", "o_orderstatus")


def group_median(spark, sf):
    o = t(spark, sf, "orders")
    return marts.group_median(o, "o_orderpriority", "o_totalprice", "median_price")


def overview(spark, sf):
    star = order_star(spark, sf).withColumn("order_year", F.year("o_orderdate"))
    return marts.overview(
        star, ["n_name", "r_name"], ["order_year"],
        flags={"urgent_orders": F.col("o_orderpriority") == URGENT, "other_orders": F.col("o_orderpriority") != URGENT},
        count_alias="total_orders",
    )


def distinct_where(spark, sf):
    e = t(spark, sf, "events")
    return model.distinct_where(e, "user_id", F.col("event_type") == "purchase", "purchasing_users")


def value_counts(spark, sf):
    return marts.value_counts(t(spark, sf, "orders"), "o_orderpriority")


def value_share(spark, sf):
    return marts.value_share(t(spark, sf, "customer"), "c_mktsegment")


def _nullable_orders(spark, sf) -> DataFrame:
    """orders with NULLs derived by key arithmetic (for null-aware operators)."""
    o = t(spark, sf, "orders")
    k = F.col("o_orderkey")
    return o.select(
        "o_orderkey",
        F.when(k % 7 == 0, F.lit(None)).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(k % 5 == 0, F.lit(None)).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
        F.when(k % 11 == 0, F.lit(None)).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_custkey", "o_orderdate",
    )


def value_counts_multi(spark, sf):
    return marts.value_counts_multi(_nullable_orders(spark, sf), ["o_orderstatus", "o_orderpriority"])


def share_kpis(spark, sf):
    return marts.share_kpis(
        order_star(spark, sf), "n_name", "NATION_0", "o_orderstatus", SUCCESS, "cost",
        {
            "govt_success_rate": F.col("c_mktsegment") == GOVT,
            "private_success_rate": F.col("c_mktsegment") == PRIVATE,
            "urgent_success_rate": F.col("o_orderpriority") == URGENT,
            "low_success_rate": F.col("o_orderpriority") == "5-LOW",
        }, min_total=5, id_col="o_orderkey",
    ).select(*[F.round(c, 6).alias(c) for c in [
        "key_share_pct", "key_spend_share_pct", "govt_success_rate", "private_success_rate",
        "urgent_success_rate", "low_success_rate",
    ]])


def two_sample_overview(spark, sf):
    star = order_star(spark, sf).withColumn("price", F.col("cost").cast("double"))
    out = marts.two_sample_overview(star, "c_mktsegment", "price", [GOVT, PRIVATE])
    return out.select("c_mktsegment", "n", F.round("mean", 4).alias("mean"), F.round("median", 4).alias("median"))


def describe_all(spark, sf):
    d = marts.describe_all(t(spark, sf, "orders"))
    return d.select(
        "column_name", "count", "unique", "top", "freq",
        *[F.round(c, 4).alias(c) for c in ["mean", "std", "min", "q25", "q50", "q75", "max"]],
    )


def describe_percentiles(spark, sf):
    ls = line_star(spark, sf).select(
        "duration_days", F.col("cost").cast("double").alias("cost")
    )
    li = t(spark, sf, "lineitem").select("l_quantity", "l_discount")
    long = marts.long_values(li, ["l_quantity", "l_discount"]).unionByName(marts.long_values(ls, ["duration_days", "cost"]))
    return marts.describe_long(long)


def schema_report(spark, sf):
    return marts.schema_report(t(spark, sf, "orders"))


# ------------------------------------------------------------------ cleaning

def _raw_priority(k: Column, v: Column) -> Column:
    m = k % 7
    return (
        F.when(m == 0, F.lit(" N/A ")).when(m == 1, F.lit("Unknown")).when(m == 2, F.concat(F.lit("  "), v, F.lit(" ")))
        .when(m == 3, F.lit("null")).when(m == 4, F.lit("NaN")).when(m == 5, F.lit("<NA>")).otherwise(v)
    )


def clean_sentinels(spark, sf):
    o = t(spark, sf, "orders")
    raw = o.select(
        F.col("o_orderkey").alias(" Order Key"),
        _raw_priority(F.col("o_orderkey"), F.col("o_orderpriority")).alias("Raw Priority "),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit("not applicable")).otherwise(F.col("o_orderstatus")).alias("Order Status"),
    )
    return X.clean_text_columns(X.normalize_columns(raw))


def _raw_date(k: Column, d: Column) -> Column:
    m = k % 5
    return (
        F.when(m == 0, F.date_format(d, "yyyy-MM-dd")).when(m == 1, F.date_format(d, "yyyy/MM/dd"))
        .when(m == 2, F.date_format(d, "yyyy")).when(m == 3, F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.concat(F.date_format(d, "yyyy"), F.lit("-02-30")))
    )


def parse_dates(spark, sf):
    o = t(spark, sf, "orders")
    return o.select(
        "o_orderkey", _raw_date(F.col("o_orderkey"), F.col("o_orderdate")).alias("raw_date")
    ).withColumn("parsed_date", D.parse_date(F.col("raw_date")))


def calendar_attributes(spark, sf):
    o = t(spark, sf, "orders")
    day = D.to_day(F.col("o_orderdate"))
    return o.select("o_orderkey", day.alias("order_day"), *D.calendar_columns(day))


def _raw_duration(k: Column, q: Column) -> Column:
    m = k % 8
    qs = q.cast("bigint").cast("string")
    return (
        F.when(m == 0, F.concat(qs, F.lit(" days"))).when(m == 1, F.concat(qs, F.lit(" Months")))
        .when(m == 2, F.concat(F.lit("~"), qs, F.lit(" years"))).when(m == 3, F.concat(qs, F.lit(" hours")))
        .when(m == 4, F.concat(F.lit("1 year "), qs, F.lit(" months"))).when(m == 5, qs)
        .when(m == 6, F.concat(qs, F.lit(" weeks"))).otherwise(F.concat(F.lit("1,"), qs, F.lit(".5 days")))
    )


def _durations(spark, sf) -> DataFrame:
    li = t(spark, sf, "lineitem")
    raw = _raw_duration(F.col("l_linenumber") + F.col("l_orderkey"), F.col("l_quantity"))
    return N.with_duration_days(li.select("l_orderkey", "l_linenumber", raw.alias("raw_duration")), "raw_duration")


def parse_duration(spark, sf):
    return _durations(spark, sf)


def _raw_number(k: Column, p: Column) -> Column:
    m = k % 6
    ps = p.cast("string")
    return (
        F.when(m == 0, F.lit("bad")).when(m == 1, F.concat(F.lit(" "), ps, F.lit(" ")))
        .when(m == 2, F.concat(ps, F.lit("d"))).when(m == 3, F.concat(F.lit("1,"), ps)).otherwise(ps)
    )


def parse_numeric(spark, sf):
    o = t(spark, sf, "orders")
    raw = o.select("o_orderkey", _raw_number(F.col("o_orderkey"), F.col("o_totalprice")).alias("raw_cost"))
    num = N.to_number(F.col("raw_cost"))
    return raw.select(
        "o_orderkey", "raw_cost", num.alias("cost_value"),
        N.rescale(num, 1000, (12, 2)).cast("double").alias("cost_thousands"),
    )


def _customer_nation_orders(spark, sf) -> DataFrame:
    o = t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = t(spark, sf, "nation").select("n_nationkey", "n_name")
    return o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == n.n_nationkey).select(
        "o_orderkey", "n_name", "o_orderdate"
    )


def lookup_validity_filter(spark, sf):
    return filters.reference_date_filter(_customer_nation_orders(spark, sf), "n_name", "o_orderdate", FIRST_YEAR)


def rejects(spark, sf):
    _, rej = filters.reference_date_filter(
        _customer_nation_orders(spark, sf), "n_name", "o_orderdate", FIRST_YEAR, with_rejects=True
    )
    return rej


def temporal_violations(spark, sf):
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = t(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey).select("l_orderkey", "l_linenumber", "o_orderdate", "l_shipdate")
    return filters.order_violations(j, "o_orderdate", "l_shipdate")


def range_notnull_filter(spark, sf):
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    return filters.not_null_below(filters.where_in(li, "l_returnflag", ["R", "A"]), "l_quantity", 25)


def dropna(spark, sf):
    return filters.drop_nulls(_nullable_orders(spark, sf), ["o_orderstatus", "o_orderpriority"])


# ------------------------------------------------------------------ model

def _dim_group(spark, sf) -> DataFrame:
    c = t(spark, sf, "customer").select("c_nationkey", "c_mktsegment")
    n = t(spark, sf, "nation")
    r = t(spark, sf, "region")
    base = c.join(n, F.col("c_nationkey") == n.n_nationkey).join(r, F.col("n_regionkey") == r.r_regionkey)
    return model.distinct_dimension(base, ["n_name", "r_name", "c_mktsegment"], "group_id", required=["n_name"])


def dim_group(spark, sf):
    return _dim_group(spark, sf)


def _dim_pair(spark, sf) -> DataFrame:
    return model.distinct_dimension(_part_roles(spark, sf), ["destination", "category"], "pair_id")


def dim_pair(spark, sf):
    return _dim_pair(spark, sf)


def _dim_nation(spark, sf) -> DataFrame:
    n = t(spark, sf, "nation")
    r = t(spark, sf, "region")
    base = n.join(r, n.n_regionkey == r.r_regionkey)
    return model.distinct_dimension(base, ["n_name", "r_name"], "nation_id", required=["n_name"])


def _dims(spark, sf) -> dict[str, DataFrame]:
    """The three dimensions, each built and staged once per query. A staged table's
    size is known when the fact's plan is made, so a small dimension is broadcast
    and the fact stays where it is."""
    dims = {"date": _dim_date(spark, sf), "nation": _dim_nation(spark, sf), "pair": _dim_pair(spark, sf)}
    return {name: stage_table(dim, f"dim-{name}") for name, dim in dims.items()}


META = {"o_orderpriority": "o_orderpriority", "o_orderstatus": "o_orderstatus"}


def _fact(spark, sf, dims: dict[str, DataFrame] | None = None, meta: DataFrame | None = None) -> DataFrame:
    """The fact; with ``meta`` (one row per order) also its columns, joined right
    behind the orders, while the lines are still partitioned by the order key."""
    li = t(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_shipdate", cost("l_extendedprice").alias("cost")
    )
    o = t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = t(spark, sf, "nation").select("n_nationkey", "n_name")
    lines = li.join(o, li.l_orderkey == o.o_orderkey)
    if meta is not None:
        lines = lines.join(meta.withColumnRenamed("o_orderkey", "_meta_key"), F.col("l_orderkey") == F.col("_meta_key"), "left").drop("_meta_key")
    base = (
        lines.join(c, F.col("o_custkey") == c.c_custkey)
        .join(n, F.col("c_nationkey") == n.n_nationkey).join(_part_roles(spark, sf), F.col("l_partkey") == F.col("p_partkey"))
    )
    dims = dims or _dims(spark, sf)
    dd = dims["date"]
    f = model.lookup_key(base, dims["nation"], ["n_name"], ["n_name"], "nation_id")
    f = model.lookup_key(f, dims["pair"], ["destination", "category"], ["destination", "category"], "pair_id", null_safe=True)
    f = model.role_playing_keys(f, dd, {"order_date_id": "o_orderdate", "ship_date_id": "l_shipdate"})
    return model.project(f, [
        "l_orderkey", "l_linenumber", "nation_id", "pair_id", "order_date_id", "ship_date_id", "l_returnflag",
        F.col("cost").cast("double").alias("cost"), *(META if meta is not None else ()),
    ])


def ship_days_without_orders(spark, sf):
    """Days something shipped on which no order was placed (EXCEPT of two date sets)."""
    ship = t(spark, sf, "lineitem").select(D.to_day(F.col("l_shipdate")).alias("day"))
    order = t(spark, sf, "orders").select(D.to_day(F.col("o_orderdate")).alias("day"))
    return model.set_difference(ship, order)


def fact_build(spark, sf):
    return _fact(spark, sf)


def meta_dim(spark, sf):
    return model.project(t(spark, sf, "orders"), ["o_orderkey", "o_orderpriority", "o_orderstatus", "o_custkey"])


def bridge_explode(spark, sf):
    d = t(spark, sf, "documents")
    return model.bridge(d, "doc_id", "text", "item", key_col="id")


def bridge_counts(spark, sf):
    """D7/D8 counters + A15: bridge rows, documents with items, English documents."""
    d = t(spark, sf, "documents")
    items = model.explode_list(d, "doc_id", "text", "item")
    n_items = items.select(F.count(F.lit(1))).scalar()
    return d.agg(
        n_items.cast("bigint").alias("bridge_rows"),
        F.count_distinct(F.when(F.col("text").contains(","), F.col("doc_id"))).alias("docs_with_lists"),
        F.count_distinct(F.when(F.col("lang") == "en", F.col("doc_id"))).alias("english_docs"),
    )


def _star_arms(dims: dict[str, DataFrame]):
    dd = dims["date"]
    return [
        model.DimJoin(dims["nation"], "nation_id", "nation_id", {"n_name": "n_name", "r_name": "r_name"}),
        model.DimJoin(dims["pair"], "pair_id", "pair_id", {"destination": "destination", "category": "category"}),
        model.DimJoin(dd, "order_date_id", "date_id", {
            "order_date": "full_date", "order_year": "year", "order_quarter": "quarter", "order_month": "month",
            "order_decade": "decade",
        }),
        model.DimJoin(dd, "ship_date_id", "date_id", {
            "ship_date": "full_date", "ship_year": "year", "ship_quarter": "quarter", "ship_month": "month",
            "ship_decade": "decade",
        }),
    ]


# Ordered by date as the wide views are; the line key breaks ties so a date
# holding many rows is still split across range partitions.
def star_order() -> list[Column]:
    return [F.col("order_date").asc_nulls_last(), F.col("l_orderkey"), F.col("l_linenumber")]


def star_wide(spark, sf):
    dims = _dims(spark, sf)
    return model.star_join(
        _fact(spark, sf, dims), ["l_orderkey", "l_linenumber", "l_returnflag", "cost"], _star_arms(dims),
        order_by=star_order(),
    )


def star_wide_meta(spark, sf):
    dims = _dims(spark, sf)
    meta = model.project(t(spark, sf, "orders"), ["o_orderkey", "o_orderpriority", "o_orderstatus"])
    return model.star_join(
        _fact(spark, sf, dims, meta), ["l_orderkey", "l_linenumber", "l_returnflag", "cost", *META], _star_arms(dims),
        order_by=star_order(),
    )


# ------------------------------------------------------------------ quality

def pk_violations(spark, sf):
    return quality.pk_violations(t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def fk_violations(spark, sf):
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    parent = t(spark, sf, "supplier").where(F.col("s_acctbal") > 0)
    return quality.fk_violations(li, "l_suppkey", parent, "s_suppkey")


def unresolved_keys(spark, sf):
    return quality.unresolved_keys(_fact(spark, sf), ["nation_id", "pair_id", "order_date_id", "ship_date_id"])


def check_violations(spark, sf):
    li = t(spark, sf, "lineitem")
    return quality.check_violations(
        li, ["l_shipdate", "l_returnflag"], {"l_discount": (0.0, 0.08), "l_quantity": (1, 45)}
    )


def length_violations(spark, sf):
    p = t(spark, sf, "part")
    return quality.length_violations(p, {"p_name": 10, "p_type": 6, "p_brand": 8}, {"p_retailprice": (5, 2)})


def domain_violations(spark, sf):
    o = t(spark, sf, "orders")
    return quality.domain_violations(o, {
        "o_orderstatus": ["F", "O", None], "o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM"],
    })


def parse_counters(spark, sf):
    d = _durations(spark, sf)
    return quality.counters(d, {
        "rows": F.lit(True),
        "duration_parsed": F.col("duration_days").isNotNull(),
        "duration_failed": F.col("duration_days").isNull(),
        "raw_missing": F.col("raw_duration").isNull(),
    })


TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def health_check(spark, sf):
    return quality.health_check({n: (lambda n=n: t(spark, sf, n)) for n in TABLES}, spark)


def duplicate_counts(spark, sf):
    return quality.duplicate_counts(t(spark, sf, "part"), ["p_name", "p_partkey", "p_brand"])


def duplicate_rows(spark, sf):
    p = t(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    return quality.duplicate_rows(p, "p_name", 10, tie_break=["p_partkey"])


def null_profile(spark, sf):
    return quality.null_profile(_nullable_orders(spark, sf))


# ------------------------------------------------------------------ sources

def sql_params(spark, sf):
    t(spark, sf, "orders").createOrReplaceTempView("orders_v")
    return io.query(
        spark,
        "SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS n_orders FROM orders_v "
        "WHERE o_orderstatus = :status AND o_totalprice > :min_price GROUP BY o_orderpriority",
        {"status": "F", "min_price": 100000.0},
    )


def table_scan(spark, sf):
    return io.table_scan(spark, f"{sf.rstrip('/')}/region.parquet")


def row_by_key(spark, sf):
    n = t(spark, sf, "nation")
    return marts.row_by_key(n, F.col("n_name") == "NATION_7", [F.col("n_nationkey")])


# ------------------------------------------------------------------ statistics

def chi_square(spark, sf):
    out = stats.chi_square(order_star(spark, sf), "r_name", "o_orderstatus")
    return out.select(F.round("statistic", 6).alias("statistic"), "dof", "n", F.round("p_value", 6).alias("p_value"), "verdict")


def expected_counts(spark, sf):
    """Observed and expected counts of the region x status table."""
    out = stats.expected_counts(order_star(spark, sf), "r_name", "o_orderstatus")
    return out.select("r_name", "o_orderstatus", "observed", F.round("expected", 6).alias("expected"))


def welch_t(spark, sf):
    star = order_star(spark, sf).withColumn("price", F.col("cost").cast("double"))
    out = stats.welch_t(star, "c_mktsegment", "price", GOVT, PRIVATE)
    return out.select(
        "n_a", "n_b", F.round("mean_a", 4).alias("mean_a"), F.round("mean_b", 4).alias("mean_b"),
        F.round("t_statistic", 6).alias("t_statistic"), F.round("dof", 4).alias("dof"),
        F.round("p_value", 6).alias("p_value"), "verdict",
    )


def pearson(spark, sf):
    li = t(spark, sf, "lineitem")
    out = stats.pearson(li, "l_quantity", "l_extendedprice")
    return out.select("n", F.round("r", 6).alias("r"), F.round("p_value", 6).alias("p_value"), "verdict")


def trend_line(spark, sf):
    prof = _group_profile(spark, sf).withColumn("rate", X.parse_pct(F.col("success_rate")))
    _, line = stats.trend_line(prof, "total_missions", "rate")
    return line.select("i", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


def box_stats(spark, sf):
    out = stats.box_stats(t(spark, sf, "events"), "event_type", "value")
    return out.select(
        "event_type", "n", *[F.round(c, 6).alias(c) for c in ["q1", "median", "q3", "whisker_low", "whisker_high"]], "n_outliers"
    )


def kde(spark, sf):
    out = stats.kde(t(spark, sf, "events"), "event_type", "value")
    return out.select("event_type", "i", F.round("x", 6).alias("x"), F.round("density", 9).alias("density"))


def histogram(spark, sf):
    out = stats.histogram(t(spark, sf, "lineitem"), "l_extendedprice", 50)
    return out.select("bin", F.round("bin_start", 6).alias("bin_start"), F.round("bin_end", 6).alias("bin_end"), "count")


def histogram_by_group(spark, sf):
    out = stats.histogram(t(spark, sf, "events"), "value", 40, group_col="event_type")
    return out.select("event_type", "bin", F.round("bin_start", 6).alias("bin_start"), F.round("bin_end", 6).alias("bin_end"), "count")


def point_feed(spark, sf):
    e = t(spark, sf, "events")
    return stats.point_feed(e, ["event_id", "event_type", "value"], F.col("event_type").isin("click", "view"))


def significance(spark, sf):
    """T9 alone: verdicts of the three tests side by side."""
    c = chi_square(spark, sf).select(F.lit("chi_square").alias("test"), "p_value")
    w = welch_t(spark, sf).select(F.lit("welch_t").alias("test"), "p_value")
    p = pearson(spark, sf).select(F.lit("pearson").alias("test"), "p_value")
    return c.unionByName(w).unionByName(p).withColumn("verdict", verdict(F.col("p_value")))


# ------------------------------------------------------------------ sinks (rows-only checks)

def _scratch(spark: SparkSession, name: str) -> str:
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/tessera-{name}-{uuid.uuid4().hex}"


def csv_roundtrip(spark, sf):
    """Orders written as a raw CSV with messy headers and sentinels, read back as strings, cleaned."""
    o = t(spark, sf, "orders")
    raw = o.select(
        F.col("o_orderkey").cast("string").alias(" Order Key"),
        _raw_priority(F.col("o_orderkey"), F.col("o_orderpriority")).alias("Order Priority"),
        _raw_number(F.col("o_orderkey"), F.col("o_totalprice")).alias("Total Price"),
        _raw_date(F.col("o_orderkey"), F.col("o_orderdate")).alias("Order Date"),
    )
    path = _scratch(spark, "csv")
    raw.write.mode("overwrite").option("header", True).csv(path)
    back = X.normalize_columns(io.read_raw_csv(spark, path))
    back = X.clean_text_columns(back)
    return back.select(
        F.col("order_key").cast("bigint").alias("order_key"), "order_priority",
        N.to_number(F.col("total_price")).alias("total_price"), D.parse_date(F.col("order_date")).alias("order_date"),
    )


# The constraints of the tables that ``refresh_tables`` loads.
CONSTRAINTS = {
    "dim_date": schema.TableConstraints(primary_key=("date_id",), unique=(("full_date",),), not_null=("full_date", "year", "decade"),
                                        ranges={"quarter": (1, 4), "month": (1, 12)}),
    "dim_nation": schema.TableConstraints(primary_key=("nation_id",), not_null=("n_name",), max_length={"n_name": 255}),
    "dim_pair": schema.TableConstraints(primary_key=("pair_id",), unique=(("destination", "category"),)),
    "dim_order_meta": schema.TableConstraints(primary_key=("o_orderkey",), max_length={"o_orderpriority": 20}),
    # No key: the given lines repeat (l_orderkey, l_linenumber), as ``pk_violations`` shows.
    "fact_lines": schema.TableConstraints(
        primary_key=(), ranges={"cost": (0, 10**10)},
        foreign_keys=(
            schema.ForeignKey("nation_id", "dim_nation", "nation_id"), schema.ForeignKey("pair_id", "dim_pair", "pair_id"),
            schema.ForeignKey("order_date_id", "dim_date", "date_id"), schema.ForeignKey("ship_date_id", "dim_date", "date_id"),
            schema.ForeignKey("l_orderkey", "dim_order_meta", "o_orderkey"),
        )),
    "bridge_items": schema.TableConstraints(primary_key=("id",), not_null=("doc_id", "item")),
    "bridge_answers": schema.TableConstraints(primary_key=("id",), not_null=("item_id", "part")),
}


def refresh_tables(spark, sf):
    """Three dimensions, meta dimension, fact and two bridges written as one
    version, gated by every declared constraint; returns the health check of
    what readers see after the commit."""
    dims = _dims(spark, sf)
    tables = {
        "dim_date": dims["date"],
        "dim_nation": dims["nation"],
        "dim_pair": dims["pair"],
        "dim_order_meta": meta_dim(spark, sf),
        "fact_lines": _fact(spark, sf, dims),
        "bridge_items": bridge_explode(spark, sf),
        "bridge_answers": model.bridge(t(spark, sf, "benchmark"), "item_id", "text", "part"),
    }
    root = _scratch(spark, "warehouse")
    gate = lambda written: missions.refuse_violations(missions.constraint_report(written, CONSTRAINTS))
    sink.refresh_tables(tables, root, order=list(CONSTRAINTS), gate=gate)
    return quality.health_check(sink.read_tables(spark, root, list(CONSTRAINTS)))


def load_counters(spark, sf):
    """Q7: rows read, kept and dropped, observed while the flagged rows are written."""
    flagged = filters.flag_rejects(_customer_nation_orders(spark, sf), "n_name", "o_orderdate", FIRST_YEAR)
    reason = F.col("reject_reason")
    _, counts = quality.observed_counters(flagged, {
        "rows_before": F.lit(True), "rows_kept": reason.isNull(), "rows_dropped": reason.isNotNull(),
        "unknown_key": reason == "unknown_key", "before_reference": reason == "before_reference",
    }, "flagged")
    return counts


def health_overall(spark, sf):
    """Q8: one row and one flag over the health check of all tables."""
    return quality.overall_health(health_check(spark, sf))


ORDER_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType(), False), T.StructField("o_orderdate", T.DateType()),
    T.StructField("o_totalprice", T.DecimalType(12, 2)), T.StructField("o_orderpriority", T.StringType()),
])


def conform_orders(spark, sf):
    """The orders in their declared schema (a value that does not fit would fail the job)."""
    out = schema.conform(t(spark, sf, "orders"), ORDER_SCHEMA)
    return out.withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


def schema_refusals(spark, sf):
    """How many values of the raw text columns the declared schema refuses."""
    o = t(spark, sf, "orders")
    raw = o.select(
        "o_orderkey", _raw_number(F.col("o_orderkey"), F.col("o_totalprice")).alias("raw_cost"),
        _raw_date(F.col("o_orderkey"), F.col("o_orderdate")).alias("raw_date"),
    )
    declared = T.StructType([
        T.StructField("o_orderkey", T.LongType()), T.StructField("raw_cost", T.DecimalType(12, 2)), T.StructField("raw_date", T.DateType()),
    ])
    return schema.refusals(raw, declared)


def catalog_views(spark, sf):
    """The three views created in the catalog as SQL over the table files, then read by name."""
    f = {n: f"parquet.`{sf.rstrip('/')}/{n}.parquet`" for n in ("orders", "customer", "nation", "region", "part", "lineitem")}
    price = "CAST(round(avg(CAST({} AS decimal(12,2))), 2) AS double) AS avg_price"
    names = sink.create_views(spark, {
        "tessera_group_summary": f"""
            SELECT n_name, r_name, c_mktsegment, count(o_orderkey) AS total_orders, {price.format('o_totalprice')}
            FROM {f['orders']} JOIN {f['customer']} ON o_custkey = c_custkey JOIN {f['nation']} ON c_nationkey = n_nationkey
            JOIN {f['region']} ON n_regionkey = r_regionkey GROUP BY ALL""",
        "tessera_yearly_trend": f"""
            SELECT year(o_orderdate) AS year, concat(year(o_orderdate) DIV 10 * 10, 's') AS decade, count(o_orderkey) AS total_orders,
                   {price.format('o_totalprice')}
            FROM {f['orders']} WHERE o_orderdate IS NOT NULL GROUP BY ALL""",
        "tessera_destination_summary": f"""
            SELECT if(p_size > 45, NULL, p_brand) AS destination, if(p_size < 5, NULL, p_type) AS category, count(l_orderkey) AS total_orders,
                   {price.format('l_extendedprice')}
            FROM {f['lineitem']} JOIN {f['part']} ON l_partkey = p_partkey GROUP BY ALL""",
    })
    group, year, place = names
    return spark.sql(f"""
        SELECT 'group' AS view_name, n_name AS k1, r_name AS k2, c_mktsegment AS k3, total_orders, avg_price FROM {group}
        UNION ALL SELECT 'year', CAST(year AS string), decade, NULL, total_orders, avg_price FROM {year}
        UNION ALL SELECT 'destination', destination, category, NULL, total_orders, avg_price FROM {place}""")


def views(spark, sf):
    """Marts registered as temporary views and queried by name."""
    marts.status_summary(
        order_star(spark, sf), ["n_name", "r_name", "c_mktsegment"], "o_orderstatus", STATUSES, SUCCESS, "cost",
        id_col="o_orderkey",
    ).createOrReplaceTempView("vw_group_summary")
    return spark.sql("SELECT n_name, r_name, c_mktsegment, total_missions, success_rate_pct FROM vw_group_summary")


QUERIES = {
    name: globals()[name]
    for name in [
        "group_summary", "yearly_trend", "destination_summary", "group_profile", "region_profile",
        "decade_type_profile", "category_profile", "category_period_pivot", "contingency", "group_median",
        "overview", "distinct_where", "value_counts", "value_share", "value_counts_multi", "share_kpis",
        "two_sample_overview", "describe_all", "describe_percentiles", "schema_report",
        "clean_sentinels", "parse_dates", "calendar_attributes", "parse_duration", "parse_numeric",
        "lookup_validity_filter", "rejects", "temporal_violations", "range_notnull_filter", "dropna",
        "dim_date", "dim_group", "dim_pair", "ship_days_without_orders", "fact_build", "meta_dim", "bridge_explode", "bridge_counts",
        "star_wide", "star_wide_meta",
        "pk_violations", "fk_violations", "unresolved_keys", "check_violations", "length_violations",
        "domain_violations", "parse_counters", "health_check", "duplicate_counts", "duplicate_rows", "null_profile",
        "sql_params", "table_scan", "row_by_key",
        "chi_square", "expected_counts", "welch_t", "pearson", "trend_line", "box_stats", "kde", "histogram", "histogram_by_group",
        "point_feed", "significance",
        "csv_roundtrip", "refresh_tables", "views", "catalog_views", "conform_orders", "schema_refusals", "load_counters", "health_overall",
    ]
}
