"""The reference's two notebooks as DataFrames over the mission warehouse.

:func:`cleaning_report` covers the data-cleaning notebook (schema, summary,
percentiles, duplicates, nulls, categorical counts, histograms, temporal
violations); :func:`eda_report` the exploratory one (landscape, agency and
country profiles, chi-square, government vs private, categories, cost and
duration distributions, key findings). Every entry is a lazy DataFrame; the
charts the notebooks draw are left to the caller, these are their tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import filters, marts, quality, stats
from . import missions

STATUS_PROFILE = {
    "successful_missions": "Success", "failed_missions": "Failed", "upcoming_missions": "Upcoming",
    "ongoing_missions": "Ongoing", "partially_successful_missions": "Partial Success",
}
CATEGORICALS = ["status", "mission_phase", "crew_type", "agency_type", "program_type", "mission_category", "data_returned"]
TYPES = ["Government", "Private"]


def cleaning_report(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    wide = missions.missions_with_meta(tables)
    nums = ["cost_usd_billion", "duration_days"]
    return {
        "preview": marts.top_n(wide, missions.wide_order(), 5),
        "schema": marts.schema_report(wide),
        "describe": marts.describe_all(wide),
        "percentiles": marts.describe_percentiles(wide, nums),
        "duplicate_counts": quality.duplicate_counts(wide, ["mission_name", "mission_id"]),
        "duplicate_names": quality.duplicate_rows(wide, "mission_name", 10, tie_break=["mission_id"]),
        "null_profile": quality.null_profile(wide),
        "categorical_counts": marts.value_counts_multi(wide, CATEGORICALS),
        "cost_histogram": stats.histogram(wide, "cost_usd_billion", 50),
        "duration_histogram": stats.histogram(wide, "duration_days", 50),
        "temporal_violations": filters.order_violations(wide, "launch_date", "end_date"),
    }


def eda_report(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    df = missions.missions_full(tables)
    profile = marts.group_profile(
        df, "agency_name", "status", STATUS_PROFILE, "Success", "cost_usd_billion", "duration_days", "agency_type",
        flag_counts={"crewed_missions": F.col("crew_type") == "Crewed"}, min_total=5,
    )
    gvp = filters.where_in(df, "agency_type", TYPES)
    durations = filters.not_null_below(gvp, "duration_days", 5000)
    trend_fit, trend_points = stats.trend_line(
        profile.withColumn("success_rate_num", X.parse_pct(F.col("success_rate"))), "total_missions", "success_rate_num"
    )
    out = {
        "overview": marts.overview(
            df, ["agency_name", "country_region"], ["launch_year"],
            flags={"crewed": F.col("crew_type") == "Crewed", "uncrewed": F.col("crew_type") == "Uncrewed"},
            count_alias="total_missions",
        ),
        "status_share": marts.value_share(df, "status"),
        "status_counts": marts.value_counts(df, "status"),
        "agency_profile": profile,
        "agency_trend_fit": trend_fit,
        "agency_trend_line": trend_points,
        "country_profile": marts.rate_profile(
            df, ["country_region"], "status", {"success_rate": "Success"}, "cost_usd_billion",
            counts={"govt_missions": F.col("agency_type") == "Government",
                    "private_missions": F.col("agency_type") == "Private"},
            shares={"private_pct": "private_missions"}, order_by=[F.col("total_missions").desc()],
            id_col="mission_id",
        ),
        "country_status_table": marts.contingency(df, "country_region", "status"),
        "country_status_test": stats.chi_square(df, "country_region", "status"),
        "decade_type": marts.rate_profile(
            df, ["launch_decade", "agency_type"], "status", {"success_rate": "Success"}, "cost_usd_billion",
            total_alias="missions", avg_alias="avg_cost", decimals=None, id_col="mission_id",
        ),
        "cost_by_type": marts.two_sample_overview(df, "agency_type", "cost_usd_billion", TYPES),
        "cost_type_box": stats.box_stats(gvp, "agency_type", "cost_usd_billion"),
        "cost_type_points": stats.point_feed(gvp, ["agency_type", "cost_usd_billion"]),
        "cost_type_test": stats.welch_t(df, "agency_type", "cost_usd_billion", *TYPES),
        "category_profile": marts.rate_profile(
            df, ["mission_category"], "status", {"success_rate": "Success", "failure_rate": "Failed"},
            "cost_usd_billion", order_by=[F.col("total_missions").desc()], rate_decimals=None, id_col="mission_id",
        ),
        "category_median_cost": marts.group_median(df, "mission_category", "cost_usd_billion", "median_cost"),
        "category_cost_density": stats.kde(df, "mission_category", "cost_usd_billion"),
        "cost_duration_test": stats.pearson(df, "cost_usd_billion", "duration_days"),
        "duration_by_type": stats.histogram(durations, "duration_days", 40, group_col="agency_type"),
    }
    out["category_decade"] = marts.pivot_counts(df, "mission_category", "launch_decade")
    out["key_findings"] = marts.share_kpis(
        df, "agency_name", "NASA", "status", "Success", "cost_usd_billion",
        {
            "govt_success_rate": F.col("agency_type") == "Government",
            "private_success_rate": F.col("agency_type") == "Private",
            "mars_success_rate": F.col("mission_category") == "Mars",
            "earth_orbit_success_rate": F.col("mission_category") == "Earth Orbit",
        },
    )
    return out
