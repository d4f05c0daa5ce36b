"""The mission ETL as a configuration of the operators.

raw CSV (S1) -> names (P1) -> sentinels (P2) -> dates (P3) -> founding-date
filter (P7 + F1) -> duration (P4) -> cost (P5 + P6) -> domain report (Q6)
-> dimensions (D1-D3), fact (D4: J1-J3), bridges (D6-D8), meta (D5)
-> constraint checks (Q1-Q5) -> refresh (S4) -> health (Q8).

Order matters as in the reference: names before types, sentinels before
dates, the founding filter before the duration and cost parsing (so the
parse counters cover surviving rows only).

The cleaned frame feeds seven outputs, so it is staged once as a parquet
table in the shared checkpoint folder: lineage is cut, a lost executor
re-reads the staged table instead of re-parsing the CSV, and each output
reads only the columns it needs.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import numbers as N
from ..functions import text as X
from ..operators import filters, marts, model, quality
from ..operators.staging import stage_table
from ..sources import io, schema, sink

log = logging.getLogger(__name__)

# Agency founding years used by the validity filter.
AGENCY_FOUNDING_YEAR = {
    "NASA": 1958,
    "CNES": 1961,
    "ISRO": 1969,
    "ESA": 1975,
    "ASI": 1988,
    "CSA": 1989,
    "Roscosmos": 1992,
    "CNSA": 1993,
    "DLR": 1997,
    "Blue Origin": 2000,
    "SpaceX": 2002,
    "JAXA": 2003,
}

# Allowed categorical values (NULL allowed everywhere).
ALLOWED_VALUES = {
    "status": ["Success", "Failed", "Partial Success", "Ongoing", "Upcoming"],
    "mission_phase": ["Past", "Ongoing", "Future"],
    "crew_type": ["Crewed", "Uncrewed"],
    "data_returned": ["Yes", "No", "Partial"],
}

FACT_COLUMNS = [
    "mission_id", "agency_id", "launch_id", "launch_date_id", "end_date_id",
    "program_type", "mission_category", "sub_category", "destination",
    "status", "mission_phase", "crew_type", "data_returned",
    "failure_reason", "cost_usd_billion", "duration_days",
]
META_COLUMNS = ["mission_id", "mission_name", "objective", "key_achievement", "mission_outcome_detail", "reference_url"]


@dataclass
class Cleaned:
    frame: DataFrame
    rejects: DataFrame
    counters: DataFrame
    domain_report: DataFrame


def _item_count(col: str):
    return F.coalesce(F.size(X.split_list(F.col(col), r",\s*")), F.lit(0))


def clean(raw: DataFrame) -> Cleaned:
    """P1-P6, F1 and the Q6/Q7 reports over the raw string table.

    Kept and rejected rows are staged together in one pass over the raw rows. The
    run's counters (Q7: rows read, kept and dropped, what was parsed; D7/D8:
    crewed and collaborative missions) are observed while that table is written,
    so they cost no scan. Every rejected row keeps its reason.
    """
    df = X.normalize_columns(raw)
    df = X.clean_text_columns(df)
    df = df.withColumn("launch_date", D.parse_date(F.col("launch_date"))).withColumn(
        "end_date", D.parse_date(F.col("end_date"))
    )
    df = filters.flag_rejects(df, "agency", "launch_date", AGENCY_FOUNDING_YEAR, "_reject")
    df = N.with_duration_days(df, "duration", "duration_days")
    df = df.withColumn("cost_usd_billion", N.rescale(N.to_number(F.col("cost_usd_million")), 1000)).drop("cost_usd_million")
    ok = F.col("_reject").isNull()
    counts = {
        "rows_before": F.lit(True),
        "rows_kept": ok,
        "rows_dropped": ~ok,
        "duration_parsed": ok & F.col("duration_days").isNotNull(),
        "duration_failed": ok & F.col("duration_days").isNull(),
        "cost_missing": ok & F.col("cost_usd_billion").isNull(),
        "crewed_missions": ok & (_item_count("crew_members") > 0),
        "collaborative_missions": ok & (_item_count("partner_agencies") > 0),
    }
    staged, counters = quality.observed_counters(df, counts, "cleaned")
    kept = staged.where(ok).drop("_reject")
    # Rejects as they were read: what is parsed behind the filter is not theirs.
    rejects = staged.where(~ok).drop("duration_days", "cost_usd_billion").withColumnRenamed("_reject", "reject_reason")
    return Cleaned(kept, rejects, counters, quality.domain_violations(kept, ALLOWED_VALUES))


def model_tables(cleaned: DataFrame) -> dict[str, DataFrame]:
    """The seven warehouse tables, before they are cast to the declared schema."""
    dim_date = model.date_dimension(cleaned, ["launch_date", "end_date"])
    dim_agency = model.distinct_dimension(
        cleaned, ["agency", "country_region", "agency_type"], "agency_id",
        rename={"agency": "agency_name"}, required=["agency"],
    )
    dim_launch = model.distinct_dimension(cleaned, ["launch_vehicle", "launch_site"], "launch_id")
    fact = model.lookup_key(cleaned, dim_agency, ["agency"], ["agency_name"], "agency_id")
    fact = model.lookup_key(
        fact, dim_launch, ["launch_vehicle", "launch_site"], ["launch_vehicle", "launch_site"], "launch_id",
        null_safe=True,
    )
    fact = model.role_playing_keys(fact, dim_date, {"launch_date_id": "launch_date", "end_date_id": "end_date"})
    fact = model.project(fact, FACT_COLUMNS)
    return {
        "dim_date": dim_date,
        "dim_agency": dim_agency,
        "dim_launch": dim_launch,
        "dim_mission_meta": model.project(cleaned, META_COLUMNS),
        "fact_missions": fact,
        "bridge_crew": model.bridge(cleaned, "mission_id", "crew_members", "crew_member"),
        "bridge_partners": model.bridge(cleaned, "mission_id", "partner_agencies", "partner_agency"),
    }


def conform_tables(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables cast to the declared schema."""
    return {name: schema.conform(df, schema.SCHEMAS[name]) for name, df in tables.items()}


def build_tables(cleaned: DataFrame) -> dict[str, DataFrame]:
    """The seven warehouse tables, conformed to the declared schema."""
    return conform_tables(model_tables(cleaned))


def constraint_report(tables: dict[str, DataFrame], constraints: dict[str, schema.TableConstraints] | None = None) -> DataFrame:
    """Q1, Q2, Q4, Q5 over all tables as one long table: (table_name, rule, column_name, n_violations).

    ``constraints`` are those of the mission warehouse by default."""
    parts = []
    for name, c in (constraints or schema.CONSTRAINTS).items():
        if name not in tables:
            continue
        df = tables[name]
        if c.primary_key:
            pk = quality.pk_violations(df, list(c.primary_key)).agg(F.count(F.lit(1)).cast("bigint").alias("n_violations"))
            parts.append(pk.select(F.lit(name).alias("table_name"), F.lit("primary_key").alias("rule"),
                                   F.lit(",".join(c.primary_key)).alias("column_name"), "n_violations"))
        for cols in c.unique:
            known = df.na.drop(subset=list(cols))
            repeats = quality.pk_violations(known, list(cols)).agg(F.count(F.lit(1)).cast("bigint").alias("n_violations"))
            parts.append(repeats.select(F.lit(name).alias("table_name"), F.lit("unique").alias("rule"),
                                        F.lit(",".join(cols)).alias("column_name"), "n_violations"))
        for fk in c.foreign_keys:
            if fk.parent not in tables:
                continue
            orphans = quality.fk_violations(df, fk.column, tables[fk.parent], fk.parent_key).agg(
                F.count(F.lit(1)).cast("bigint").alias("n_violations")
            )
            parts.append(orphans.select(F.lit(name).alias("table_name"), F.lit("foreign_key").alias("rule"),
                                        F.lit(fk.column).alias("column_name"), "n_violations"))
        rules = quality.table_constraint_violations(df, c)
        parts.append(rules.select(F.lit(name).alias("table_name"), "rule", "column_name", "n_violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def refuse_violations(report: DataFrame) -> None:
    """Raise if a constraint report holds a violation; at most five are named."""
    bad = report.where("n_violations > 0").orderBy("table_name", "rule", "column_name").limit(5).collect()
    if bad:
        raise ValueError(f"constraints violated: {[tuple(r) for r in bad]}")


def unresolved(fact: DataFrame) -> DataFrame:
    """Q3: lookups that found no key."""
    return quality.unresolved_keys(fact, ["agency_id", "launch_id", "launch_date_id"])


STATUS_COUNTS = {
    "successful_missions": "Success", "failed_missions": "Failed", "partial_missions": "Partial Success",
    "ongoing_missions": "Ongoing", "upcoming_missions": "Upcoming",
}


def agency_summary_view(tables: dict[str, DataFrame]) -> DataFrame:
    """Fact inner-joined to agencies, per agency/country/type."""
    f = tables["fact_missions"]
    a = tables["dim_agency"]
    j = model.inner_lookup(f, a.withColumnRenamed("agency_id", "_aid"), "agency_id", "_aid")
    return marts.status_summary(
        j, ["agency_name", "country_region", "agency_type"], "status", STATUS_COUNTS, "Success", "cost_usd_billion",
        extra_counts={"crewed_missions": F.col("crew_type") == "Crewed"}, id_col="mission_id",
    )


def yearly_trend_view(tables: dict[str, DataFrame]) -> DataFrame:
    """Fact inner-joined to the launch date, per year and decade, by year."""
    d = tables["dim_date"].select(F.col("date_id").alias("_did"), "year", "decade")
    j = model.inner_lookup(tables["fact_missions"], d, "launch_date_id", "_did")
    return marts.status_summary(
        j, ["year", "decade"], "status", {"successes": "Success", "failures": "Failed"}, "Success", "cost_usd_billion",
        extra_counts={"crewed_missions": F.col("crew_type") == "Crewed"}, id_col="mission_id",
        total_alias="total_launches", rate_alias=None, sum_alias=None, order_by=[F.col("year")],
    )


def destination_summary_view(tables: dict[str, DataFrame]) -> DataFrame:
    """Per destination and category (NULL groups kept), most missions first."""
    out = marts.status_summary(
        tables["fact_missions"], ["destination", "mission_category"], "status", {}, "Success", "cost_usd_billion",
        id_col="mission_id", sum_alias=None,
    )
    return marts.sort_nulls_last(out, [("total_missions", False), ("destination", True), ("mission_category", True)])


def register_views(tables: dict[str, DataFrame]) -> list[str]:
    """The three analytical views as temporary views, queryable from SQL in this session."""
    views = {
        "vw_agency_summary": agency_summary_view(tables),
        "vw_yearly_trend": yearly_trend_view(tables),
        "vw_destination_summary": destination_summary_view(tables),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)


def _status_count(alias: str, value: str) -> str:
    return f"count_if(f.status = '{value}') AS {alias}"


def view_sql(paths: dict[str, str]) -> dict[str, str]:
    """The three views as SQL over the table files at ``paths``."""
    fact, agency, date = (f"parquet.`{paths[n]}`" for n in ("fact_missions", "dim_agency", "dim_date"))
    crewed = "count_if(f.crew_type = 'Crewed') AS crewed_missions"
    rate = "round(try_divide(100.0D * count_if(f.status = 'Success'), count(f.mission_id)), 2) AS success_rate_pct"
    mean = "CAST(round(avg(f.cost_usd_billion), 2) AS double) AS avg_cost_usd_billion"
    counts = ", ".join(_status_count(a, v) for a, v in STATUS_COUNTS.items())
    yearly = ", ".join(_status_count(a, v) for a, v in {"successes": "Success", "failures": "Failed"}.items())
    return {
        "vw_agency_summary": f"""
            SELECT a.agency_name, a.country_region, a.agency_type, count(f.mission_id) AS total_missions, {counts}, {crewed}, {mean},
                   CAST(round(sum(f.cost_usd_billion), 2) AS double) AS total_cost_usd_billion, {rate}
            FROM {fact} f JOIN {agency} a ON f.agency_id = a.agency_id GROUP BY ALL""",
        "vw_yearly_trend": f"""
            SELECT d.year, d.decade, count(f.mission_id) AS total_launches, {yearly}, {crewed}, {mean}
            FROM {fact} f JOIN {date} d ON f.launch_date_id = d.date_id GROUP BY ALL ORDER BY d.year""",
        "vw_destination_summary": f"""
            SELECT f.destination, f.mission_category, count(f.mission_id) AS total_missions, {mean}, {rate}
            FROM {fact} f GROUP BY ALL
            ORDER BY total_missions DESC NULLS FIRST, f.destination NULLS LAST, f.mission_category NULLS LAST""",
    }


def create_views(spark: SparkSession, out_root: str, database: str | None = None) -> list[str]:
    """The three views in the catalog, over the last committed version under
    ``out_root``. They belong to the catalog, not to the session: every session
    sees them, and with a persistent catalog (a metastore) later applications
    do. Call it after each refresh, which moves the views to the new version."""
    paths = sink.table_paths(spark, out_root, ["fact_missions", "dim_agency", "dim_date"])
    return sink.create_views(spark, view_sql(paths), database)


def _date_arm(dim_date: DataFrame, key: str, prefix: str, attrs: list[str]) -> model.DimJoin:
    cols = {f"{prefix}_date": "full_date", **{f"{prefix}_{a}": a for a in attrs}}
    return model.DimJoin(dim_date, key, "date_id", cols)


# By launch date as the reference's loaders; the mission id breaks ties, which
# also lets a date holding many rows be split across range partitions.
def wide_order() -> list:
    return [F.col("launch_date").asc_nulls_last(), F.col("mission_id")]

WIDE_FACT_COLUMNS = [
    "mission_id", "program_type", "mission_category", "sub_category", "destination", "status", "mission_phase",
    "crew_type", "data_returned", "failure_reason", "cost_usd_billion", "duration_days",
]


def missions_full(tables: dict[str, DataFrame]) -> DataFrame:
    """The wide mission table without narrative columns, by launch date (NULLs last)."""
    arms = [
        model.DimJoin(tables["dim_agency"], "agency_id", "agency_id",
                      {"agency_name": "agency_name", "country_region": "country_region", "agency_type": "agency_type"}),
        model.DimJoin(tables["dim_launch"], "launch_id", "launch_id",
                      {"launch_vehicle": "launch_vehicle", "launch_site": "launch_site"}),
        _date_arm(tables["dim_date"], "launch_date_id", "launch", ["year", "quarter", "month", "decade"]),
        _date_arm(tables["dim_date"], "end_date_id", "end", ["year", "quarter", "month", "decade"]),
    ]
    return model.star_join(tables["fact_missions"], WIDE_FACT_COLUMNS, arms, order_by=wide_order())


def missions_with_meta(tables: dict[str, DataFrame]) -> DataFrame:
    """As :func:`missions_full` plus the narrative columns of the meta dimension."""
    arms = [
        model.DimJoin(tables["dim_agency"], "agency_id", "agency_id",
                      {"agency_name": "agency_name", "country_region": "country_region", "agency_type": "agency_type"}),
        model.DimJoin(tables["dim_launch"], "launch_id", "launch_id",
                      {"launch_vehicle": "launch_vehicle", "launch_site": "launch_site"}),
        _date_arm(tables["dim_date"], "launch_date_id", "launch", ["year", "decade"]),
        _date_arm(tables["dim_date"], "end_date_id", "end", ["year", "decade"]),
        model.DimJoin(tables["dim_mission_meta"], "mission_id", "mission_id", {
            "mission_name": "mission_name", "objective": "objective", "key_achievement": "key_achievement",
            "mission_outcome_detail": "mission_outcome_detail", "reference_url": "reference_url",
        }, large=True),
    ]
    return model.star_join(tables["fact_missions"], WIDE_FACT_COLUMNS, arms, order_by=wide_order())


def run(spark: SparkSession, csv_path: str, out_root: str) -> dict[str, DataFrame]:
    """The whole ETL: read, clean, model, check, refresh; returns the reports.

    The refresh only happens when no declared constraint is violated (the
    database would have refused the load). The constraints are checked before
    the values are cast, so nothing is nulled on the way.
    """
    raw = io.read_raw_csv(spark, csv_path)
    c = clean(raw)
    # Staged, as the checks read every table several times.
    tables = {name: stage_table(df, name) for name, df in model_tables(c.frame).items()}
    report = stage_table(constraint_report(tables), "constraints")
    refuse_violations(report)
    paths = sink.refresh_tables(conform_tables(tables), out_root)
    landed = sink.read_tables(spark, out_root, list(paths))
    health = stage_table(quality.health_check(landed), "health")
    return {
        "counters": c.counters,
        "domain_report": c.domain_report,
        "rejects": c.rejects,
        "constraints": report,
        "unresolved": unresolved(landed["fact_missions"]),
        "health": health,
        "healthy": quality.overall_health(health),
    }


def main(argv: list[str] | None = None) -> None:
    """``python -m tessera.plans.missions <csv> <warehouse_dir>``: run the ETL and print its reports."""
    import argparse

    from ..session import get_session

    ap = argparse.ArgumentParser(description="Load the mission CSV into a checked star schema.")
    ap.add_argument("csv", help="CSV file or folder (header row, 26 columns)")
    ap.add_argument("warehouse", help="output folder for the seven tables")
    ap.add_argument("--master", default=None, help="Spark master for a local run, e.g. local[8]")
    args = ap.parse_args(argv)
    spark = get_session(args.master, app_name="tessera-missions")
    reports = run(spark, args.csv, args.warehouse)
    for name in ("counters", "domain_report", "unresolved", "health", "healthy"):
        print(f"== {name}")
        reports[name].show(truncate=False)


if __name__ == "__main__":
    main()
