"""The declared star schema and its constraints.

One ``StructType`` per warehouse table plus the constraints the relational
DDL enforced (keys, references, not-null, ranges, lengths, precision). The
constraints are data here: :mod:`tessera.operators.quality` turns them into
checks that return offending rows as tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S = T.StringType()
L = T.LongType()
SH = T.ShortType()


def _f(name, typ, nullable=True):
    return T.StructField(name, typ, nullable)


DIM_DATE = T.StructType([
    _f("date_id", L, False), _f("full_date", T.DateType(), False), _f("year", SH, False),
    _f("quarter", SH, False), _f("month", SH, False), _f("month_name", S, False),
    _f("week", SH, False), _f("day", SH, False), _f("decade", S, False),
])
DIM_AGENCY = T.StructType([
    _f("agency_id", L, False), _f("agency_name", S, False), _f("country_region", S), _f("agency_type", S),
])
DIM_LAUNCH = T.StructType([_f("launch_id", L, False), _f("launch_vehicle", S), _f("launch_site", S)])
DIM_MISSION_META = T.StructType([
    _f("mission_id", S, False), _f("mission_name", S), _f("objective", S), _f("key_achievement", S),
    _f("mission_outcome_detail", S), _f("reference_url", S),
])
FACT_MISSIONS = T.StructType([
    _f("mission_id", S, False), _f("agency_id", L), _f("launch_id", L), _f("launch_date_id", L),
    _f("end_date_id", L), _f("program_type", S), _f("mission_category", S), _f("sub_category", S),
    _f("destination", S), _f("status", S), _f("mission_phase", S), _f("crew_type", S),
    _f("data_returned", S), _f("failure_reason", S), _f("cost_usd_billion", T.DecimalType(12, 2)),
    _f("duration_days", T.DecimalType(10, 2)),
])
BRIDGE_CREW = T.StructType([_f("id", L, False), _f("mission_id", S, False), _f("crew_member", S, False)])
BRIDGE_PARTNERS = T.StructType([_f("id", L, False), _f("mission_id", S, False), _f("partner_agency", S, False)])

SCHEMAS: dict[str, T.StructType] = {
    "dim_date": DIM_DATE,
    "dim_agency": DIM_AGENCY,
    "dim_launch": DIM_LAUNCH,
    "dim_mission_meta": DIM_MISSION_META,
    "fact_missions": FACT_MISSIONS,
    "bridge_crew": BRIDGE_CREW,
    "bridge_partners": BRIDGE_PARTNERS,
}

# Dependency order for loading: parents before children.
LOAD_ORDER = [
    "dim_date", "dim_agency", "dim_launch", "dim_mission_meta", "fact_missions", "bridge_crew", "bridge_partners",
]


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_key: str


@dataclass(frozen=True)
class TableConstraints:
    primary_key: tuple[str, ...]
    unique: tuple[tuple[str, ...], ...] = ()
    not_null: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    # column -> (low, high) inclusive
    ranges: dict = field(default_factory=dict)
    # column -> max characters (VARCHAR(n))
    max_length: dict = field(default_factory=dict)
    # column -> (precision, scale) (DECIMAL(p, s))
    precision: dict = field(default_factory=dict)


# The constraints of the warehouse DDL.
CONSTRAINTS: dict[str, TableConstraints] = {
    "dim_date": TableConstraints(
        primary_key=("date_id",), unique=(("full_date",),),
        not_null=("full_date", "year", "quarter", "month", "month_name", "week", "day", "decade"),
        ranges={"quarter": (1, 4), "month": (1, 12)},
        max_length={"month_name": 10, "decade": 10},
    ),
    "dim_agency": TableConstraints(
        primary_key=("agency_id",), not_null=("agency_name",),
        max_length={"agency_name": 255, "country_region": 255, "agency_type": 50},
    ),
    "dim_launch": TableConstraints(
        primary_key=("launch_id",), max_length={"launch_vehicle": 255, "launch_site": 255},
    ),
    "dim_mission_meta": TableConstraints(
        primary_key=("mission_id",), max_length={"mission_id": 20, "mission_name": 500},
    ),
    "fact_missions": TableConstraints(
        primary_key=("mission_id",),
        foreign_keys=(
            ForeignKey("agency_id", "dim_agency", "agency_id"),
            ForeignKey("launch_id", "dim_launch", "launch_id"),
            ForeignKey("launch_date_id", "dim_date", "date_id"),
            ForeignKey("end_date_id", "dim_date", "date_id"),
        ),
        max_length={
            "mission_id": 20, "program_type": 100, "mission_category": 100, "sub_category": 100,
            "destination": 255, "status": 50, "mission_phase": 20, "crew_type": 20, "data_returned": 20,
        },
        precision={"cost_usd_billion": (12, 2), "duration_days": (10, 2)},
    ),
    "bridge_crew": TableConstraints(
        primary_key=("id",), not_null=("mission_id", "crew_member"),
        foreign_keys=(ForeignKey("mission_id", "fact_missions", "mission_id"),),
        max_length={"mission_id": 20, "crew_member": 255},
    ),
    "bridge_partners": TableConstraints(
        primary_key=("id",), not_null=("mission_id", "partner_agency"),
        foreign_keys=(ForeignKey("mission_id", "fact_missions", "mission_id"),),
        max_length={"mission_id": 20, "partner_agency": 255},
    ),
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project and cast ``df`` to ``schema`` (column order and types).

    A value that does not fit its column fails the job, as the database would
    refuse the row; check the constraints on the unconformed tables first to
    get such values reported instead.
    """
    cols: list[Column] = []
    for f in schema.fields:
        if f.name not in df.columns:
            raise ValueError(f"missing column {f.name!r} for schema; have {df.columns}")
        value = F.col(f.name)
        if df.schema[f.name].dataType != f.dataType:
            cast = value.try_cast(f.dataType)
            refused = F.raise_error(F.concat(F.lit(f"{f.name} does not fit {f.dataType.simpleString()}: "), value.cast("string")))
            value = F.when(value.isNotNull() & cast.isNull(), refused.cast(f.dataType)).otherwise(cast)
        cols.append(value.alias(f.name))
    return df.select(*cols)


def refusals(df: DataFrame, schema: T.StructType) -> DataFrame:
    """(column_name, data_type, n_values, n_refused): for every declared column, how many
    values ``df`` has and how many of them :func:`conform` would refuse. One pass."""
    counts = []
    for i, f in enumerate(schema.fields):
        value = F.col(f.name)
        refused = value.isNotNull() & value.try_cast(f.dataType).isNull()
        counts += [F.count(value).alias(f"_n{i}"), F.count_if(refused).alias(f"_r{i}")]
    row = df.agg(*counts)
    listed = F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                                F.col(f"_n{i}").alias("n_values"), F.col(f"_r{i}").alias("n_refused")) for i, f in enumerate(schema.fields)])
    return row.select(F.inline(listed))
