"""Enriching trips with geography, hourly weather and county-hour air quality.

Every context side is small by construction (zones: a few hundred rows;
weather: one row per hour; air quality: counties x hours after aggregation), so
the chain of four left joins is broadcast and the fact table is never shuffled.
Each context is profiled once before the join runs (``enrich``): that proves its
non-null join keys unique, which guarantees that the fact row count cannot
change, and sizes it for the broadcast.  The write then cross-checks the count
and collects the match rates through an ``Observation`` on its result stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..contract import ContractError
from ..functions.timeops import hour_bucket
from ..operators.enrich import JoinSpec, enrich, hourly_summary, restrict_to, row_count
from ..sources.tables import DEFAULT_FORMAT, stage, staging
from ..sources.versions import save

# Local zone of the trip clocks, context columns and the join chain.
LOCAL_TIMEZONE = "America/New_York"
ZONE_COLUMNS = ("zone", "borough", "service_zone", "state_code", "county_code")
WEATHER_COLUMNS = ("temp", "rhum", "prcp", "snwd", "wdir", "wspd", "wpgt", "pres", "cldc", "coco")
TAXI_JOINS = (
    JoinSpec("zones", {"pulocation_id": "location_id"}, ZONE_COLUMNS, "pickup",
             match_column="zone", output_columns=("zone", "borough")),
    JoinSpec("zones", {"dolocation_id": "location_id"}, ZONE_COLUMNS, "dropoff",
             match_column="zone", output_columns=("zone", "borough")),
    JoinSpec("weather", {"pickup_hour": "timestamp"}, WEATHER_COLUMNS, "weather",
             match_column="temp"),
    JoinSpec("air_quality",
             {"pickup_state_code": "state_code", "pickup_county_code": "county_code",
              "pickup_hour": "hour"},
             ("measurement", "parameter_name", "units_of_measure"), "air_quality",
             match_column="measurement"),
)


def prepare_air_quality(air_quality: DataFrame, zones: DataFrame, tz: str = LOCAL_TIMEZONE) -> DataFrame:
    """Sensor rows in the zones' counties -> mean per county and local hour."""
    relevant = restrict_to(air_quality, zones, ["state_code", "county_code"])
    return hourly_summary(relevant, ["state_code", "county_code"], "timestamp_gmt", tz,
                          "sample_measurement", ["parameter_name", "units_of_measure"])


def prepare_pickup_hour(taxi: DataFrame, ts: str = "tpep_pickup_datetime",
                        out: str = "pickup_hour") -> DataFrame:
    return taxi.withColumn(out, hour_bucket(F.col(ts)))


def _air_quality_hours(tables: dict[str, DataFrame], tz: str) -> DataFrame:
    return prepare_air_quality(tables["air_quality"], tables["zones"], tz)


#: Contexts that are made from the tables before they can be joined.
DERIVED = {"air_quality": _air_quality_hours}


def context_tables(tables: dict[str, DataFrame], names, tz: str = LOCAL_TIMEZONE, derived=DERIVED,
                   keep=stage) -> dict[str, DataFrame]:
    """The named contexts.  A derived one is written down first (``keep``), so that its
    measurement and its join do not each make it."""
    return {n: keep(derived[n](tables, tz), n) if n in derived else tables[n] for n in dict.fromkeys(names)}


def _specs(joins) -> list[JoinSpec]:
    return [j if isinstance(j, JoinSpec) else JoinSpec.from_dict(j) for j in joins]


def build_integrated(tables: dict[str, DataFrame], joins=TAXI_JOINS, tz: str = LOCAL_TIMEZONE,
                     *, stage_derived: bool = True, check_keys: bool = True, keep=stage, **options) -> DataFrame:
    """Trips with their pickup hour joined through the chain; the trips' columns and
    each join's outputs remain.  ``keep`` writes derived contexts down."""
    specs = _specs(joins)
    contexts = context_tables(tables, (j.dataset for j in specs), tz, keep=keep if stage_derived else lambda df, _: df)
    wide = enrich(prepare_pickup_hour(tables["taxi"]), contexts, specs, check_keys=check_keys, **options)
    return wide.drop("pickup_hour") if "pickup_hour" not in tables["taxi"].columns else wide


def integrate(tables: dict[str, DataFrame], target: str, joins=TAXI_JOINS, *,
              fmt: str = DEFAULT_FORMAT, tz: str = LOCAL_TIMEZONE) -> dict:
    """Writes the integrated table; returns its rows, and per join the matches and how it was joined.

    Counts are taken where the rows are written; ``enrich`` has proved before that
    they cannot differ from the trips', and the written rows are held against it
    before the table is published.
    """
    specs, strategies = _specs(joins), {}
    watched = {j.prefix: F.count(F.col(f"{j.prefix}_{j.match_column}")).alias(j.prefix) for j in specs if j.match_column}
    seen = Observation(f"quality_lake_integrated_{uuid.uuid4().hex[:12]}")
    before = row_count(tables["taxi"])

    def same_rows(_: DataFrame) -> None:
        if seen.get["rows"] != before:
            raise ContractError(f"{target}: {before} trips became {seen.get['rows']} rows")

    with staging(tables["taxi"].sparkSession) as keep:
        wide = build_integrated(tables, specs, tz, strategies=strategies, keep=keep)
        save(wide.observe(seen, F.count(F.lit(1)).alias("rows"), *watched.values()), target, fmt, "overwrite",
             audit=same_rows, rows=lambda _: seen.get["rows"])
    rows = seen.get["rows"]
    share = 100.0 / rows if rows else 0.0
    return {"rows": rows, **{p: {"matches": seen.get[p], "percent": share * seen.get[p], "join": strategies[p]} for p in watched}}
