"""Physical layouts of the cleaned trips and the reports compared across them.

A layout is a list of partition columns.  ``write_layout`` deals rows out to planned
files before a Hive-style partitioned write: a task writes one file, and a busy month
has many; the month layout lets a query that filters on
``pickup_year``/``pickup_month`` prune whole directories.

``compare_layouts`` is the whole comparison: prepare the trips once, profile
them, write every layout, and hold row counts, reports and totals against each
other.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import ContractError
from ..functions.values import finite_or_null, normalize_label
from ..operators.enrich import row_count
from ..operators.report import avg_duration_by_day, diff_results, profile
from ..sources.tables import DEFAULT_FORMAT, staging, write_table
from ..sources.versions import read_table
from .sizing import DEFAULT_SORT_BYTES, DEFAULT_TARGET_FILE_BYTES, planned_files

# Layout names -> partition columns.
LAYOUTS = {"unpartitioned": [], "pickup_month": ["pickup_year", "pickup_month"]}


def add_partition_columns(df: DataFrame, ts: str = "tpep_pickup_datetime",
                          prefix: str = "pickup") -> DataFrame:
    return (df.withColumn(f"{prefix}_year", F.year(F.col(ts)))
              .withColumn(f"{prefix}_month", F.month(F.col(ts))))


def write_layout(df: DataFrame, path: str, layout, *, fmt: str = DEFAULT_FORMAT,
                 mode: str = "errorifexists", cluster_by=("tpep_pickup_datetime",),
                 target_file_bytes: int = DEFAULT_TARGET_FILE_BYTES, sort_bytes: int = DEFAULT_SORT_BYTES, **options) -> None:
    """Write one layout (a name of ``LAYOUTS`` or its partition columns) as files of about
    ``target_file_bytes`` of values, or fewer if a task needs more than ``sort_bytes`` to sort
    them, each with a range of the pickup time: a busy month has many, a quiet one has one
    (``plans.sizing.planned_files``).  With ``repartition`` the rows are range-partitioned
    into that many tasks instead."""
    columns = LAYOUTS[layout] if isinstance(layout, str) else list(layout)
    cluster_by = [c for c in cluster_by if c in df.columns]
    if options.get("repartition"):
        write_table(df, path, fmt, mode, partition_by=columns, cluster_by=cluster_by, **options)
        return
    write_table(planned_files(df, columns, cluster_by, target_file_bytes, sort_bytes), path, fmt, mode, partition_by=columns, **options)


def zone_boroughs(zones: DataFrame, key: str = "location_id", out_key: str = "pulocation_id",
                  label: str = "borough") -> DataFrame:
    """Zone id -> trimmed borough, keyed by the trips' pickup column name."""
    return zones.select(F.col(key).alias(out_key), F.trim(F.col(label)).alias(label))


@dataclass(frozen=True)
class ReportColumns:
    """The columns that the reports read and make; the defaults are the trips'."""

    start: str = "tpep_pickup_datetime"
    end: str = "tpep_dropoff_datetime"
    fare: str = "fare_amount"
    key: str = "pulocation_id"
    label: str = "borough"
    count: str = "trip_count"
    mean: str = "average_fare"


def _by_label(facts: DataFrame, labels: DataFrame, c: ReportColumns, partial: dict) -> DataFrame:
    """Sums of ``partial`` aggregates per label.  Facts are aggregated by their key
    before they meet the labels: one row per key (null being one) joins, whatever
    the number of facts, so neither a hot key nor the labels' size matters."""
    per_key = facts.groupBy(F.col(c.key)).agg(*[a.alias(f"__{n}") for n, a in partial.items()])
    named = per_key.join(labels, c.key, "left").withColumn(c.label, normalize_label(F.col(c.label)))
    return named.groupBy(c.label).agg(*[F.sum(f"__{n}").alias(f"__{n}") for n in partial])


def _count_per_label(facts: DataFrame, labels: DataFrame, c: ReportColumns) -> DataFrame:
    sums = _by_label(facts, labels, c, {"n": F.count(F.lit(1))})
    return sums.select(c.label, F.col("__n").alias(c.count))


def _mean_per_label(facts: DataFrame, labels: DataFrame, c: ReportColumns) -> DataFrame:
    finite = finite_or_null(F.col(c.fare))
    sums = _by_label(facts, labels, c, {"sum": F.sum(finite), "n": F.count(finite)})
    return sums.select(c.label, F.when(F.col("__n") > 0, F.col("__sum") / F.col("__n")).alias(c.mean))


def _duration_per_day(facts: DataFrame, labels: DataFrame, c: ReportColumns) -> DataFrame:
    return avg_duration_by_day(facts, c.start, c.end)


@dataclass(frozen=True)
class LayoutReport:
    build: Callable[[DataFrame, DataFrame, ReportColumns], DataFrame]
    keys: tuple[str, ...]


# The names of the compared reports and their keys.
REPORTS = {
    "trips_per_borough": LayoutReport(_count_per_label, ("borough",)),
    "average_duration_per_day": LayoutReport(_duration_per_day, ("pickup_day",)),
    "average_fare_per_borough": LayoutReport(_mean_per_label, ("borough",)),
}


def layout_report(name: str, facts: DataFrame, labels: DataFrame | None = None,
                  columns: ReportColumns = ReportColumns()) -> DataFrame:
    """A report of ``REPORTS`` over facts and, for those by label, key -> label."""
    return REPORTS[name].build(facts, labels, columns)


def layout_profile(df: DataFrame) -> DataFrame:
    return profile(df, "tpep_pickup_datetime", "tpep_dropoff_datetime", "fare_amount")


def reconcile(tables: dict[str, DataFrame], labels: DataFrame, expected_rows: int | None = None, *,
              columns: ReportColumns = ReportColumns(), reports=tuple(REPORTS)) -> dict:
    """Holds tables that should have the same rows against the first of them.

    Raises ``ContractError`` with all differences: in row counts, in any report
    (floats within tolerance), or between the counts per label and the rows.
    Returns the row counts and the number of keys compared per report.
    """
    counts = {name: row_count(t) for name, t in tables.items()}
    first = next(iter(tables))
    expected = counts[first] if expected_rows is None else expected_rows
    found = [f"{name} has {n} rows, not {expected}" for name, n in counts.items() if n != expected]
    compared = {}
    for report in reports:
        with staging(tables[first].sparkSession) as keep:
            made = {name: keep(layout_report(report, t, labels, columns), f"report-{report}") for name, t in tables.items()}
            keys = [columns.label if k == "borough" else k for k in REPORTS[report].keys]
            compared[report] = row_count(made[first])
            for name in made:
                differing = row_count(diff_results(made[first], made[name], keys)) if name != first else 0
                if differing:
                    found.append(f"{report}: {differing} keys of {name} differ from {first}")
            if report == "trips_per_borough":
                total = made[first].agg(F.coalesce(F.sum(columns.count), F.lit(0))).first()[0]
                if total != expected:
                    found.append(f"{report}: {first} counts {total} rows of {expected}")
    if found:
        raise ContractError("Layouts differ: " + "; ".join(found))
    return {"rows": counts, "keys": compared}


def reconcile_layouts(spark: SparkSession, paths: dict[str, str], zones: DataFrame,
                      expected_rows: int | None = None, fmt: str = DEFAULT_FORMAT) -> dict:
    """``reconcile`` for written layouts."""
    return reconcile({name: read_table(spark, p, fmt) for name, p in paths.items()}, zones, expected_rows)


def compare_layouts(spark: SparkSession, trips: DataFrame, zones: DataFrame, root: str,
                    fmt: str = DEFAULT_FORMAT, layouts=tuple(LAYOUTS)) -> dict:
    """Prepare the trips once, profile them, write each layout under ``root`` and
    reconcile; ``zones`` as ``zone_boroughs`` makes them.  Raises if layouts differ."""
    with staging(spark) as keep:
        prepared = keep(add_partition_columns(trips), "layout-source")
        summary = layout_profile(prepared).first().asDict()
        paths = {layout: f"{root}/{layout}" for layout in layouts}
        for layout, path in paths.items():
            write_layout(prepared, path, layout, fmt=fmt)
    return {"profile": summary, "paths": paths, **reconcile_layouts(spark, paths, zones, summary["input_rows"], fmt)}
