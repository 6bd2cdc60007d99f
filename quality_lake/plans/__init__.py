"""Composed jobs: clean/ingest a source, integrate trips, compare layouts."""

from .clean import (
    STAGES,
    IngestResult,
    clean,
    clean_frame,
    ingest,
    ingest_frame,
    read_rejects,
    stage_rows,
    tagged_frame,
    written_counts,
)
from .integrate import (
    LOCAL_TIMEZONE,
    TAXI_JOINS,
    WEATHER_COLUMNS,
    ZONE_COLUMNS,
    build_integrated,
    integrate,
    prepare_air_quality,
    prepare_pickup_hour,
)
from .warehouse import DATASETS, build_warehouse
from .layouts import (
    LAYOUTS,
    REPORTS,
    ReportColumns,
    add_partition_columns,
    compare_layouts,
    layout_profile,
    layout_report,
    reconcile,
    reconcile_layouts,
    write_layout,
    zone_boroughs,
)

__all__ = [
    "DATASETS", "IngestResult", "LAYOUTS", "LOCAL_TIMEZONE", "REPORTS", "ReportColumns", "STAGES",
    "TAXI_JOINS", "WEATHER_COLUMNS", "ZONE_COLUMNS", "add_partition_columns", "build_integrated",
    "build_warehouse", "clean", "clean_frame", "compare_layouts", "ingest", "ingest_frame", "integrate",
    "layout_profile", "layout_report", "prepare_air_quality", "prepare_pickup_hour", "read_rejects",
    "reconcile", "reconcile_layouts", "stage_rows", "tagged_frame", "write_layout", "written_counts", "zone_boroughs",
]
