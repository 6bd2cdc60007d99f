"""The whole run: ingest every source by its contract, then integrate.

An error while ingesting any source stops the run before integration, and each
cleaned table is only published after its key audit (see ``ingest``).  Each source, and the
integration of all tables, runs in a session sized from its own bytes.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..contract import Contract, bundled_contract
from ..sources.tables import DEFAULT_FORMAT
from ..sources.versions import read_table
from .clean import ingest
from .integrate import TAXI_JOINS, integrate
from .sizing import sized_session

# Integration role -> shipped contract, in ingestion order.
DATASETS = {
    "taxi": "taxi_trips",
    "air_quality": "air_quality",
    "weather": "weather",
    "zones": "taxi_zone_lookup",
}


def build_warehouse(spark: SparkSession, sources: dict[str, str], root: str, *,
                    contracts: dict[str, Contract] | None = None, joins=TAXI_JOINS,
                    fmt: str = DEFAULT_FORMAT, integrate_output: bool = True) -> dict:
    """``sources`` maps a role (``taxi``, ``air_quality``, ``weather``,
    ``zones``) to a path or name glob.  Tables are written under ``root``:
    ``cleaned/<table>``, ``metadata/ingestion_runs`` and
    ``integrated/integrated_taxi_trips``.  Returns run records and match rates.
    """
    contracts = contracts or {role: bundled_contract(name) for role, name in DATASETS.items()}
    runs = f"{root}/metadata/ingestion_runs"
    records, paths = {}, {}
    for role in DATASETS:
        if role not in sources:
            continue
        c = contracts[role]
        paths[role] = f"{root}/cleaned/{c.table_name}"
        records[role] = ingest(spark, sources[role], c, paths[role], fmt=fmt, runs_path=runs).record
    result = {"runs": records}
    if integrate_output:
        own = sized_session(spark, *paths.values()) if fmt == "parquet" else spark
        tables = {role: read_table(own, p, fmt) for role, p in paths.items()}
        result["integration"] = integrate(tables, f"{root}/integrated/integrated_taxi_trips",
                                          joins, fmt=fmt)
    return result
