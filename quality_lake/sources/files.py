"""Source scans: CSV (all text, strict) and Parquet, one path or a name glob.

Path globbing is Spark's own, so the same call works on any Hadoop file
system; a pattern that matches nothing raises ``FileNotFoundError``.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import Contract, ContractError, SUPPORTED_FORMATS
from .tables import files_under


def _missing_path(err: Exception) -> bool:
    text = str(err)
    return "PATH_NOT_FOUND" in text or "Path does not exist" in text or "UNABLE_TO_INFER_SCHEMA" in text


#: Headers that are read at a time: a job of one task each, which reads a file's first line.
HEADER_JOBS = 16


def header_groups(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The CSV files behind ``path`` by their header line.

    One row per file comes to the driver, as it does for Spark's own listing.
    """
    try:
        found = files_under(spark, path).select("file_path", "file_size").collect()
    except AnalysisException as err:
        if _missing_path(err):
            raise FileNotFoundError(f"No data files match {path}") from err
        raise
    files = sorted(re.sub(r"([\[\]{}*?\\])", r"\\\1", r["file_path"]) for r in found)  # names, not patterns

    def header(file: str) -> tuple[str, ...]:
        return tuple(spark.read.option("header", True).option("inferSchema", False).csv(file).columns)

    groups: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(HEADER_JOBS) as pool:
        for file, names in zip(files, pool.map(header, files)):
            groups.setdefault(names, []).append(file)
    if len(groups) > 1:
        groups.pop((), None)  # files without a line have no rows either
    return groups


def read_csv_strict(spark: SparkSession, path: str) -> DataFrame:
    """Every column as text, header required, malformed rows fail the read.

    Files are grouped by their header line: each group is one scan with its own
    column order, and the scans are joined by column name.  Files that carry other
    columns fail, as does a file whose header changes before it is scanned
    (``enforceSchema=false`` compares it again).
    """
    groups = header_groups(spark, path)
    if not groups:
        raise FileNotFoundError(f"No data files match {path}")
    first, *others = groups
    for names in others:
        if sorted(names) != sorted(first):
            raise ContractError(f"{path}: files with different headers: {groups[first][0]} has {list(first)}, {groups[names][0]} has {list(names)}")

    def scan(names: tuple[str, ...], files: list[str]) -> DataFrame:
        schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
        return (spark.read.schema(schema)
                .option("header", True).option("enforceSchema", False).option("mode", "FAILFAST")
                .csv(files if len(groups) > 1 else path))

    scans = [scan(names, files).select(*[F.col(f"`{n}`") for n in first]) for names, files in groups.items()]
    return reduce(DataFrame.unionByName, scans) if len(scans) > 1 else scans[0]


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.parquet(path)
    except AnalysisException as err:
        if _missing_path(err):
            raise FileNotFoundError(f"No data files match {path}") from err
        raise


def read_source(spark: SparkSession, path: str, contract_or_format: Contract | str) -> DataFrame:
    fmt = contract_or_format if isinstance(contract_or_format, str) else contract_or_format.format
    if fmt == "csv":
        return read_csv_strict(spark, path)
    if fmt == "parquet":
        return read_parquet(spark, path)
    raise ContractError(f"Unsupported input format: {fmt} (supported: {SUPPORTED_FORMATS})")
