"""Dataset contracts: the declarative description a cleaning run is compiled from.

A contract is plain data (JSON or a dict).  Everything here runs on the driver
and only inspects names and types; no Spark job is started.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from pyspark.sql import types as T

# The closed contract type vocabulary (case-insensitive names).
# "timestamp" deliberately means a zone-less (NTZ) timestamp.
CONTRACT_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "bool": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
}

SUPPORTED_FORMATS = ("csv", "parquet")

# The name-normalisation patterns (camel-case boundary; runs of
# characters other than letters, digits and underscore).
_CAMEL_BOUNDARY = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_NOT_WORD = re.compile(r"[^A-Za-z0-9_]+")


class ContractError(ValueError):
    """A contract, or data checked against it, is not acceptable."""


def spark_type(type_name: str) -> T.DataType:
    """Contract type name -> Spark type; unknown names are contract errors."""
    try:
        return CONTRACT_TYPES[type_name.lower()]
    except KeyError:
        raise ContractError(f"Unknown contract type: {type_name!r}") from None


def normalize_name(name: str) -> str:
    """snake_case a source column name.

    A camel-case boundary (lower or digit followed by upper) gets an underscore,
    every run of other characters becomes one underscore, outer underscores go
    and the result is lower case: ``PULocationID`` -> ``pulocation_id``,
    ``Date of Last Change`` -> ``date_of_last_change``.
    """
    spaced = _CAMEL_BOUNDARY.sub("_", name)
    return _NOT_WORD.sub("_", spaced).strip("_").lower()


def _repeated(names) -> list[str]:
    return sorted(n for n, k in Counter(names).items() if k > 1)


def check_output_names(names: list[str]) -> None:
    """Output names must be usable as identifiers, and each only once."""
    problems = {"empty or beginning with a digit": sorted({n for n in names if not n or n[0].isdigit()}),
                "used more than once": _repeated(names)}
    found = [f"{what}: {which}" for what, which in problems.items() if which]
    if found:
        raise ContractError("Output column names are not acceptable; " + "; ".join(found))


def check_key_spec(columns: Any, available=None, what: str = "primary_key") -> list[str]:
    """The one place where a list of key columns is checked, whatever it is for:
    it names at least one column, each once, and (if ``available`` is given) only
    columns that exist."""
    names = [] if columns is None or isinstance(columns, str) else list(columns)
    if not names or any(not isinstance(n, str) for n in names):
        raise ContractError(f"{what}: expected a list of one or more column names, got {columns!r}")
    if _repeated(names):
        raise ContractError(f"{what}: repeats {_repeated(names)}")
    unknown = sorted(set(names).difference(names if available is None else available))
    if unknown:
        raise ContractError(f"{what}: no such columns: {unknown}")
    return names


@dataclass(frozen=True)
class ColumnSpec:
    name: str                      # name in the source
    type: str                      # contract type name
    nullable: bool = True
    keep_column: bool = True
    rename_to: str | None = None
    default: Any = None
    has_default: bool = False

    @property
    def data_type(self) -> T.DataType:
        return spark_type(self.type)

    @property
    def output_name(self) -> str:
        return normalize_name(self.rename_to if self.rename_to is not None else self.name)

    @classmethod
    def from_dict(cls, d: dict) -> "ColumnSpec":
        spark_type(d["type"])  # fail early on unknown types
        return cls(
            name=d["name"], type=d["type"], nullable=bool(d.get("nullable", True)),
            keep_column=bool(d.get("keep_column", True)), rename_to=d.get("rename_to"),
            default=d.get("default"), has_default="default" in d,
        )


@dataclass(frozen=True)
class GeneratedKey:
    name: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class Contract:
    table_name: str
    format: str
    columns: tuple[ColumnSpec, ...]
    schema_version: int = 1
    primary_key: tuple[str, ...] | None = None
    generated_key: GeneratedKey | None = None
    transforms: tuple[str, ...] = ()
    rules: tuple[dict, ...] = ()
    timezone: str = "UTC"          # whose wall clock zoned source times are read as
    raw: dict = field(default_factory=dict, compare=False, repr=False)

    @classmethod
    def from_dict(cls, d: dict) -> "Contract":
        fmt = d.get("format", "parquet")
        if fmt not in SUPPORTED_FORMATS:
            raise ContractError(f"Unsupported input format: {fmt}")
        columns = tuple(ColumnSpec.from_dict(c) for c in d["columns"])
        source_names = [c.name for c in columns]
        if len(set(source_names)) != len(source_names):
            raise ContractError(f"Duplicate source columns in contract: {source_names}")
        check_output_names([c.output_name for c in columns])
        gk = d.get("generated_key")
        return cls(
            table_name=d["table_name"], format=fmt, columns=columns,
            schema_version=int(d.get("schema_version", 1)),
            primary_key=tuple(check_key_spec(d["primary_key"])) if "primary_key" in d else None,
            generated_key=GeneratedKey(gk["name"], tuple(gk["columns"])) if gk else None,
            transforms=tuple(d.get("extra_functions", d.get("transforms", ()))),
            rules=tuple(d.get("quality_rules", d.get("rules", ()))),
            timezone=d.get("timezone", "UTC"),
            raw=d,
        )

    @classmethod
    def from_json(cls, path: str | Path) -> "Contract":
        with Path(path).open(encoding="utf-8") as handle:
            return cls.from_dict(json.load(handle))

    @property
    def source_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def output_names(self) -> list[str]:
        return [c.output_name for c in self.columns]

    def source_schema(self) -> T.StructType:
        """Typed schema of the source columns (after the cast step)."""
        return T.StructType([T.StructField(c.name, c.data_type, True) for c in self.columns])


def bundled_contract(name: str) -> Contract:
    """Load one of the contracts shipped in ``quality_lake/contracts``.

    Fixed values: their column names, types, keys and rules are those of the
    source files and stand in the files' own order.
    """
    path = Path(__file__).parent / "contracts" / (name if name.endswith(".json") else f"{name}.json")
    return Contract.from_json(path)
