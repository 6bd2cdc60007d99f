"""Named dataset transformations (the contract's ``extra_functions``).

A transformation is any ``DataFrame -> DataFrame`` function registered by name;
``apply_transforms`` runs a contract's list in order with ``DataFrame.transform``.
The generic building blocks (literal-map lookup, negative flag, timestamp
assembly) are public so new datasets can register their own combinations.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contract import ContractError
from ..functions.timeops import timestamp_from_date_time, timestamp_from_parts as _ts_parts


@dataclass(frozen=True)
class Transform:
    """A named step.  Rows in which a column of ``required`` is null behind it are rejected.
    ``keeps_rows`` says that the function itself drops none; rows that one drops
    without saying so can be counted but not shown (see ``plans.clean``)."""

    fn: Callable[[DataFrame], DataFrame]
    required: tuple[str, ...] = ()
    keeps_rows: bool = False


_REGISTRY: dict[str, Transform] = {}


def register_transform(name: str, fn: Callable[[DataFrame], DataFrame] | None = None, *, required=(), keeps_rows: bool = False):
    """Register ``fn`` under ``name``; usable as a decorator."""
    def wrap(f):
        _REGISTRY[name] = Transform(f, tuple(required), keeps_rows)
        return f
    return wrap(fn) if fn is not None else wrap


def transform_named(name: str) -> Transform:
    try:
        return _REGISTRY[name]
    except KeyError:
        raise ContractError(f"Unknown dataset transformation: {name}") from None


def get_transform(name: str) -> Callable[[DataFrame], DataFrame]:
    """The whole step as a function: what it makes, without the rows that lack what it requires."""
    step = transform_named(name)

    def run(df: DataFrame) -> DataFrame:
        out = step.fn(df)
        return out.filter(reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() for c in step.required])) if step.required else out
    return run


def apply_transforms(df: DataFrame, names) -> DataFrame:
    fns = [get_transform(n) for n in names]  # resolve all names before building
    for fn in fns:
        df = df.transform(fn)
    return df


# ---------------------------------------------------------------- generic ops

def map_lookup(df: DataFrame, source: str, outputs: dict[str, dict]) -> DataFrame:
    """Add one column per literal mapping, keyed by ``source``; unknown -> null."""
    for out, mapping in outputs.items():
        lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
        df = df.withColumn(out, F.element_at(lookup, F.col(f"`{source}`")))
    return df


def flag_negative(df: DataFrame, column: str, out: str) -> DataFrame:
    """``out`` = ``column < 0`` (null stays null); the column must exist."""
    if column not in df.columns:
        raise ContractError(f"Cannot derive {out}: {column} is missing")
    return df.withColumn(out, F.col(f"`{column}`") < F.lit(0))


def timestamps_from_pairs(df: DataFrame, date_prefix: str = "date_", time_prefix: str = "time_",
                          out_prefix: str = "timestamp_") -> DataFrame:
    """For each ``time_X`` with a matching ``date_X``: add ``timestamp_X`` (NTZ)
    and drop both sources."""
    pairs = [c[len(time_prefix):] for c in df.columns
             if c.startswith(time_prefix) and date_prefix + c[len(time_prefix):] in df.columns]
    if not pairs:
        return df
    made = {out_prefix + s: timestamp_from_date_time(F.col(f"`{date_prefix + s}`"),
                                                     F.col(f"`{time_prefix + s}`"))
            for s in pairs}
    dropped = {date_prefix + s for s in pairs} | {time_prefix + s for s in pairs}
    keep = [F.col(f"`{c}`") for c in df.columns if c not in dropped and c not in made]
    return df.select(*keep, *[v.alias(k) for k, v in made.items()])


# Timestamp part columns, in make_timestamp argument order.
TIME_PARTS = ("year", "month", "day", "hour", "minute", "second")


def timestamp_from_parts(df: DataFrame, out: str = "timestamp", drop_invalid: bool = True) -> DataFrame:
    """Assemble ``out`` from year..second columns (a missing part counts as 0),
    drop rows whose parts are not a real date/time (or leave ``out`` null), then
    drop the parts."""
    present = [p for p in TIME_PARTS if p in df.columns]
    args = [F.col(p) if p in present else F.lit(0) for p in TIME_PARTS]
    df = df.withColumn(out, _ts_parts(*args))
    return (df.filter(F.col(out).isNotNull()) if drop_invalid else df).drop(*present)


# ------------------------------------------------------ registered transforms

# Borough -> county FIPS code and borough -> state FIPS code.
BOROUGH_COUNTY = {
    "Queens": "081",
    "Bronx": "005",
    "Manhattan": "061",
    "Staten Island": "085",
    "Brooklyn": "047",
    "EWR": "013",
}
BOROUGH_STATE = {
    "Queens": "36",
    "Bronx": "36",
    "Manhattan": "36",
    "Staten Island": "36",
    "Brooklyn": "36",
    "EWR": "34",
}


@register_transform("add_county_from_borough", keeps_rows=True)
def add_county_from_borough(df: DataFrame) -> DataFrame:
    if "borough" not in df.columns:
        print("No 'borough' column: county codes not added.")
        return df
    return map_lookup(df, "borough", {"state_code": BOROUGH_STATE, "county_code": BOROUGH_COUNTY})


@register_transform("separate_time_to_timestamp", required=("timestamp",), keeps_rows=True)
def separate_time_to_timestamp(df: DataFrame) -> DataFrame:
    return timestamp_from_parts(df, "timestamp", drop_invalid=False)


@register_transform("dates_and_times_to_timestamp", keeps_rows=True)
def dates_and_times_to_timestamp(df: DataFrame) -> DataFrame:
    return timestamps_from_pairs(df)


@register_transform("add_negative_fare_flag", keeps_rows=True)
def add_negative_fare_flag(df: DataFrame) -> DataFrame:
    return flag_negative(df, "fare_amount", "negative_fare")


@register_transform("add_likely_reimbursement_flag", keeps_rows=True)
def add_likely_reimbursement_flag(df: DataFrame) -> DataFrame:
    return flag_negative(df, "total_amount", "likely_reimbursement")
