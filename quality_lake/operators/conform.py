"""Conform raw frames to a contract: closed schema, blank -> null, cast/reject,
rename, null policy and column drops.  Each step is one projection or one
filter, so the whole chain fuses into a single whole-stage-codegen span."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import Contract, ContractError, check_output_names
from ..functions.values import blank_text, blank_to_null, cast_value


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def check_closed_schema(df: DataFrame, contract: Contract) -> None:
    """The frame must carry the contract's source columns and no others, in any order."""
    has, wants = set(df.columns), set(contract.source_names)
    if has == wants and len(df.columns) == len(wants):
        return
    told = [f"{sign}{n}" for sign, names in (("-", wants - has), ("+", has - wants)) for n in sorted(names)]
    renamed = sorted(n for n in has - wants if re.sub(r"\d+$", "", n) in wants)
    if renamed:
        told.append(f"(the CSV reader numbers repeated headers: {renamed})")
    raise ContractError(f"{contract.table_name}: columns differ from the contract (- lacking, + not in it): {' '.join(told)}")


def _conversions(df: DataFrame, contract: Contract) -> tuple[list[tuple[str, Column]], list[tuple[str, Column]]]:
    """Per contract column: the converted value and, where a conversion happens,
    a non-null "conversion failed" flag.

    Blank text converts to null for every non-string contract type, so the
    blank test appears only where it decides something (string outputs and the
    failure flag).  Each expression names the raw column as few times as
    possible: the optimizer inlines the projection into the reject filter, and
    a short expression keeps the generated code small enough to be compiled.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    converted, failures = [], []
    for spec in contract.columns:
        source_type, target = types[spec.name], spec.data_type
        raw = _c(spec.name)
        if source_type == target:
            converted.append((spec.name, blank_to_null(raw, source_type)))
            continue
        cast = cast_value(raw, source_type, target, contract.timezone)
        converted.append((spec.name, cast))
        present = (F.coalesce(~blank_text(raw), F.lit(False))
                   if isinstance(source_type, T.StringType) else raw.isNotNull())
        # cast first: a value that converts (nearly all) never reaches the blank test
        failures.append((spec.name, cast.isNull() & present))
    return converted, failures


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Closed-schema check, blank text -> null, cast to contract types.

    A row in which any non-null value fails its conversion is dropped.  Output
    columns keep their source names, in contract order.
    """
    check_closed_schema(df, contract)
    converted, failures = _conversions(df, contract)
    out = df.select(*[c.alias(n) for n, c in converted],
                    *([reduce(lambda a, b: a | b, [f for _, f in failures]).alias("__cast_failed")]
                      if failures else []))
    if failures:
        out = out.filter(~F.col("__cast_failed")).drop("__cast_failed")
    return out


def conform_rejects(df: DataFrame, contract: Contract) -> DataFrame:
    """Rows ``conform`` would drop, with the raw values and the failing columns."""
    check_closed_schema(df, contract)
    _, failures = _conversions(df, contract)
    if not failures:
        return df.withColumn("failed_columns", F.array().cast("array<string>")).limit(0)
    names = F.array(*[F.when(f, F.lit(n)) for n, f in failures])
    return (df.withColumn("failed_columns", F.filter(names, lambda x: x.isNotNull()))
            .filter(F.size("failed_columns") > 0))


def rename_columns(df: DataFrame, contract: Contract) -> DataFrame:
    """Source names -> normalised output names (``rename_to`` first if given)."""
    mapping = {c.name: c.output_name for c in contract.columns}
    check_output_names(list(mapping.values()))
    return df.select(*[_c(n).alias(mapping.get(n, n)) for n in df.columns])


def apply_null_policy(df: DataFrame, contract: Contract, drop: bool = True) -> DataFrame:
    """Non-nullable columns: fill the contract default, or drop null rows.

    Works on output names; all drops become one filter (left out if not ``drop``).
    """
    fills, required = {}, []
    for spec in contract.columns:
        if spec.nullable:
            continue
        name = spec.output_name
        if spec.has_default:
            fills[name] = F.coalesce(_c(name), F.lit(spec.default).cast(spec.data_type))
        else:
            required.append(name)
    if fills:
        df = df.select(*[fills[n].alias(n) if n in fills else _c(n) for n in df.columns])
    if required and drop:
        df = df.filter(reduce(lambda a, b: a & b, [_c(n).isNotNull() for n in required]))
    return df


def drop_unwanted(df: DataFrame, contract: Contract) -> DataFrame:
    """Drop columns marked ``keep_column: false`` (after transforms, before rules)."""
    dropped = [c.output_name for c in contract.columns if not c.keep_column]
    return df.drop(*dropped) if dropped else df

