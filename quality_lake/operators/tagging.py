"""Rejecting rows by marking them, so that one plan yields the accepted rows and the rejected ones with their causes.

A tagged frame carries three columns beside the data: the stage that rejected the row
(null while it is accepted), the causes, and the raw row.  Every step of cleaning that
filters has a form here that marks instead; a row's first rejection stays.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contract import Contract
from ..functions.rules import rule_label, violation
from .conform import _conversions, apply_null_policy, check_closed_schema
from .derive import transform_named

AT, CAUSES, RAW = "__rejected_at", "__causes", "__raw"


def _broken_names(broken: list[tuple[str, Column]]) -> Column:
    return F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in broken]), lambda x: x.isNotNull())


def _any(broken: list[tuple[str, Column]]) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for _, c in broken])


def reject(df: DataFrame, stage: str, broken: list[tuple[str, Column]]) -> DataFrame:
    """Marks the rows for which any of the ``(cause, test)`` pairs is true, unless they are rejected already."""
    if not broken:
        return df
    hit = F.col(AT).isNull() & _any(broken)
    return df.withColumns({AT: F.when(hit, F.lit(stage)).otherwise(F.col(AT)),
                           CAUSES: F.when(hit, _broken_names(broken)).otherwise(F.col(CAUSES))})


def tag_conform(df: DataFrame, contract: Contract) -> DataFrame:
    """``conform``, with rows that cannot be converted marked; their causes are the columns' source names."""
    check_closed_schema(df, contract)
    converted, failures = _conversions(df, contract)
    none = F.lit(None).cast("string"), F.lit(None).cast("array<string>")
    at, causes = none if not failures else (F.when(_any(failures), F.lit("conformed")), F.when(_any(failures), _broken_names(failures)))
    return df.select(*[c.alias(n) for n, c in converted], at.alias(AT), causes.alias(CAUSES),
                     F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(RAW))


def tag_null_policy(df: DataFrame, contract: Contract) -> DataFrame:
    """Defaults are filled; rows without a required value are marked with its column."""
    required = [c.output_name for c in contract.columns if not c.nullable and not c.has_default]
    return reject(apply_null_policy(df, contract, drop=False), "null_policy", [(n, F.col(f"`{n}`").isNull()) for n in required])


def tag_transforms(df: DataFrame, names) -> DataFrame:
    """The named steps; rows without what a step requires are marked ``step:column``."""
    for name, step in [(n, transform_named(n)) for n in names]:
        df = reject(step.fn(df), "transforms", [(f"{name}:{c}", F.col(f"`{c}`").isNull()) for c in step.required])
    return df


def tag_rules(df: DataFrame, rules) -> DataFrame:
    """Rows that break a rule are marked with the rules' labels."""
    return reject(df, "rules", [(rule_label(r), violation(r, df.schema)) for r in rules or ()])
