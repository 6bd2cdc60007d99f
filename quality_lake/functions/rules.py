"""Quality rules as "violated" column expressions.

A rule is a dict such as ``{"rule": "between", "column": "rhum", "minimum": 0,
"maximum": 100}``.  A row breaks a rule only when the expression is *true*;
a null outcome (e.g. a null value under ``minimum``) passes.  NaN is ordered
above every number, so it passes ``minimum`` and breaks ``maximum``/``between``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import ContractError
from .values import blank_text, is_finite

# Rule names a contract may use.
RULE_NAMES = ("not_null", "finite", "minimum", "maximum", "between", "after_or_equal")


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def violation(rule: dict, schema: T.StructType) -> Column:
    """Expression that is true when ``rule`` is definitely broken."""
    kind = rule.get("rule")
    name = rule.get("column")
    if kind not in RULE_NAMES:
        raise ContractError(f"Unknown quality rule: {kind}")
    if name not in schema.fieldNames():
        raise ContractError(f"Quality rule {kind} refers to a missing column: {name}")
    c = _col(name)
    if kind == "not_null":
        broken = c.isNull()
        if isinstance(schema[name].dataType, T.StringType):
            broken = broken | blank_text(c)
        return broken
    if kind == "finite":
        return ~is_finite(c)
    if kind == "minimum":
        return c < F.lit(rule["value"])
    if kind == "maximum":
        return c > F.lit(rule["value"])
    if kind == "between":
        return (c < F.lit(rule["minimum"])) | (c > F.lit(rule["maximum"]))
    other = rule.get("other_column")
    if other not in schema.fieldNames():
        raise ContractError(f"after_or_equal refers to a missing column: {other}")
    return c < _col(other)


def rule_label(rule: dict) -> str:
    return f"{rule['rule']}:{rule['column']}"


def passes_all(rules: list[dict] | tuple[dict, ...], schema: T.StructType) -> Column:
    """One conjunction: true when no rule is definitely broken."""
    ok = F.lit(True)
    for rule in rules:
        ok = ok & ~F.coalesce(violation(rule, schema), F.lit(False))
    return ok
