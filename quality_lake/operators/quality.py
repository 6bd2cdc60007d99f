"""Quality-rule operators: filter by all rules at once, or explain rejects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import passes_all, rule_label, violation


def apply_rules(df: DataFrame, rules) -> DataFrame:
    """Keep rows that break no rule (one filter; unknown rules raise)."""
    rules = list(rules or ())
    if not rules:
        return df
    return df.filter(passes_all(rules, df.schema))


def explain_rejects(df: DataFrame, rules, column: str = "broken_rules") -> DataFrame:
    """Rows that break at least one rule, with the labels of the broken rules."""
    rules = list(rules or ())
    if not rules:
        return df.withColumn(column, F.array().cast("array<string>")).limit(0)
    labels = F.array(*[F.when(F.coalesce(violation(r, df.schema), F.lit(False)),
                              F.lit(rule_label(r))) for r in rules])
    return (df.withColumn(column, F.filter(labels, lambda x: x.isNotNull()))
            .filter(F.size(column) > 0))
