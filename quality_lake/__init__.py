"""quality_lake: contract-driven cleaning and enrichment on Spark DataFrames."""

from .contract import (
    CONTRACT_TYPES,
    ColumnSpec,
    Contract,
    ContractError,
    GeneratedKey,
    bundled_contract,
    normalize_name,
    spark_type,
)

__all__ = [
    "CONTRACT_TYPES", "ColumnSpec", "Contract", "ContractError", "GeneratedKey",
    "bundled_contract", "normalize_name", "spark_type",
]
