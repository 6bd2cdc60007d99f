"""Exact-row dedup in two forms with the same result: one row of each group of equal rows, and its size.

``rows``: one grouping by all columns.  Copies collapse inside each task, but every row that
is left moves once.

``digest``: a 128-bit digest of each row is grouped first (two numbers a row are shuffled).  The digests that occur
twice or more fill a bounded bitmap; rows outside it are unique and stay where they are, and
only rows inside are grouped by all their columns, which compares them value by value.
Digests steer and never decide: a collision only sends a unique row through the grouping.
The rows are read three times instead of shuffled once, so this suits frames over columnar
files with wide rows and few copies.

Rows are equal as Spark groups them: null equals null, NaN equals NaN, 0.0 equals -0.0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import ContractError
from .membership import BITS, bitmap_words, with_membership

_SUSPECT = "__may_have_copies"


def _comparable(c: Column, kind: T.DataType) -> Column:
    """A value such that values that Spark groups together hash alike, at any depth."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(F.isnan(c), F.lit(float("nan")).cast(kind)).when(c == 0, F.lit(0.0).cast(kind)).otherwise(c)
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: _comparable(x, kind.elementType))
    if isinstance(kind, T.StructType):
        inner = F.struct(*[_comparable(c.getField(f.name), f.dataType).alias(f.name) for f in kind.fields])
        return F.when(c.isNotNull(), inner)
    return c


def row_digest(schema: T.StructType) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row: of its values, and of its values behind a number
    that says which of them are null, in the other order."""
    values = [_comparable(F.col(f"`{f.name}`"), f.dataType) for f in schema.fields]
    nulls = F.concat(*[F.when(F.col(f"`{f.name}`").isNull(), F.lit("n")).otherwise(F.lit("v")) for f in schema.fields])
    return F.xxhash64(*values), F.xxhash64(nulls, F.lit(0x9E3779B97F4A7C15 - (1 << 64)), *reversed(values))


def count_copies(df: DataFrame, column: str = "copies", by: str = "rows", *, bits: int = BITS,
                 digest: tuple[Column, Column] | None = None) -> DataFrame:
    """One row of each group of equal rows with the group's size in ``column``."""
    if by not in ("rows", "digest"):
        raise ContractError(f"Unknown form of dedup: {by} (rows, digest)")
    if column in df.columns:
        raise ContractError(f"dedup: the frame already has a column {column}")
    own = [F.col(f"`{c}`") for c in df.columns]
    grouped = lambda d: d.groupBy(*own).agg(F.count(F.lit(1)).alias(column))
    if by == "rows" or not df.columns:
        return grouped(df)
    first, second = digest or row_digest(df.schema)
    repeated = (df.select(first.alias("__first"), second.alias("__second")).groupBy("__first", "__second")
                .agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1"))
    marked = with_membership(df, first, bitmap_words(repeated, "__first", bits), _SUSPECT, bits)
    alone = marked.filter(~F.col(_SUSPECT)).select(*own, F.lit(1).cast("long").alias(column))
    return alone.unionByName(grouped(marked.filter(_SUSPECT)))


def drop_copies(df: DataFrame, by: str = "digest", **options) -> DataFrame:
    """One row of each group of equal rows."""
    return count_copies(df, "__copies", by, **options).drop("__copies")
