"""Grouped reports, the global profile, and result comparison.

All aggregates are hash aggregates with partial (map-side) aggregation, so a
group holding a third of the rows is pre-combined in every task before the
shuffle.  Results are compared by fingerprints of key buckets first, which leave
only the buckets that differ to a distributed full outer join on the keys; no result
is collected to compare it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timeops import duration_seconds
from ..functions.values import finite_or_null, is_finite, normalize_label
from .dedup import _comparable, row_digest

#: Buckets of keys that are fingerprinted; so many rows at most come to the driver.
BUCKETS = 4096


def _c(name: str):
    return F.col(f"`{name}`")


def label_column(df: DataFrame, label: str, out: str | None = None) -> DataFrame:
    """Null, blank and placeholder labels collapse to ``Unknown``."""
    return df.withColumn(out or label, normalize_label(_c(label)))


def count_by(df: DataFrame, label: str, out: str = "trip_count") -> DataFrame:
    return label_column(df, label).groupBy(_c(label)).agg(F.count(F.lit(1)).alias(out))


def avg_finite_by(df: DataFrame, label: str, value: str, out: str) -> DataFrame:
    """Mean of the finite values per label; NaN/Inf/null are left out of the
    mean but the group is kept (with a null mean when nothing is finite)."""
    return label_column(df, label).groupBy(_c(label)).agg(
        F.avg(finite_or_null(_c(value))).alias(out))


def avg_duration_by_day(df: DataFrame, start: str, end: str, day_out: str = "pickup_day",
                        out: str = "average_duration_seconds") -> DataFrame:
    """Mean wall-clock seconds from ``start`` to ``end`` per day of ``start``;
    negative and unknown durations are left out."""
    d = duration_seconds(_c(start), _c(end))
    return (df.select(F.to_date(_c(start)).alias(day_out), d.alias("__duration"))
            .filter(F.col("__duration") >= 0)
            .groupBy(day_out).agg(F.avg("__duration").alias(out)))


def profile(df: DataFrame, start: str, end: str, fare: str) -> DataFrame:
    """One row: rows, rows with an unknown/negative duration, rows with a
    null/NaN/infinite fare, earliest and latest start."""
    d = duration_seconds(_c(start), _c(end))
    return df.agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(d.isNull() | (d < 0)).alias("invalid_duration_rows"),
        F.count_if(_c(fare).isNull() | ~is_finite(_c(fare))).alias("invalid_fare_rows"),
        F.min(_c(start)).alias("earliest_pickup"),
        F.max(_c(start)).alias("latest_pickup"),
    )


def sorted_result(df: DataFrame) -> DataFrame:
    """Order a (small) result by the text form of its first column."""
    return df.orderBy(_c(df.columns[0]).cast("string"))


def compare_results(left: DataFrame, right: DataFrame, keys, rel_tol: float = 1e-9,
                    abs_tol: float = 1e-7) -> DataFrame:
    """Two results side by side: one row per key of either.

    For each value column ``v``: ``left_v``, ``right_v``; ``matches`` is true when
    each side has exactly one row of that key and every value agrees.  Finite
    floats agree within ``max(rel_tol * max(|a|,|b|), abs_tol)``; infinite ones only
    if they are equal; a NaN agrees with nothing, also not with a NaN; two nulls
    agree.  Keys are compared null-safely.  A key that repeats on a side does not
    match (its row shows one of the values), so a lost copy is never hidden.
    """
    keys = list(keys)
    values = [c for c in left.columns if c not in keys]
    if sorted(values) != sorted(c for c in right.columns if c not in keys):
        raise ValueError(f"Result columns differ: {left.columns} vs {right.columns}")
    ftypes = {f.name: f.dataType.typeName() for f in left.schema.fields}

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*[_c(k).alias(f"__{name}{i}") for i, k in enumerate(keys)]).agg(
            F.count(F.lit(1)).alias(f"__{name}_rows"), *[F.first(_c(v)).alias(f"{name}_{v}") for v in values])

    cond = reduce(lambda a, b: a & b,
                  [F.col(f"__left{i}").eqNullSafe(F.col(f"__right{i}")) for i in range(len(keys))])
    j = side(left, "left").join(side(right, "right"), cond, "full_outer")

    def same(v):
        a, b = F.col(f"left_{v}"), F.col(f"right_{v}")
        if ftypes[v] not in ("double", "float"):
            return a.eqNullSafe(b)
        tol = F.greatest(F.lit(rel_tol) * F.greatest(F.abs(a), F.abs(b)), F.lit(abs_tol))
        agree = (F.when(F.isnan(a) | F.isnan(b), F.lit(False))
                 .when(is_finite(a) & is_finite(b), F.abs(a - b) <= tol).otherwise(a == b))
        return (a.isNull() & b.isNull()) | (a.isNotNull() & b.isNotNull() & F.coalesce(agree, F.lit(False)))

    once = F.coalesce((F.col("__left_rows") == 1) & (F.col("__right_rows") == 1), F.lit(False))
    matches = reduce(lambda x, y: x & y, [same(v) for v in values], once)
    return j.select(*[F.coalesce(F.col(f"__left{i}"), F.col(f"__right{i}")).alias(k) for i, k in enumerate(keys)],
                    *[F.col(f"{name}_{v}") for v in values for name in ("left", "right")],
                    matches.alias("matches"))


def _bucket(df: DataFrame, keys, buckets: int):
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return F.pmod(F.xxhash64(*[_comparable(_c(k), kinds[k]) for k in keys]), F.lit(buckets)).cast("int")


def bucket_fingerprints(df: DataFrame, keys, buckets: int = BUCKETS, once: bool = False) -> DataFrame:
    """Per bucket of keys: rows, and two sums over all rows of 64-bit hashes of the whole row, which
    do not depend on any order; whether a value is a NaN (which agrees with nothing);
    with ``once``, whether a key repeats.  One row per bucket, made by partial aggregation."""
    keys = list(keys)
    shown = df.select(*[_c(c) for c in sorted(df.columns)])
    first, second = row_digest(shown.schema)
    nans = [F.isnan(_c(f.name)) for f in shown.schema.fields if f.dataType.typeName() in ("double", "float") and f.name not in keys]
    kinds = {f.name: f.dataType for f in df.schema.fields}
    own = [_comparable(_c(k), kinds[k]) for k in keys]
    rows = shown.select(_bucket(df, keys, buckets).alias("bucket"), first.alias("a"), second.alias("b"),
                        reduce(lambda x, y: x | y, [F.coalesce(n, F.lit(False)) for n in nans], F.lit(False)).alias("nan"),
                        F.xxhash64(F.lit(1), *own).alias("key"), F.xxhash64(*reversed(own), F.lit(2)).alias("key2"))
    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    if once:  # a key that stands twice on one side of equal buckets stands twice on both
        rows = rows.groupBy("bucket", "key", "key2").agg(F.count(F.lit(1)).alias("n"), wide("a").alias("a"), wide("b").alias("b"), F.bool_or("nan").alias("nan"))
        return rows.groupBy("bucket").agg(F.sum("n").alias("n"), wide("a").alias("a"), wide("b").alias("b"),
                                          F.bool_or("nan").alias("nan"), (F.max("n") > 1).alias("repeats"))
    return rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), wide("a").alias("a"), wide("b").alias("b"), F.bool_or("nan").alias("nan"))


def unequal_buckets(left: DataFrame, right: DataFrame, keys, buckets: int = BUCKETS) -> list[int]:
    """The buckets whose rows are not proved to agree: ``buckets`` numbers at most.

    Equal fingerprints mean equal rows, but for a chance of 2**-128 a bucket.  Floats
    take part with their exact values, so a bucket that only differs within a
    tolerance is listed too, as is one with a NaN or a repeated key.
    """
    a, b = bucket_fingerprints(left, keys, buckets, once=True).alias("a"), bucket_fingerprints(right, keys, buckets).alias("b")
    same = reduce(lambda x, y: x & y, [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("n", "a", "b")]) & ~F.col("a.nan") & ~F.col("a.repeats")
    differ = a.join(b, F.col("a.bucket") == F.col("b.bucket"), "full_outer").filter(~F.coalesce(same, F.lit(False)))
    return sorted(r[0] for r in differ.select(F.coalesce("a.bucket", "b.bucket")).collect())


def diff_results(left: DataFrame, right: DataFrame, keys, rel_tol: float = 1e-9,
                 abs_tol: float = 1e-7, buckets: int = BUCKETS) -> DataFrame:
    """Keys on which two results differ (none when they agree; see ``compare_results``).

    Only rows of ``unequal_buckets`` meet in a join; results that are equal are
    never joined.  Both sides are read twice.
    """
    keys = list(keys)
    compared = compare_results(left, right, keys, rel_tol, abs_tol)
    if [f.dataType for f in left.select(*sorted(left.columns)).schema] != [f.dataType for f in right.select(*sorted(right.columns)).schema]:
        return compared.filter(~F.col("matches"))  # other types hash differently where values agree
    differing = unequal_buckets(left, right, keys, buckets)
    if not differing:
        return compared.limit(0)
    if len(differing) < buckets:
        inside = [d.filter(_bucket(d, keys, buckets).isin(differing)) for d in (left, right)]
        compared = compare_results(*inside, keys, rel_tol, abs_tol)
    return compared.filter(~F.col("matches"))
