"""Column-level predicates and value conversions (all JVM-side expressions).

None of these depend on the session time zone or on ``spark.sql.ansi.enabled``:
conversions use ``try_cast`` so bad values become null instead of failing a task.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType)

# Integer text keeps only its integral part (as a lenient cast would): "12.7" -> 12,
# "-2.9" -> -2, " 3.5 " -> 3, ".5" / "-.5" -> 0; "1e3", "1.5x" and non-ASCII digits stay
# unconvertible.  The text is cut at its dot once the fraction proves to be digits
# only, so digits behind the dot never take part in the conversion, however many.


def blank_text(c: Column) -> Column:
    """True when text is empty or only spaces (null stays null).

    Text that is neither empty nor starts with a space cannot be blank, so it
    is decided without ``trim``, which would copy every value.
    """
    return (c == F.lit("")) | (c.startswith(" ") & (F.trim(c) == F.lit("")))


def blank_to_null(c: Column, source_type: T.DataType | None = None) -> Column:
    """Blank text becomes null; other values pass unchanged (not trimmed).

    A non-string source can never be blank, so the test is skipped for it,
    which keeps parquet predicate pushdown intact.
    """
    if source_type is not None and not isinstance(source_type, T.StringType):
        return c
    return F.when(blank_text(c), F.lit(None)).otherwise(c)


def is_finite(c: Column) -> Column:
    """NaN and +-Infinity are not finite; null yields null (unknown)."""
    return ~(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))


def finite_or_null(c: Column) -> Column:
    return F.when(is_finite(c), c)


def is_missing(c: Column, data_type: T.DataType) -> Column:
    """Missing key part: null, blank text, or NaN for floating types."""
    cond = c.isNull()
    if isinstance(data_type, T.StringType):
        cond = cond | blank_text(c)
    elif isinstance(data_type, _FRACTIONAL):
        cond = cond | F.isnan(c)
    return cond


# What a cast of text to a number ignores around it: control characters and spaces.
_TRIMMED = "".join(map(chr, range(0x21)))


def wall_clock(c: Column, zone: str) -> Column:
    """An instant as the zone-less time that clocks in ``zone`` showed, whatever the session's zone."""
    utc = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        secs=(F.unix_micros(c) / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)"))
    return utc if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def cast_value(c: Column, source_type: T.DataType, target: T.DataType, zone: str = "UTC") -> Column:
    """Convert to ``target``; a value that cannot be converted becomes null.

    No-op when the source already has the target type.  Integer targets read
    decimal text by its integral part.  Zoned times are read as the wall clock of
    ``zone``, never of the session.
    """
    if source_type == target:
        return c
    if isinstance(source_type, T.TimestampType):
        return wall_clock(c, zone).try_cast(target)
    if isinstance(source_type, T.StringType) and isinstance(target, _INTEGRAL):
        # Plain text converts directly; only text with a '.' that failed is cut.
        # No regex: the expression stays small and cheap.
        t = F.btrim(c, F.lit(_TRIMMED))
        whole, rest = F.substring_index(t, ".", 1), F.substring_index(t, ".", -1)
        digits = F.translate(t, "0123456789", "")
        number = (digits.isin(".", "-.", "+.") & (F.length(t) > F.length(digits)) & ~rest.startswith("-") & ~rest.startswith("+"))
        cut = F.when(F.length(F.translate(whole, "+-", "")) == 0, F.lit("0")).otherwise(whole)
        return F.coalesce(c.try_cast(target), F.when(number, cut.try_cast(target)))
    return c.try_cast(target)


def normalize_label(c: Column, unknown: str = "Unknown",
                    unknown_values: tuple[str, ...] = ("", "N/A", "Unknown")) -> Column:
    """Null and placeholder labels collapse to one ``unknown`` label."""
    return F.when(c.isNull() | c.isin(*unknown_values), F.lit(unknown)).otherwise(c)
