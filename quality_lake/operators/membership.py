"""A bounded filter "may this key occur there?", for facts that would only be shuffled in vain.

The keys' hashes set bits of a bitmap of ``BITS`` bits, kept as rows ``(word, mask)`` of 64 bits
each; ``bit_or`` makes them by partial aggregation.  However many keys there are, that is
``BITS / 64`` rows of two numbers at most, so it may always be broadcast.  A key that occurs is
always let through; one that does not is let through with a chance that grows with the number
of keys, up to all of them.  The filter therefore saves work and never decides: what passes
still goes through the exact join or grouping behind it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a bitmap: 2**20 words of 16 bytes at most.
BITS = 1 << 26
_WORD, _MASK = "__member_word", "__member_mask"


def key_hash(*columns: Column) -> Column:
    return F.xxhash64(*columns)


def bitmap_words(hashes: DataFrame, column: str, bits: int = BITS) -> DataFrame:
    """The bitmap of a column of 64-bit hashes, as ``(word, mask)`` rows; nulls set nothing."""
    places = hashes.filter(F.col(column).isNotNull()).select(F.pmod(F.col(column), F.lit(bits)).alias("__place"))
    one = places.select(F.shiftright("__place", 6).alias(_WORD), F.expr("shiftleft(1L, int(__place & 63))").alias(_MASK))
    return one.groupBy(_WORD).agg(F.bit_or(_MASK).alias(_MASK))


def with_membership(df: DataFrame, hashed: Column, words: DataFrame, flag: str, bits: int = BITS) -> DataFrame:
    """``df`` with a boolean ``flag``: whether the hash's bit is set (a null hash: false)."""
    place = "__member_place"
    there = F.expr(f"coalesce(shiftright({_MASK}, int({place} & 63)) & 1L, 0L) = 1L")
    return (df.withColumn(place, F.pmod(hashed, F.lit(bits)))
            .join(F.broadcast(words), F.shiftright(place, 6) == F.col(_WORD), "left")  # bits / 64 rows at most
            .select(*[F.col(f"`{c}`") for c in df.columns], there.alias(flag)))
