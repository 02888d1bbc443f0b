"""A filter of bounded size for a set of hashes, as an array of longs in one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bitmap_of(hashes: DataFrame, bits: int, column: str = "hash") -> DataFrame:
    """One row ``bitmap`` with the bits of all hashes set; ``bits`` a multiple of 64.

    Its size does not depend on the number of hashes; many of them only make it filter less.
    """
    spot = F.pmod(F.col(column), F.lit(bits))
    filled = hashes.select(spot.alias("spot")).groupBy(F.shiftright("spot", 6).alias("id")).agg(
        F.expr("bit_or(shiftleft(1L, cast(spot & 63 as int)))").alias("word"))
    every = hashes.sparkSession.range(bits // 64)
    return every.join(filled, "id", "left").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("id", F.coalesce("word", F.lit(0).cast("long")).alias("word")))),
        lambda x: x["word"]).alias("bitmap"))


def bits_for(rows: int) -> int:
    """Bits for so many hashes: 16 to 32 each, which lets through one other hash in 16 at most; 8 MB in all.

    Beyond 4 million hashes the filter lets more through, which costs time and changes no result.
    """
    return min(1 << 26, max(1 << 10, 1 << (16 * rows).bit_length()))


def may_hold(bitmap: Column, hash_: Column, bits: int) -> Column:
    """False only for hashes outside the set; null for a null hash."""
    spot = F.pmod(hash_, F.lit(bits))
    word = F.get(bitmap, F.shiftright(spot, 6).cast("int"))
    return F.getbit(word, spot.bitwiseAND(F.lit(63)).cast("int")) == 1
