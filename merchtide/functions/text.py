"""Tokens, signed hashing vectors and keyword tests, all as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from merchtide.functions.numeric import rounded

DIM = 32

# The characters that separate tokens, i.e. four punctuation
# marks and every Unicode white-space character. The ones outside Latin-1 are
# rare and turned into blanks first. Single characters instead of ranges let the
# pattern test a character with one table lookup.
SEPARATORS = r"[,._\-\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0]+"
RARE_RANGE = r"[\x{1680}-\x{3000}]"
RARE_SPACES = r"[\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` one time and hand it to ``use``.

    The optimizer puts an expression wherever its column is named, inside lambda
    bodies too, where it would run again for every element.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


def pieces(text: Column) -> Column:
    """The text cut at separators; the first and last piece may be empty."""
    low = F.lower(text)
    spaced = F.when(F.rlike(low, F.lit(RARE_RANGE)), F.regexp_replace(low, RARE_SPACES, " "))
    return F.split(F.coalesce(spaced, low), SEPARATORS)


def tokens(text: Column) -> Column:
    return F.filter(pieces(text), lambda t: t != "")


def hash_slot(token: Column, dim: int = DIM) -> Column:
    """Vector position of a token: its first 32 md5 bits modulo the dimension."""
    return (F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("long") % dim).cast("int")


def hash_sign(token: Column) -> Column:
    """+1 or -1 by the lowest bit of the fifth md5 byte."""
    odd = F.substring(F.md5(token), 10, 1).isin("1", "3", "5", "7", "9", "b", "d", "f")
    return F.when(odd, -1).otherwise(1)


def unit_vector(counts: Column) -> Column:
    """Scale to length one at six decimals; a zero vector stays zero."""

    def scaled(wide: Column) -> Column:
        norm = F.sqrt(F.aggregate(wide, F.lit(0.0), lambda acc, x: acc + x * x))
        return once(
            norm,
            lambda n: F.transform(
                wide, lambda x: F.when(n == 0, x).otherwise(rounded(x / n, 6))
            ),
        )

    return once(counts.cast("array<double>"), scaled)


def hashed_vector(text: Column, dim: int = DIM) -> Column:
    """Vector of a short text without leaving the row.

    It reads the token list once per dimension; long texts go through
    ``operators.vectors.vectorize``.
    """
    hashed = F.transform(
        tokens(text),
        lambda t: F.struct(hash_slot(t, dim).alias("i"), hash_sign(t).alias("s")),
    )

    def counts(words: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.lit(dim - 1)),
            lambda k: F.aggregate(
                words, F.lit(0), lambda acc, z: acc + F.when(z["i"] == k, z["s"]).otherwise(0)
            ),
        )

    return unit_vector(once(hashed, counts))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x
    )


def mentions_key(text: Column, key: Column) -> Column:
    """True when any ``_``-separated part of the key occurs in the text."""
    return once(
        F.lower(text), lambda low: F.exists(F.split(key, "_"), lambda part: F.contains(low, part)))


def first_occurrences(items: Column) -> Column:
    """Distinct items, in the order they first appear."""
    return F.array_distinct(items)
