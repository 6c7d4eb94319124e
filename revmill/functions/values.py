"""Predicates, coercions and labels over single columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def non_blank(c: Column) -> Column:
    return c.isNotNull() & (F.length(F.trim(c)) > 0)


def min_len(c: Column, n: int) -> Column:
    return F.length(F.trim(c)) >= n


def has_key(c: Column) -> Column:
    return c.isNotNull() & (c.cast("string") != "")


def valid_range(c: Column, lo: float, hi: float) -> Column:
    """A number within [lo, hi]; text that is no number, null and NaN are out. Never null."""
    return F.coalesce(c.try_cast("double").between(lo, hi), F.lit(False))


def soft_int(c: Column) -> Column:
    """The integer if the value is one, else null; keep the raw column beside it."""
    return c.try_cast("int")


def json_integer(line: Column, field: str, text: Column) -> Column:
    """text, the field's value as read from a JSON line, with number and truth tokens as whole numbers.

    An unquoted 4.0 or 4.7 is 4 and true is 1; a quoted "4.0" stays as it is, and so is unreadable as an integer.
    """
    token = F.regexp_extract(
        line, rf'(?<!\\)"{field}"\s*:\s*(-?[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|true|false)\s*[,}}]', 1
    )
    number = token.try_cast("double")
    whole = F.when(number.between(-9.0e18, 9.0e18), number.try_cast("long").cast("string"))
    return (
        F.when(token == "", text).when(token == "true", "1").when(token == "false", "0").otherwise(F.coalesce(whole, text))
    )


def json_null(line: Column, fields: list[str]) -> Column:
    """True where a JSON line gives one of the fields as null, other than leaving it out."""
    return F.coalesce(line.rlike(rf'(?<!\\)"(?:{"|".join(fields)})"\s*:\s*null\s*[,}}]'), F.lit(False))


def or_default(c: Column, dtype: str, default) -> Column:
    return F.coalesce(c.try_cast(dtype), F.lit(default).cast(dtype))


def binary_label(stars: Column, threshold: float = 4.0) -> Column:
    return F.when(stars >= threshold, 1.0).otherwise(0.0)


def tier_label(stars: Column, high: float = 4.0, mid: float = 3.0) -> Column:
    """0 easy, 1 medium, 2 hard."""
    return F.when(stars >= high, 0.0).when(stars >= mid, 1.0).otherwise(2.0)


def key_fraction(key: Column, seed: int) -> Column:
    """A number in [0, 1) fixed by the key and the seed alone, so it survives any repartitioning."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f"#{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(1 << 32)


def key_rank(key: Column, seed: int) -> Column:
    """A shuffling sort key fixed by the key and the seed."""
    return F.md5(F.concat(key.cast("string"), F.lit(f"#{seed}")))
