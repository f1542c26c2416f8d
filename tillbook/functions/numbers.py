"""Localised money text and loosely typed numbers to integers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rupiah_to_int(c: Column) -> Column:
    """``Rp67.400,00`` and friends to whole Rupiah, or null.

    The letters ``R`` and ``p``, whitespace, dots and commas are dropped wherever
    they stand. A comma means that the text carried two decimals, which are cut by
    rounding down. Whatever does not read as an integer, or does not fit one, is
    null.
    """
    digits = F.regexp_replace(c, r"(?U)[Rp\s.,]", "").try_cast("bigint")
    whole = F.when(F.contains(c, F.lit(",")), F.floor(digits / F.lit(100))).otherwise(digits)
    return whole.try_cast("int")


def cut_to_int(c: Column) -> Column:
    """An amount that already is a number, decimals cut; null if it does not fit."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double")).try_cast("int")


def to_number(c: Column) -> Column:
    """Text to double, null when it is not a number.

    Java accepts a trailing ``d`` or ``f`` as part of a number; ledgers do not.
    """
    number = F.when(~c.rlike(r"[dDfF]\s*$"), c.try_cast("double"))
    return F.nanvl(number, F.lit(None).cast("double"))


def number_to_int(c: Column) -> Column:
    """Text to integer through a number, so that ``2.5`` and ``1e3`` are understood.

    Halves go to the even neighbour. Plain integers, the usual case, are read
    directly.
    """
    text = c.cast("string")
    return F.coalesce(text.try_cast("int"), F.bround(to_number(text)).try_cast("int"))


def number_to_long(c: Column) -> Column:
    """Text to a 64-bit integer; plain integers keep every digit."""
    return F.coalesce(c.try_cast("bigint"), F.bround(to_number(c)).try_cast("bigint"))


def number_or_zero(c: Column) -> Column:
    """Text to integer with missing or unreadable amounts counted as zero.

    Decimals are cut, not rounded.
    """
    return F.coalesce(to_number(c), F.lit(0.0)).try_cast("int")
