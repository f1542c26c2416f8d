"""Declared-format date parsing and the salary date rule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillbook.fixed_values import (
    EXPENSE_DATE_FORMATS,
    INDONESIAN_MONTHS,
    ORDER_DATE_FORMATS,
    SALARY_BRAND,
    SALARY_DAY,
    SALARY_YEAR,
)
from tillbook.functions.text import folded

# All-digit formats are recognised by shape and handed to the string-to-date cast.
# Measured three times as fast as the pattern formatter, which raises and catches
# an exception for every row in another format. The cast reads ISO text as it is,
# with or without a time of day.
_ISO = r"^\d{4}-\d{1,2}-\d{1,2}"
_SLASHED = r"^(\d{1,2})/(\d{1,2})/(\d{4})$"
_SHAPES = {
    "d/M/yyyy": (_SLASHED, "$3-$2-$1"),
    "M/d/yyyy": (_SLASHED, "$3-$1-$2"),
    "yyyy-MM-dd": (_ISO + "$", None),
    "yyyy-MM-dd HH:mm:ss": (_ISO + r" \d{1,2}:\d{2}:\d{2}(\.\d+)?$", None),
    "yyyy-MM-dd[ HH:mm:ss]": (_ISO + r"( \d{1,2}:\d{2}:\d{2}(\.\d+)?)?$", None),
}


def _parse_one(c: Column, fmt: str) -> Column:
    if fmt not in _SHAPES:
        return F.try_to_date(c, fmt)
    shape, iso = _SHAPES[fmt]
    text = c if iso is None else F.regexp_replace(c, shape, iso)
    return F.when(c.rlike(shape), text.try_cast("date"))


def parse_date(c: Column, formats: Sequence[str]) -> Column:
    """First format that fits wins; null when none does."""
    return F.coalesce(*[_parse_one(c, f) for f in formats])


def slashed(formats: Sequence[str]) -> list[str]:
    """Those of the formats that read the same text as day and month in some order."""
    return [f for f in formats if _SHAPES.get(f, ("",))[0] == _SLASHED]


def other_reading(c: Column, formats: Sequence[str]) -> Column:
    """What a slashed date is under the other declared order, where that is another day.

    Null where the text has one reading only, or where a single order is declared. Whether a
    text can be read at all does not depend on the order.
    """
    orders = slashed(formats)
    if len(orders) < 2:
        return F.lit(None).cast("date")
    first, second = _parse_one(c, orders[0]), _parse_one(c, orders[1])
    return F.when(first != second, second)


def only_as(c: Column, fmt: str, formats: Sequence[str]) -> Column:
    """Whether of the slashed formats this one alone reads the text."""
    others = [_parse_one(c, f).isNull() for f in slashed(formats) if f != fmt]
    alone = _parse_one(c, fmt).isNotNull()
    for unread in others:
        alone = alone & unread
    return alone


def parse_order_date(c: Column, formats: Sequence[str] = tuple(ORDER_DATE_FORMATS)) -> Column:
    """Day first."""
    return parse_date(c, formats)


def parse_expense_date(c: Column, formats: Sequence[str] = tuple(EXPENSE_DATE_FORMATS)) -> Column:
    """ISO, then month first, then day first."""
    return parse_date(c, formats)


def indonesian_month(c: Column) -> Column:
    """Month name to 1..12, ignoring case and surrounding whitespace."""
    pairs = [F.lit(x) for name, number in INDONESIAN_MONTHS.items() for x in (name, number)]
    return F.try_element_at(F.create_map(*pairs), folded(c))


def salary_date(
    brand: Column,
    notes: Column,
    default_year: int = SALARY_YEAR,
    salary_day: int = SALARY_DAY,
) -> Column:
    """Pay day of the month named in the notes, for salary rows (brand ``gaji``)."""
    payday = F.make_date(F.lit(default_year), indonesian_month(notes), F.lit(salary_day))
    return F.when(folded(brand) == SALARY_BRAND, payday)


def imputed_date(parsed: Column, payday: Column) -> Column:
    """The row's own date where it has one."""
    return F.coalesce(parsed, payday)


def is_imputed(parsed: Column, payday: Column) -> Column:
    return parsed.isNull() & payday.isNotNull()


def week_start(c: Column) -> Column:
    """Monday of the date's week."""
    return F.trunc(c, "week")
