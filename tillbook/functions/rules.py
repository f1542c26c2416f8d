"""Staging rules: standard names for customers, payments, services, brands, discounts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillbook import fixed_values as V
from tillbook.functions.text import folded


def _first_match(cases: list[tuple[Column, Column]], default: Column) -> Column:
    """Ordered cases as one CASE expression."""
    (first, value), *rest = cases
    chain = reduce(lambda acc, case: acc.when(*case), rest, F.when(first, value))
    return chain.otherwise(default)


def customer_name_clean(name: Column) -> Column:
    """Known aliases replaced, every other name kept as written."""
    cases = [(name == alias, F.lit(full)) for alias, full in V.CUSTOMER_ALIASES.items()]
    return _first_match(cases, name)


def has_honorific(name: Column) -> Column:
    return name.rlike(V.HONORIFIC_PATTERN)


def payment_method(notes: Column) -> Column:
    """Read from the notes, case-sensitively; no note at all means cash."""
    transfer = F.contains(notes, F.lit(V.TRANSFER_MARK))
    cash = notes.isNull() | F.endswith(notes, F.lit(V.CASH_SUFFIX))
    return _first_match([(transfer, F.lit("Transfer")), (cash, F.lit("Cash"))], F.lit("Unknown"))


def item_type(service: Column) -> Column:
    """Bags, carpets and sandals keep their own spelling; all else is a shoe."""
    return F.when(F.lower(service).isin(V.NON_SHOE_SERVICES), service).otherwise(
        F.lit(V.DEFAULT_ITEM)
    )


def clean_type(service: Column) -> Column:
    low = F.lower(service)
    cases = [(low.isin(V.NON_SHOE_SERVICES), F.lit(V.NON_SHOE_CLEAN))]
    cases += [(F.startswith(low, F.lit(p)), F.lit(kind)) for p, kind in V.SERVICE_PREFIXES.items()]
    return _first_match(cases, low)


def shoe_brand_clean(shoe: Column) -> Column:
    """Known spellings and prefixes to one brand name, ignoring case only."""
    low = F.lower(shoe)
    cases = [(low.isin(names), F.lit(brand)) for brand, names in V.BRAND_SPELLINGS.items()]
    cases += [(F.startswith(low, F.lit(p)), F.lit(brand)) for p, brand in V.BRAND_PREFIXES.items()]
    return F.coalesce(_first_match(cases, shoe), F.lit(V.UNKNOWN_BRAND))


def discount_type(discount: Column) -> Column:
    cases = [(discount == amount, F.lit(label)) for amount, label in V.DISCOUNT_LABELS.items()]
    cases += [
        (discount < 0, F.lit("surcharge")),
        (discount > V.MANUAL_DISCOUNT_ABOVE, F.lit("manual")),
    ]
    return _first_match(cases, F.lit("unknown"))


# --- the checklist's rules, beside the live ones -------------------------------


def service_category(service: Column, shoe: Column) -> Column:
    """One of six categories, by how the service's text begins, else the shoe's; null for neither.

    Case and surrounding whitespace do not count. A deep-cleaned bag is a deep clean: the
    service's own text goes first.
    """
    named = lambda c: [(F.startswith(folded(c), F.lit(p)), F.lit(kind)) for p, kind in V.SERVICE_CATEGORIES.items()]
    return _first_match(named(service) + named(shoe), F.lit(None).cast("string"))


def checklist_payment_method(notes: Column) -> Column:
    """Either bank is a transfer; a missing or blank note is unknown, not cash."""
    cases = [(F.contains(notes, F.lit(mark)), F.lit("Transfer")) for mark in V.TRANSFER_MARKS]
    cases.append((F.endswith(F.rtrim(notes), F.lit(V.CASH_SUFFIX)), F.lit("Cash")))
    return _first_match(cases, F.lit("Unknown"))


def checklist_item_type(shoe: Column) -> Column:
    """Shoe, Bag, Carpet, Sandal or Other by the shoe column; nothing written is Other."""
    text = folded(shoe)
    cases = [(F.coalesce(text, F.lit("")) == "", F.lit("Other"))]
    cases += [(F.startswith(text, F.lit(p)), F.lit(kind)) for p, kind in V.CHECKLIST_ITEMS.items()]
    return _first_match(cases, F.lit("Shoe"))
