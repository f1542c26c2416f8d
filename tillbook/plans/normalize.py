"""Feeds to typed, labelled rows that can be unioned.

Real feeds hold what people typed: ``Rp`` amounts and day-first dates. Synthetic
feeds are machine-written: plain numbers and ISO dates.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook import fixed_values as V
from tillbook.functions.dates import (
    imputed_date,
    is_imputed,
    parse_expense_date,
    parse_order_date,
    salary_date,
)
from tillbook.functions.numbers import (
    cut_to_int,
    number_to_int,
    number_to_long,
    rupiah_to_int,
)
from tillbook.operators.columns import project, rename, with_lineage
from tillbook.sources.feeds import REJECT_COLUMNS

ORDER_AMOUNTS = ["price", "discount", "total_price"]
EXPENSE_AMOUNTS = ["unit_price", "total_price"]


def _either(is_synthetic: bool | Column, synthetic: Column, real: Column) -> Column:
    """One branch if the kind of feed is known up front, else a per-row choice."""
    if isinstance(is_synthetic, Column):
        return F.when(is_synthetic, synthetic).otherwise(real)
    return synthetic if is_synthetic else real


def _amount(df: DataFrame, name: str, is_synthetic: bool | Column) -> Column:
    """Money text by the feed's kind; a column stored as numbers is only cut."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, T.NumericType):
        return _either(is_synthetic, number_to_int(c), cut_to_int(c))
    return _either(is_synthetic, number_to_int(c), rupiah_to_int(c))


def normalize_orders(
    feed: DataFrame,
    data_source: str | Column,
    is_synthetic: bool | Column,
    date_formats: Sequence[str] = tuple(V.ORDER_DATE_FORMATS),
) -> DataFrame:
    """Type an order feed and label it.

    ``data_source`` and ``is_synthetic`` may be columns, for a table that already
    holds several feeds: it is then typed in one scan rather than one per feed.
    """
    out = rename(feed, V.ORDER_HEADERS)
    out = with_lineage(out, data_source, is_synthetic)
    typed = {
        "order_no": number_to_long(F.col("order_no")),
        "order_date": parse_order_date(F.col("order_date"), date_formats),
    }
    for c in ORDER_AMOUNTS:
        typed[c] = _amount(out, c, is_synthetic)
    return out.withColumns(typed)


#: Columns a load adds to a feed before typing it; they pass through where a feed has them.
OTHER_READING = "other_reading"
CARRIED = [OTHER_READING, *REJECT_COLUMNS]


def _own(feed: DataFrame, headers: Mapping[str, str]) -> DataFrame:
    """Only the ledger's own columns, and those that the load added."""
    added = [c for c in CARRIED if c in feed.columns]
    return project(rename(feed, headers), [*headers.values(), *added])


def normalize_orders_real(feed: DataFrame, data_source: str, **options) -> DataFrame:
    """Only the ledger's own columns; an absent one is an error."""
    narrow = _own(feed, V.ORDER_HEADERS)
    return normalize_orders(narrow, data_source, False, **options)


def normalize_orders_synth(
    feed: DataFrame, data_source: str = V.SYNTHETIC_ORDERS, **options
) -> DataFrame:
    """All columns are kept; extra ones fall away when the table is written."""
    return normalize_orders(feed, data_source, True, **options)


def normalize_expenses(
    feed: DataFrame,
    data_source: str | Column,
    is_synthetic: bool | Column,
    default_year: int = V.SALARY_YEAR,
    salary_day: int = V.SALARY_DAY,
    date_formats: Sequence[str] = tuple(V.EXPENSE_DATE_FORMATS),
) -> DataFrame:
    """Type an expense feed, date its salary rows, and label it.

    Synthetic rows are never imputed; their flag is null, not false.
    """
    out = rename(feed, V.EXPENSE_HEADERS)
    out = with_lineage(out, data_source, is_synthetic)
    out = out.withColumns(
        {
            "__parsed": parse_expense_date(F.col("expense_date"), date_formats),
            "__payday": salary_date(F.col("brand"), F.col("notes"), default_year, salary_day),
        }
    )
    parsed, payday = F.col("__parsed"), F.col("__payday")
    typed = {
        "expense_date": _either(is_synthetic, parsed, imputed_date(parsed, payday)),
        "quantity": number_to_int(F.col("quantity")),
    }
    if is_synthetic is not True:
        typed["is_date_imputed"] = _either(
            is_synthetic, F.lit(None).cast("boolean"), is_imputed(parsed, payday)
        )
    for c in EXPENSE_AMOUNTS:
        typed[c] = _amount(out, c, is_synthetic)
    return out.withColumns(typed).drop("__parsed", "__payday")


def normalize_expenses_real(feed: DataFrame, data_source: str, **options) -> DataFrame:
    narrow = _own(feed, V.EXPENSE_HEADERS)
    return normalize_expenses(narrow, data_source, False, **options)


def normalize_expenses_synth(
    feed: DataFrame, data_source: str = V.SYNTHETIC_SUPPLIES, **options
) -> DataFrame:
    return normalize_expenses(feed, data_source, True, **options)
