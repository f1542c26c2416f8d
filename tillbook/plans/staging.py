"""Staging: one lazy projection over each raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook import fixed_values as V
from tillbook.functions import rules
from tillbook.functions.text import blank_to_null, trimmed_or_null

STG_ORDER_COLUMNS = [
    "order_no", "order_date", "year", "month", "week", "customer_name_clean",
    "payment_method", "item_type", "clean_type", "shoe_brand_clean", "discount_type",
    "total_price", "notes", "worker", "data_source", "is_synthetic",
]


def staged_orders(raw_orders: DataFrame) -> DataFrame:
    """Raw columns plus everything staging derives, for marts that need both.

    ``notes`` is the trimmed one; the payment method is read from the original.
    """
    date = F.col("order_date")
    return raw_orders.withColumns(
        {
            "year": F.year(date),
            "month": F.month(date),
            "week": F.weekofyear(date),
            "customer_name_clean": rules.customer_name_clean(F.col("customer_name")),
            "payment_method": rules.payment_method(F.col("notes")),
            "item_type": rules.item_type(F.col("service_type")),
            "clean_type": rules.clean_type(F.col("service_type")),
            "shoe_brand_clean": rules.shoe_brand_clean(F.col("shoe_type")),
            "discount_type": rules.discount_type(F.col("discount")),
            "notes": trimmed_or_null(F.col("notes")),
        }
    )


def with_revenue(staged: DataFrame) -> DataFrame:
    """Adds ``payment_status_filled``, ``is_revenue`` and ``net_revenue``.

    A blank payment status reads ``unknown``. Such orders, and orders without a positive
    total, stay in the ledger and its counts, but their net revenue is 0.
    """
    status = trimmed_or_null(F.col("payment_status"))
    earned = status.isNotNull() & F.coalesce(F.col("total_price") > 0, F.lit(False))
    return staged.withColumns(
        {
            "payment_status_filled": F.coalesce(status, F.lit(V.UNKNOWN_PAYMENT_STATUS)),
            "is_revenue": earned,
            "net_revenue": F.when(earned, F.col("total_price")).otherwise(F.lit(0)),
        }
    )


def stg_orders(raw_orders: DataFrame) -> DataFrame:
    return staged_orders(raw_orders).select(*STG_ORDER_COLUMNS)


def stg_expenses(raw_expenses: DataFrame) -> DataFrame:
    """Expenses with the computed total and whether the stated one differs.

    A product beyond a 32-bit integer is an error, not a silent null.
    """
    calculated = F.col("unit_price") * F.col("quantity")
    return raw_expenses.select(
        "expense_date",
        F.month("expense_date").alias("month"),
        "item_name",
        blank_to_null(F.col("brand")).alias("brand"),
        "unit_price",
        "quantity",
        "total_price",
        calculated.alias("calculated_total_price"),
        blank_to_null(F.col("notes")).alias("notes"),
        "data_source",
        (F.col("total_price") != calculated).alias("is_total_price_mismatch"),
        "is_synthetic",
        "is_date_imputed",
    )
