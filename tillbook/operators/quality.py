"""Data-quality checks as one aggregate per frame, and the gate that acts on them.

A check set is a DataFrame of rows ``(check_name, failing, rate, passed)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook import fixed_values as V


class DataQualityError(ValueError):
    """The first failed check, in the order the checks are listed."""


def _rows(df: DataFrame, checks: Sequence[tuple[str, Column, Column | None, Column | None]]) -> DataFrame:
    """Evaluate (name, failing, rate, passed) aggregates in one pass, one row each."""
    metrics, structs = [], []
    for i, (name, failing, rate, passed) in enumerate(checks):
        metrics.append(failing.cast("bigint").alias(f"f{i}"))
        metrics.append((F.lit(None) if rate is None else rate).cast("double").alias(f"r{i}"))
        ok = F.col(f"f{i}") == 0 if passed is None else passed(F.col(f"r{i}"))
        structs.append(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(name).alias("check_name"),
                F.col(f"f{i}").alias("failing"),
                F.col(f"r{i}").alias("rate"),
                ok.alias("passed"),
            )
        )
    return df.agg(*metrics).select(F.inline(F.array(*structs)))


def _count(name: str, condition: Column):
    return (name, F.count_if(condition), None, None)


def _rate(name: str, failing: Column, limit: float):
    """Share of failing rows; null for an empty frame, which passes any limit."""
    within = lambda rate: F.coalesce(rate <= limit, F.lit(True))
    return (name, F.count_if(failing), F.avg(failing.cast("int")), within)


#: Per check: its name, which rows fail it, and the share of failing rows that still passes
#: (None: no row may fail).
Check = tuple[str, Column, float | None]


def order_rules() -> list[Check]:
    """Unparseable dates, negative totals, worker null rate."""
    return [
        ("order_date_unparseable", F.col("order_date").isNull(), None),
        ("total_price_negative", F.col("total_price") < 0, None),
        ("worker_null_rate", F.col("worker").isNull(), V.MAX_NULL_RATE),
    ]


def expense_rules() -> list[Check]:
    """Negative quantities and totals, item name null rate."""
    return [
        ("quantity_negative", F.col("quantity") < 0, None),
        ("total_price_negative", F.col("total_price") < 0, None),
        ("item_name_null_rate", F.col("item_name").isNull(), V.MAX_NULL_RATE),
    ]


def _checked(df: DataFrame, rules: Sequence[Check]) -> DataFrame:
    return _rows(df, [_count(n, failing) if limit is None else _rate(n, failing, limit) for n, failing, limit in rules])


def order_checks(orders: DataFrame) -> DataFrame:
    return _checked(orders, order_rules())


def expense_checks(expenses: DataFrame) -> DataFrame:
    return _checked(expenses, expense_rules())


def outcome(name: str, failing: int, rows: int, limit: float | None) -> dict:
    """One check's row, from counts that are already known."""
    rate = None if limit is None or not rows else failing / rows
    passed = failing == 0 if limit is None else rate is None or rate <= limit
    return {"check_name": name, "failing": failing, "rate": rate, "passed": passed}


def failure(check: dict) -> DataQualityError:
    detail = f"{check['failing']} rows" if check["rate"] is None else f"rate {check['rate']:.2%}"
    return DataQualityError(f"{check['check_name']} failed: {detail}")


def require_columns(df: DataFrame, required: Sequence[str]) -> None:
    """Metadata only; nothing is read."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise DataQualityError(f"missing columns: {missing}")


def column_presence(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Per required column: is it there, and how many rows fill it."""
    metrics = [
        (F.count(F.col(c)) if c in df.columns else F.lit(0).cast("bigint")).alias(f"n{i}")
        for i, c in enumerate(required)
    ]
    cells = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(c in df.columns).alias("is_present"),
            F.col(f"n{i}").alias("filled_rows"),
        )
        for i, c in enumerate(required)
    ]
    return df.agg(F.count("*").alias("rows"), *metrics).select(F.inline(F.array(*cells)))


def enforce(checks: DataFrame) -> None:
    """Raise on the first failed check. Reads one row per check."""
    failed = checks.filter(~F.col("passed")).orderBy("position").take(1)
    if failed:
        raise failure(failed[0].asDict())


def validate_orders(orders: DataFrame) -> None:
    require_columns(orders, V.REQUIRED_ORDER_COLUMNS)
    enforce(order_checks(orders))


def validate_expenses(expenses: DataFrame) -> None:
    require_columns(expenses, V.REQUIRED_EXPENSE_COLUMNS)
    enforce(expense_checks(expenses))


def not_null(df: DataFrame, columns: Sequence[str], where: dict[str, Column] | None = None) -> DataFrame:
    """Null count per column; ``where`` limits a column's test to some rows."""
    where = where or {}
    return _rows(
        df,
        [
            _count(f"not_null_{c}", F.col(c).isNull() & where.get(c, F.lit(True)))
            for c in columns
        ],
    ).drop("position", "rate")


def unique(df: DataFrame, column: str) -> DataFrame:
    """How many values occur more than once. Nulls are not compared."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return _rows(counts, [_count(f"unique_{column}", F.col("n") > 1)]).drop("position", "rate")


def accepted_values(df: DataFrame, accepted: dict[str, Sequence[str]]) -> DataFrame:
    """Rows per column whose value is outside its list. Nulls are not tested."""
    return _rows(
        df,
        [_count(f"accepted_values_{c}", ~F.col(c).isin(list(vs))) for c, vs in accepted.items()],
    ).drop("position", "rate")
