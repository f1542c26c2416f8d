"""Marts by period: after a load, only the months and years that it touched are written.

Monthly facts are stored by year and month, the order fact by year (a customer's sequence
restarts each year, so a late order moves places within its year only). A refresh
replaces the partitions of touched periods and leaves all other files alone.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.plans import marts, staging
from tillbook.sources import tables, versions

MONTH, YEAR = ["year", "month"], ["year"]

Period = tuple[int | None, int | None]


def _fingerprints(rows: DataFrame, date: str, name: str) -> DataFrame:
    """Per month: rows, and sums that another bag of rows does not have."""
    # Two 64-bit sums of differently seeded hashes; decimals, so that they do not overflow.
    big = lambda c: F.sum(c.cast("decimal(38,0)"))
    first, second = F.xxhash64(*rows.columns), F.xxhash64(F.lit(name), *rows.columns)
    return rows.groupBy(F.year(date).alias("year"), F.month(date).alias("month")).agg(
        F.count("*").alias("n"), big(first).alias("a"), big(second).alias("b")
    )


def touched(before: DataFrame | None, after: DataFrame, date: str) -> DataFrame:
    """Year and month of each month whose rows differ between two versions of a table.

    Rows without a date are the month (null, null). One aggregate over each version.
    """
    now = _fingerprints(after, date, "other")
    if before is None:
        return now.select(*MONTH)
    then = _fingerprints(before.select(*after.columns), date, "other")
    both = now.withColumn("side", F.lit(1)).unionByName(then.withColumn("side", F.lit(-1)))
    sums = [F.sum(F.col(c) * F.col("side")).alias(c) for c in ("n", "a", "b")]
    return both.groupBy(*MONTH).agg(*sums).filter("n <> 0 OR a <> 0 OR b <> 0").select(*MONTH)


def touched_months(before: DataFrame | None, after: DataFrame, date: str) -> list[Period]:
    """The same on the driver: a few rows a year."""
    return sorted((tuple(r) for r in touched(before, after, date).collect()), key=str)


def _dated_within(column: str, periods: Sequence[tuple]) -> Column:
    """Rows dated in these months or years, as bounds on the date that files can be skipped by."""
    out = F.lit(False)
    for year, *month in periods:
        if year is None:
            out = out | F.col(column).isNull()
            continue
        first = dt.date(year, month[0] if month else 1, 1)
        after = dt.date(year + 1, 1, 1) if not month or first.month == 12 else dt.date(year, first.month + 1, 1)
        out = out | ((F.col(column) >= F.lit(first)) & (F.col(column) < F.lit(after)))
    return out


def _replace(spark: SparkSession, df: DataFrame, path: str, by: Sequence[str], periods: Sequence[tuple]) -> None:
    """Write the periods' partitions anew; those that have no rows any more go."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    left = {tuple(r) for r in df.select(*by).distinct().collect()}
    for period in set(periods) - left:
        parts = ["__HIVE_DEFAULT_PARTITION__" if v is None else str(v) for v in period]
        folder = "/".join(f"{name}={part}" for name, part in zip(by, parts, strict=True))
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{folder}")
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def monthly(share: str) -> dict[str, Callable[[DataFrame, DataFrame], DataFrame]]:
    return {
        "fct_monthly_revenue": lambda orders, expenses: marts.fct_monthly_revenue(orders),
        "fct_monthly_expenses": lambda orders, expenses: marts.fct_monthly_expenses(expenses),
        "fct_salary": lambda orders, expenses: marts.fct_salary(orders, share),
        "fct_profit": lambda orders, expenses: marts.fct_profit(orders, expenses, share),
    }


def refresh_marts(spark: SparkSession, warehouse: str, share: str, since: int | None = None) -> dict[str, list[Period]]:
    """Bring the marts by period up to the newest load; returns the periods written.

    ``since`` is the number of the manifest that the marts were last built from: periods that
    differ between it and the newest are written anew. Without it all are. Marts lie in
    ``marts/<name>`` of the warehouse and are named in the catalog.
    """
    now = versions.snapshot(spark, warehouse)
    then = {} if since is None else versions.snapshot(spark, warehouse, since)
    orders, expenses = now["raw_orders"], now["raw_expenses"]
    of_orders = touched_months(then.get("raw_orders"), orders, "order_date")
    of_expenses = touched_months(then.get("raw_expenses"), expenses, "expense_date")
    months = sorted({*of_orders, *of_expenses}, key=str)
    years = sorted({(year,) for year, _ in of_orders}, key=str)
    folder = lambda name: f"{warehouse.rstrip('/')}/marts/{name}"
    if years:
        staged = staging.staged_orders(orders.filter(_dated_within("order_date", years)))
        _replace(spark, marts.fct_orders(staged, stored=True), folder("fct_orders"), YEAR, years)
        versions.point(spark, "fct_orders", folder("fct_orders"))
    if months:
        # The monthly facts need no sequence, so they read the raw tables' months alone.
        some_orders = staging.staged_orders(orders.filter(_dated_within("order_date", months)))
        some_bills = staging.stg_expenses(expenses.filter(_dated_within("expense_date", months)))
        for name, build in monthly(share).items():
            _replace(spark, build(some_orders, some_bills), folder(name), MONTH, months)
            versions.point(spark, name, folder(name))
    return {"months": months, "years": years}


def assign_order_ids(spark: SparkSession, warehouse: str, width: int = 4) -> int:
    """Give the newest load's orders ids that stay; returns the manifest's number.

    Publishes ``orders_with_ids`` and ``order_ids``, the ids given so far, which the next call
    goes on from.
    """
    now = versions.snapshot(spark, warehouse)
    staged = staging.staged_orders(now["raw_orders"])
    with_ids, ids = marts.stable_order_ids(staged, now.get("order_ids"), width)
    run = versions.new_run()
    written = {name: f"{versions.run_folder(warehouse, run)}/{name}" for name in ("order_ids", "orders_with_ids")}
    tables.save_parquet(ids, written["order_ids"])
    tables.save_parquet(with_ids, written["orders_with_ids"])
    return versions.publish(spark, warehouse, run, written)
