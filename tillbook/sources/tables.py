"""Warehouse tables and views, and the CSV sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.operators.columns import enforce_schema
from tillbook.operators.ordering import sort_over_ranges
from tillbook.sources.scratch import write_scratch


def stage_typed(df: DataFrame, schema: str) -> DataFrame:
    """The table's columns and types, written out once in scan order.

    Parsing is the expensive part of a load. Checks, statistics and the sort each
    read these files, a few columns at a time, instead of parsing again.
    """
    return write_scratch(enforce_schema(df, schema))


def in_order(staged: DataFrame, order: Sequence[str]) -> DataFrame:
    """Sorted nulls-last.

    Each written file then covers its own span of the leading key, so readers can
    skip files.
    """
    return sort_over_ranges(staged, [F.col(c).asc_nulls_last() for c in order])


def register(df: DataFrame, name: str) -> None:
    """Name a frame for SQL; nothing is computed."""
    df.createOrReplaceTempView(name)


def source(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def save_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a managed table; running it again gives the same table."""
    df.write.mode("overwrite").partitionBy(*partition_by).saveAsTable(name)


def save_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def save_csv(df: DataFrame, path: str) -> None:
    """Headed CSV without an index column, one file per task."""
    df.write.mode("overwrite").option("header", True).option("quote", '"').option(
        "escape", '"'
    ).csv(path)


def first_rows(df: DataFrame, order: Sequence[Column], n: int):
    """A bounded result on the driver."""
    return df.orderBy(*order).limit(n).toPandas()
