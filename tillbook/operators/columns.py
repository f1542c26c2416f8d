"""Renames, projections, row filters and schema alignment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.functions.numbers import to_number


def rename(df: DataFrame, headers: Mapping[str, str]) -> DataFrame:
    """Rename by map; headers the frame lacks are ignored.

    Matching is exact in case: two feeds differ only in ``Total harga`` and
    ``Total Harga``, and Spark's own rename would accept either for both.
    """
    return df.withColumnsRenamed({old: new for old, new in headers.items() if old in df.columns})


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly these columns; an absent one is an AnalysisException."""
    return df.select(*columns)


def project_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """These columns in this order, as far as the frame has them."""
    return df.select(*[c for c in columns if c in df.columns])


def keep_up_to(df: DataFrame, marker: str) -> DataFrame:
    """The leading columns up to and including ``marker``."""
    if marker not in df.columns:
        raise ValueError(f"column {marker!r} not found")
    return df.select(*df.columns[: df.columns.index(marker) + 1])


def enforce_schema(df: DataFrame, schema: str | T.StructType) -> DataFrame:
    """Exactly the given columns and types; absent columns become typed nulls."""
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in wanted
        ]
    )


def with_lineage(
    df: DataFrame, data_source: str | Column, is_synthetic: bool | Column
) -> DataFrame:
    """Set where the rows came from, replacing any column of that name."""
    as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
    return df.withColumns(
        {"data_source": as_column(data_source), "is_synthetic": as_column(is_synthetic)}
    )


def keep_numeric(df: DataFrame, column: str) -> DataFrame:
    """Rows whose text reads as a number; drops headings and summary lines."""
    return df.filter(to_number(F.col(column)).isNotNull())


def drop_null(df: DataFrame, column: str) -> DataFrame:
    return df.dropna(subset=[column])


def drop_placeholders(df: DataFrame) -> DataFrame:
    """Orders with a customer and a positive total."""
    return df.filter(F.col("customer_name").isNotNull() & (F.col("total_price") > 0))


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """Union-all by column name; a column some feed lacks is null for its rows."""
    first, *rest = feeds
    for feed in rest:
        first = first.unionByName(feed, allowMissingColumns=True)
    return first
