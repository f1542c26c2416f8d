"""A snapshot of a frame: shape, nulls, price statistics, head, value counts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.operators import quality
from tillbook.operators.observed import Figures, prices, spread
from tillbook.operators.quantiles import describe_ints, describe_numbers


def price_columns(df: DataFrame) -> list[str]:
    return prices(df.columns)


def shape(df: DataFrame) -> DataFrame:
    """One row per column with its type and the frame's row count."""
    cells = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("data_type"),
            F.col("row_count"),
        )
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    return df.agg(F.count("*").alias("row_count")).select(F.inline(F.array(*cells)))


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, all columns in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in df.columns]
    return counted.select(F.inline(F.array(*cells)))


def null_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    rates = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in columns])
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rate")) for c in columns]
    return rates.select(F.inline(F.array(*cells)))


def price_stats(df: DataFrame) -> DataFrame:
    """Statistics of the price columns; 32-bit ones keep their type and take fewer passes."""
    names = price_columns(df)
    small = all(isinstance(df.schema[c].dataType, (T.ByteType, T.ShortType, T.IntegerType)) for c in names)
    return describe_ints(df, names) if small else describe_numbers(df, names)


def head(df: DataFrame, order: Sequence[Column], n: int = 5) -> DataFrame:
    """The first rows of a stated order; planned as a per-task top-n, not a sort."""
    return df.orderBy(*order).limit(n)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; nulls left out."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), column)
    )


def inspect(df: DataFrame, order: Sequence[Column]) -> dict[str, DataFrame]:
    """What to look at before a load: shape, nulls, first rows, price statistics."""
    found = {"shape": shape(df), "null_counts": null_counts(df), "head": head(df, order)}
    if price_columns(df):
        found["price_stats"] = price_stats(df)
    return found


def date_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("earliest"), F.max(column).alias("latest"))


def source_summary(df: DataFrame, date_column: str) -> DataFrame:
    """Per source: rows, first and last date, mean total."""
    return (
        df.groupBy("data_source")
        .agg(
            F.count("*").alias("row_count"),
            F.min(date_column).alias("earliest"),
            F.max(date_column).alias("latest"),
            F.avg("total_price").alias("avg_total_price"),
        )
        .orderBy("data_source")
    )


# --- the same from figures that were gathered while the frame was written -----------


def observed_checks(parts: Iterable[Figures], rules: Sequence[quality.Check]) -> list[dict]:
    parts = list(parts)
    rows = sum(p.rows for p in parts)
    return [quality.outcome(name, sum(p.failing[name] for p in parts), rows, limit) for name, _, limit in rules]


def observed(spark: SparkSession, name: str, parts: Mapping[str, Figures], schema: str, checks: list[dict]) -> dict[str, DataFrame]:
    """Summary per source, shape, nulls, prices and checks of one table, from its feeds' figures."""
    fields = T.StructType.fromDDL(schema).fields
    rows = sum(p.rows for p in parts.values())
    summary = [
        (label, p.rows, p.earliest, p.latest, spread([p], "total_price")[1]) for label, p in sorted(parts.items()) if p.rows
    ]
    frames = {
        "": (summary, "data_source string, row_count bigint, earliest date, latest date, avg_total_price double"),
        "_shape": (
            [(i, f.name, f.dataType.simpleString(), rows) for i, f in enumerate(fields)],
            "position int, column_name string, data_type string, row_count bigint",
        ),
        "_nulls": (
            [(f.name, sum(p.nulls[f.name] for p in parts.values())) for f in fields],
            "column_name string, null_count bigint",
        ),
        "_prices": (
            [(c, *spread(parts.values(), c)) for c in prices(f.name for f in fields)],
            "column_name string, count bigint, mean double, std double, min int, max int",
        ),
        "_checks": (
            [(c["check_name"], c["failing"], c["rate"], c["passed"]) for c in checks],
            "check_name string, failing bigint, rate double, passed boolean",
        ),
    }
    return {name + part: spark.createDataFrame(found, ddl) for part, (found, ddl) in frames.items()}
