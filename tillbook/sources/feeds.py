"""CSV feeds as all-text DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.fixed_values import EXPENSE_HEADERS, ORDER_HEADERS
from tillbook.functions.text import na_to_null_sql

ORDERS_FEED = T.StructType([T.StructField(h, T.StringType()) for h in ORDER_HEADERS])
EXPENSES_FEED = T.StructType([T.StructField(h, T.StringType()) for h in EXPENSE_HEADERS])

#: What a read that keeps broken lines adds: the file and the text of such a line, else nulls.
REJECT_COLUMNS = ["reject_file", "reject_line"]


def missing_as_null(df: DataFrame) -> DataFrame:
    """Null for every text cell that only spells out "missing"."""
    return df.selectExpr(
        *[
            na_to_null_sql(f.name) if isinstance(f.dataType, T.StringType) and f.name not in REJECT_COLUMNS else f"`{f.name}`"
            for f in df.schema
        ]
    )


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    multiline: bool = False,
    keep_rejects: bool = False,
) -> DataFrame:
    """A headed CSV as text columns.

    Without a schema the names come from the header line alone; no data is scanned
    to guess types. With one, each file's header is checked against it. Quoted
    line breaks need ``multiline``, which stops files from being split. A line with more
    or fewer cells than the header is an error: no cell is lost or made up. To see that,
    the parser reads all cells of a line, also where few are asked for.

    With ``keep_rejects`` such a line becomes a row with its file and text in
    ``REJECT_COLUMNS``, beside the good ones and from the same parse; its other cells mean
    nothing. ``accepted`` and ``rejected`` tell the two apart.
    """
    reader = spark.read.option("header", True).option("inferSchema", False)
    reader = reader.option("enforceSchema", False).option("multiLine", multiline)
    reader = reader.option("quote", '"').option("escape", '"').option("encoding", "UTF-8")
    reader = reader.option("columnPruning", False)
    if not keep_rejects:
        reader = reader.option("mode", "FAILFAST")
        return missing_as_null((reader if schema is None else reader.schema(schema)).csv(path))
    file, line = REJECT_COLUMNS
    cells = reader.csv(path).schema if schema is None else schema  # without a schema: the header line
    if taken := set(REJECT_COLUMNS) & set(cells.names):
        raise ValueError(f"the feed has columns named {sorted(taken)}")
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", line)
    rows = reader.schema(T.StructType([*cells, T.StructField(line, T.StringType())])).csv(path)
    where = F.when(F.col(line).isNotNull(), F.col("_metadata.file_path"))
    return missing_as_null(rows.select(*cells.names, where.alias(file), line))


def accepted(df: DataFrame) -> DataFrame:
    """The rows of lines that could be read, without ``REJECT_COLUMNS``."""
    return df.filter(F.col(REJECT_COLUMNS[1]).isNull()).drop(*REJECT_COLUMNS)


def rejected(df: DataFrame) -> DataFrame:
    return df.filter(F.col(REJECT_COLUMNS[1]).isNotNull())


def read_orders_csv(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    return read_csv(spark, path, **options)


def read_expenses_csv(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    return read_csv(spark, path, **options)


def read_synthetic_csv(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    return read_csv(spark, path, **options)
