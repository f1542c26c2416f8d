"""Missing-value and blank handling for text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillbook.fixed_values import NA_TOKENS

# What "strip" removes: the whitespace characters people paste into sheets.
WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"


_NA_LIST = ", ".join(f"'{token}'" for token in NA_TOKENS)


def na_to_null_sql(column: str) -> str:
    """Null for text that only spells out "missing"; other text is untouched.

    SQL text, so that a whole frame's columns are one call to the JVM instead of
    one per token and column.
    """
    return f"CASE WHEN `{column}` NOT IN ({_NA_LIST}) THEN `{column}` END AS `{column}`"


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def trimmed_or_null(c: Column) -> Column:
    """Trim spaces, then treat an empty rest as missing."""
    return F.nullif(F.trim(c), F.lit(""))


def folded(c: Column) -> Column:
    """Strip surrounding whitespace of any kind and lower the case."""
    return F.lower(F.btrim(c, F.lit(WHITESPACE)))
