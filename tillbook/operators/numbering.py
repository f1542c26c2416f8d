"""Row numbers over the whole frame or within groups, safe for hot groups.

A plain ``row_number`` window sends each group to one task, and a window without
keys sends everything to one task. Here rows are sorted over ranges by (keys, order),
which cuts any group, whatever its size, over as many ranges as it fills. A window
numbers the rows of each (range, group). Groups lie one after another, so only the
first group of a range can have rows in earlier ranges: one offset per range makes
the numbers global.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillbook.operators.ordering import n_ranges, sort_over_ranges
from tillbook.sources.scratch import write_scratch, write_scratch_by_partition

_AT, _RANGE, _FIRST, _LAST, _ROWS, _SHIFT = "__at", "__range", "__first", "__last", "__rows", "__shift"
_TIE = "__tie"

#: A group is large above so many rows, and above one in LARGE_PART of all: there are fewer
#: than LARGE_PART large groups, whatever the input.
LARGE_ROWS, LARGE_PART = 50_000, 10_000


def _offsets(placed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per range: up to which place its first group reaches, and its rows before the range."""
    pieces = placed.groupBy(_RANGE, *keys).agg(
        F.min(_AT).alias(_FIRST), F.max(_AT).alias(_LAST), F.count("*").alias(_ROWS)
    )
    # Only the first and the last group of a range can go on elsewhere: two rows a range.
    end = F.max(_LAST).over(Window.partitionBy(_RANGE))
    starts = F.col(_FIRST).bitwiseAND((1 << 33) - 1) == 0
    edges = pieces.withColumn("__end", end).filter(starts | (F.col(_LAST) == F.col("__end")))
    before = Window.partitionBy(*keys).orderBy(_FIRST).rowsBetween(Window.unboundedPreceding, -1)
    shifted = edges.withColumn(_SHIFT, F.sum(_ROWS).over(before))
    return shifted.filter(starts).select(
        F.col(_RANGE).alias("__r"), F.col(_LAST).alias("__until"), F.coalesce(_SHIFT, F.lit(0)).alias(_SHIFT)
    )


def number_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str, stored: bool = False
) -> DataFrame:
    """1-based row number within ``keys``; like ``row_number`` but for any group size.

    Null keys form a group. The sorted rows are written to the shared scratch folder when
    this is called: ranges must be the same for numbers and offsets. So is the input, unless
    it is ``stored``: a projection of files, which costs little to read twice. Rows move once,
    in the sort: the sorted copy is stored by range, and numbering reads it range by range.
    """
    by_group = [F.col(k).asc_nulls_first() for k in keys]
    given = df if stored else write_scratch(df)
    ordered = sort_over_ranges(given, [*by_group, *order])
    # After the sort, this id is (range number, position in range).
    placed = write_scratch_by_partition(
        ordered.withColumn(_AT, F.monotonically_increasing_id()), _RANGE, n_ranges(given)
    )
    if keys:
        local = F.row_number().over(Window.partitionBy(_RANGE, *keys).orderBy(_AT))
    else:
        local = F.col(_AT).bitwiseAND((1 << 33) - 1) + 1
    # Broadcast bound: three numbers for each range of the sort.
    numbered = placed.withColumn("__local", local).join(
        F.broadcast(_offsets(placed, keys)), F.col(_RANGE) == F.col("__r")
    )
    shift = F.when(F.col(_AT) <= F.col("__until"), F.col(_SHIFT)).otherwise(F.lit(0))
    return numbered.select(*df.columns, (F.col("__local") + shift).cast("bigint").alias(name))


def number_in_groups(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str, stored: bool = False
) -> DataFrame:
    """The same numbers as ``number_within``, for keys of which most groups are small.

    Small groups are dealt out by their keys and numbered by a window, in one shuffle. Large
    ones, told by a count of all groups, go through ``number_within``. ``stored`` as there.
    """
    given = df if stored else write_scratch(df)
    limit = max(LARGE_ROWS, given.count() // LARGE_PART)
    large = write_scratch(given.groupBy(*keys).agg(F.count("*").alias(_ROWS)).filter(F.col(_ROWS) > limit))
    # Over stored files this id is the same whenever a task is repeated.
    small = given.withColumn(_TIE, F.monotonically_increasing_id())
    numbered = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, _TIE)).cast("bigint").alias(name)
    if large.isEmpty():
        return small.select(*df.columns, numbered)
    named = large.select(*[F.col(k).alias(f"__large_{k}") for k in keys])
    alike = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__large_{k}")) for k in keys])
    # Broadcast bound: the keys of fewer than LARGE_PART groups.
    rest = small.join(F.broadcast(named), alike, "left_anti").select(*df.columns, numbered)
    whole = write_scratch(given.join(F.broadcast(named), alike, "left_semi"))
    return rest.unionByName(number_within(whole, keys, order, name, stored=True))


def number_all(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """1-based sequence over the whole frame in the given order."""
    return number_within(df, [], order, name)
