"""Which way round a feed writes its dates: a vote of its rows, not a choice row by row.

``05/06/2023`` reads as May or June. A feed is written by one hand, so the rows that have
one reading only (a day above 12) decide for those that have two.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.functions.dates import only_as, other_reading, parse_date, slashed


def ballots(c: Column, formats: Sequence[str]) -> dict[str, Column]:
    """Aggregates over a date's text: rows for each slashed format alone, and rows with two readings."""
    votes = {f: F.count_if(only_as(c, f, formats)) for f in slashed(formats)}
    return {**votes, "ambiguous": F.count_if(other_reading(c, formats).isNotNull())}


def elected(votes: Mapping[str, int], formats: Sequence[str]) -> str | None:
    """The format that most rows need; on a tie, and without any vote, the first declared."""
    orders = slashed(formats)
    return max(orders, key=lambda f: (votes[f], -orders.index(f))) if orders else None


def in_order(formats: Sequence[str], first: str | None) -> list[str]:
    """The declared formats with one slashed format moved before the others."""
    rest = iter(([first] if first else []) + [f for f in slashed(formats) if f != first])
    return [next(rest) if f in slashed(formats) else f for f in formats]


def vote(df: DataFrame, column: str, formats: Sequence[str], feed: str) -> DataFrame:
    """One row per feed: votes for each format, the one elected, and what it leaves open.

    ``ambiguous`` rows follow the elected format; ``contradicting`` rows can only be read by
    another one, and are. Rows in other formats, and unreadable ones, do not vote.
    """
    orders = slashed(formats)
    names = {f: f"v{i}" for i, f in enumerate(orders)}
    counts = df.groupBy(F.col(feed).alias("feed")).agg(
        *[n.alias(names.get(f, f)) for f, n in ballots(F.col(column), formats).items()]
    )
    best = F.greatest(*[F.col(n) for n in names.values()]) if len(orders) > 1 else F.col("v0")
    chosen, cast = F.lit(None).cast("string"), F.lit(0)
    for f in reversed(orders):
        chosen, cast = F.when(F.col(names[f]) == best, f).otherwise(chosen), cast + F.col(names[f])
    return counts.select(
        "feed",
        *[F.col(n).alias(label(f)) for f, n in names.items()],
        "ambiguous",
        chosen.alias("elected"),
        (cast - best).alias("contradicting"),
    )


def label(fmt: str) -> str:
    return "day_first" if fmt.startswith("d") else "month_first"


def parse_as_voted(df: DataFrame, column: str, formats: Sequence[str], feed: str, name: str) -> DataFrame:
    """Add the date that each row has under its feed's elected format.

    One aggregate over the feeds decides; it has one row per feed, and joins back by feed. A
    hot feed costs no more than others: the vote is counted before it is shuffled, and the
    joined side is broadcast by the optimiser where it is small.
    """
    decided = vote(df, column, formats, feed).select(F.col("feed").alias("__feed"), F.col("elected").alias("__elected"))
    read = None
    for f in slashed(formats):
        dated = parse_date(F.col(column), in_order(formats, f))
        read = F.when(F.col("__elected") == f, dated) if read is None else read.when(F.col("__elected") == f, dated)
    joined = df.join(decided, df[feed].eqNullSafe(F.col("__feed")), "left")
    return joined.withColumn(name, parse_date(F.col(column), formats) if read is None else read).drop("__feed", "__elected")
