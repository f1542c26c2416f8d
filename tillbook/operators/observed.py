"""Figures of a frame that are gathered while it is written, at no scan of their own."""

from __future__ import annotations

import math
from collections.abc import Collection, Iterable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.operators.quality import Check


def figures(df: DataFrame, good: Column, rules: Sequence[Check], date_column: str, other_date: str, leave_out: Collection[str]) -> list[Column]:
    """Aggregates for ``DataFrame.observe`` over the rows where ``good`` holds.

    Rows, nulls per column, failing rows per check, the span of dates under both readings, and
    mean, variance and range of each price.
    """
    only = lambda c: F.when(good, c)
    names = [c for c in df.columns if c not in leave_out]
    out = [F.count_if(good).alias("rows")]
    out += [F.count_if(good & F.col(c).isNull()).alias(f"null:{c}") for c in names]
    out += [F.count_if(good & failing).alias(f"fail:{name}") for name, failing, _ in rules]
    day = F.col(date_column)
    for reading, c in (("as_declared", day), ("turned", F.coalesce(F.col(other_date), day))):
        out += [F.min(only(c)).alias(f"from:{reading}"), F.max(only(c)).alias(f"to:{reading}")]
    for c in prices(names):
        v = only(F.col(c))
        out += [F.avg(v).alias(f"mean:{c}"), F.var_pop(v).alias(f"var:{c}"), F.min(v).alias(f"min:{c}"), F.max(v).alias(f"max:{c}")]
    return out


def prices(names: Iterable[str]) -> list[str]:
    """Columns named like a price: ``price`` as written, ``harga`` in any case."""
    return [c for c in names if "price" in c or "harga" in c.lower()]


class Figures:
    """What one feed's rows came to."""

    def __init__(self, values: Mapping[str, object], rules: Sequence[Check], turned: bool):
        self.values = dict(values)
        self.rows: int = self.values["rows"]
        self.nulls = {k.removeprefix("null:"): n for k, n in self.values.items() if k.startswith("null:")}
        self.failing = {name: self.values[f"fail:{name}"] for name, _, _ in rules}
        reading = "turned" if turned else "as_declared"
        self.earliest: date | None = self.values[f"from:{reading}"]
        self.latest: date | None = self.values[f"to:{reading}"]

    def filled(self, column: str) -> int:
        return self.rows - self.nulls[column]


def spread(parts: Iterable[Figures], column: str) -> tuple:
    """(count, mean, std, min, max) of a price over several feeds, from those of each."""
    some = [(p.filled(column), p.values) for p in parts if p.filled(column)]
    n = sum(k for k, _ in some)
    if not n:
        return 0, None, None, None, None
    mean = math.fsum(k * v[f"mean:{column}"] for k, v in some) / n
    squares = math.fsum(k * (v[f"var:{column}"] + (v[f"mean:{column}"] - mean) ** 2) for k, v in some)
    std = math.sqrt(squares / (n - 1)) if n > 1 else None
    return n, mean, std, min(v[f"min:{column}"] for _, v in some), max(v[f"max:{column}"] for _, v in some)
