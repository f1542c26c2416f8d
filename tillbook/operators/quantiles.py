"""Exact descriptive statistics of number columns in bounded memory.

The built-in exact percentile keeps every distinct value of a column in one task.
Here 32-bit values are first counted by their high half: at most 65,536 rows per column,
enough to find which halves hold the wanted ranks. Only those are then counted
value by value, again at most 65,536 rows each. Other numbers get a 64-bit image that
sorts as they do, and are refined alike, 16 bits a pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.sources.scratch import write_scratch

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def describe_ints(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: count, mean, std, min, quartiles, max; nulls ignored.

    Quartiles interpolate linearly between neighbours. A column whose cells are all
    null has count 0 and nulls elsewhere.
    """
    types = dict(df.dtypes)
    bad = [c for c in columns if types[c] not in ("tinyint", "smallint", "int")]
    if bad:
        raise TypeError(f"32-bit integer columns expected, got {bad}")

    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("v")) for c in columns])
    values = df.select(F.inline(cells)).withColumn("half", F.shiftright("v", 16))

    # Written out because several small steps below read it: the ledger itself is
    # then scanned twice in all, here and for the values near the wanted ranks.
    halves = write_scratch(
        values.groupBy("column_name", "half").agg(
            F.count("v").alias("n"),
            F.avg("v").alias("mean"),
            F.var_pop("v").alias("var"),
            F.min("v").alias("lo"),
            F.max("v").alias("hi"),
        )
    )

    # Means and variances of the parts combine exactly into those of the whole.
    sums = halves.groupBy("column_name").agg(
        F.sum("n").alias("count"),
        (F.sum(F.col("n") * F.col("mean")) / F.nullif(F.sum("n"), F.lit(0))).alias("mean"),
        F.min("lo").alias("min"),
        F.max("hi").alias("max"),
    )
    spread = (
        halves.filter("n > 0")
        .join(F.broadcast(sums.select("column_name", "count", F.col("mean").alias("m"))), "column_name")
        .groupBy("column_name")
        .agg(
            F.sum(
                F.col("n") * (F.col("var") + (F.col("mean") - F.col("m")) * (F.col("mean") - F.col("m")))
            ).alias("squares"),
            F.first("count").alias("c"),
        )
        .select(
            "column_name",
            F.when(F.col("c") > 1, F.sqrt(F.col("squares") / (F.col("c") - 1))).alias("std"),
        )
    )

    running = Window.partitionBy("column_name").orderBy("half").rowsBetween(
        Window.unboundedPreceding, -1
    )
    whole = Window.partitionBy("column_name")
    ranked = halves.filter("n > 0").select(
        "column_name",
        "half",
        "n",
        F.coalesce(F.sum("n").over(running), F.lit(0)).alias("before"),
        F.sum("n").over(whole).alias("total"),
    )
    wanted = F.array(
        *[F.struct(F.lit(q).alias("q"), F.lit(share).alias("share")) for q, share in QUARTILES.items()]
    )
    # Per column and quartile, the two ranks to read and where they lie.
    spots = (
        ranked.select("*", F.inline(wanted))
        .withColumn("at", (F.col("total") - 1) * F.col("share"))
        .select("*", F.explode(F.array_distinct(F.array(F.floor("at"), F.ceil("at")))).alias("rank"))
        .filter((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n")))
        .select("column_name", "half", "before", "q", "at", "rank")
    )
    # Broadcast bound: six rows per described column.
    near = values.join(
        F.broadcast(spots.select("column_name", "half", "before").distinct()), ["column_name", "half"]
    )
    counted = near.groupBy("column_name", "half", "before", "v").agg(F.count("*").alias("n"))
    inner = Window.partitionBy("column_name", "half").orderBy("v").rowsBetween(
        Window.unboundedPreceding, -1
    )
    placed = counted.select(
        "column_name",
        "half",
        "v",
        "n",
        (F.col("before") + F.coalesce(F.sum("n").over(inner), F.lit(0))).alias("first"),
    )
    found = placed.join(
        F.broadcast(spots.select("column_name", "half", "q", "at", "rank")), ["column_name", "half"]
    ).filter((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("n")))
    quartiles = found.groupBy("column_name").agg(*[_interpolated(q).alias(q) for q in QUARTILES])
    return (
        sums.join(F.broadcast(spread), "column_name", "left")
        .join(F.broadcast(quartiles), "column_name", "left")
        .select("column_name", "count", "mean", "std", "min", *QUARTILES, "max")
    )


def _interpolated(q: str):
    mine = F.col("q") == q
    low = F.min(F.when(mine, F.col("v")))
    high = F.max(F.when(mine, F.col("v")))
    at = F.max(F.when(mine, F.col("at")))
    return low + (at - F.floor(at)) * (high - low)


#: Bits that a pass settles, and passes over an image.
DIGIT, PASSES = 16, 4
_LEAST = -(1 << 63)


def _image(c: Column, kind: T.DataType) -> Column:
    """A long whose unsigned order is the numbers' order; null for null and NaN."""
    if isinstance(kind, T.IntegralType):
        return c.cast("bigint").bitwiseXOR(F.lit(_LEAST))
    if isinstance(kind, T.DecimalType):
        if kind.precision > 18:
            raise TypeError(f"decimals of up to 18 digits expected, got {kind.simpleString()}")
        return (c * F.lit(Decimal(10) ** kind.scale)).cast("bigint").bitwiseXOR(F.lit(_LEAST))
    if isinstance(kind, T.FractionalType):
        # Adding zero makes one zero of the two.
        number = F.nanvl(c.cast("double"), F.lit(None).cast("double")) + F.lit(0.0)
        bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), F.coalesce(number, F.lit(0.0))).cast("bigint")
        return F.when(number.isNotNull(), F.when(bits < 0, F.bitwise_not(bits)).otherwise(bits.bitwiseXOR(F.lit(_LEAST))))
    raise TypeError(f"a number expected, got {kind.simpleString()}")


def describe_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: count, mean, std, min, quartiles, max, all but the count as doubles.

    Columns may be integers of any width, decimals of up to 18 digits, floats or doubles; nulls
    and NaN are ignored. Quartiles are those of the exact values in rank, interpolated linearly
    between neighbours. The images are written to the shared scratch folder once and counted
    four times; each pass brings at most six rows per column to the driver.
    """
    schema = df.schema
    cells = [
        F.struct(F.lit(c).alias("column_name"), _image(F.col(c), schema[c].dataType).alias("i"), F.col(c).cast("double").alias("v"))
        for c in columns
    ]
    if not cells:
        raise ValueError("no columns to describe")
    images = write_scratch(df.select(F.inline(F.array(*cells))).filter(F.col("i").isNotNull()))
    names = df.sparkSession.createDataFrame([(i, c) for i, c in enumerate(columns)], "position int, column_name string")
    moments = names.join(
        images.groupBy("column_name").agg(
            F.count("*").alias("count"),
            F.avg("v").alias("mean"),
            F.stddev_samp("v").alias("std"),
            F.min("v").alias("min"),
            F.max("v").alias("max"),
        ),
        "column_name",
        "left",
    ).withColumn("count", F.coalesce("count", F.lit(0)))
    figures = {r["column_name"]: r for r in moments.collect()}

    # Ranks still to be found: (column, bits settled, rank among the values with these bits, rank).
    open_ranks = []
    for c, r in figures.items():
        at = [share * (r["count"] - 1) for share in QUARTILES.values()]
        ranks = {k for x in at for k in (int(x), int(x) + (x > int(x)))} if r["count"] else ()
        open_ranks += [(c, 0, k, k) for k in sorted(ranks)]
    for k in range(PASSES):
        open_ranks = _refined(images, open_ranks, k)
    found = {(r[0], r[3]): r[4] for r in open_ranks}
    rows = []
    for c in columns:
        r = figures[c]
        quartiles = [_between(found, c, share * (r["count"] - 1)) if r["count"] else None for share in QUARTILES.values()]
        rows.append((c, r["count"], r["mean"], r["std"], r["min"], *quartiles, r["max"]))
    ddl = ", ".join(f"{name} double" for name in ("mean", "std", "min", *QUARTILES, "max"))
    return df.sparkSession.createDataFrame(rows, f"column_name string, count bigint, {ddl}")


def _between(found: dict, column: str, at: float) -> float:
    low = found[column, int(at)]
    high = found[column, int(at) + (at > int(at))]
    return low if low == high else low + (at - int(at)) * (high - low)


def _refined(images: DataFrame, open_ranks: list[tuple], k: int) -> list[tuple]:
    """Settle 16 more bits of each open rank's image; with the last, the value is known."""
    if not open_ranks:
        return []
    spark = images.sparkSession
    wanted = spark.createDataFrame([r[:4] for r in open_ranks], "column_name string, bits bigint, rank bigint, whole bigint")
    settled = F.shiftrightunsigned("i", 64 - DIGIT * k) if k else F.lit(0).cast("bigint")
    digit = F.shiftrightunsigned("i", 64 - DIGIT * (k + 1)).bitwiseAND((1 << DIGIT) - 1)
    # Broadcast bound: six rows per column.
    near = images.select("column_name", settled.alias("bits"), digit.alias("digit"), "v").join(
        F.broadcast(wanted.select("column_name", "bits").distinct()), ["column_name", "bits"]
    )
    counted = near.groupBy("column_name", "bits", "digit").agg(F.count("*").alias("n"), F.min("v").alias("v"))
    # At most 65,536 rows for each open image.
    before = Window.partitionBy("column_name", "bits").orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    hit = placed.join(F.broadcast(wanted), ["column_name", "bits"]).filter(
        (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("n"))
    )
    more = (F.shiftleft("bits", DIGIT) + F.col("digit")).alias("bits")
    return [tuple(r) for r in hit.select("column_name", more, (F.col("rank") - F.col("first")).alias("rank"), "whole", "v").collect()]
