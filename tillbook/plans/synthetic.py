"""Synthetic feeds at any size.

Each row is a function of its own id, so the work spreads freely and a retried
task gives the same rows. The mix of services, prices, discounts, shoes, customers
and workers follows the configured distribution.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook import fixed_values as V
from tillbook.functions.draws import draw_below, pick, pick_weighted
from tillbook.operators.numbering import number_all


def _price(service: Column, row_id: Column) -> Column:
    """A price from the service's own list."""
    lists = F.create_map(
        *[
            x
            for name, prices in V.SYNTH_PRICES.items()
            for x in (F.lit(name), F.array(*[F.lit(p) for p in prices]))
        ]
    )
    choices = F.element_at(lists, service)
    return F.element_at(choices, draw_below(row_id, 3, F.size(choices)) + 1)


def order_draws(
    ids: DataFrame,
    start: date,
    end: date,
    id_column: str = "id",
    workers: Sequence[str] = tuple(V.SYNTH_WORKERS),
) -> DataFrame:
    """One synthetic order per id, not yet sorted or numbered. No shuffle."""
    if end < start:
        raise ValueError("end lies before start")
    row_id = F.col(id_column)
    days = (end - start).days + 1
    base = ids.select(
        row_id.alias("id"),
        F.date_add(F.lit(start), draw_below(row_id, 1, days)).alias("Tanggal"),
        pick(row_id, 6, V.SYNTH_CUSTOMERS).alias("Nama"),
        pick_weighted(row_id, 2, V.SYNTH_SERVICE_PERCENT).alias("Jenis cuci"),
        pick(row_id, 4, V.SYNTH_DISCOUNTS).alias("Discount"),
        pick(row_id, 7, list(workers)).alias("Kang Cuci"),
    )
    service = F.col("Jenis cuci")
    not_a_shoe = F.lower(service).isin(V.NON_SHOE_SERVICES)
    priced = base.withColumns(
        {
            "Jenis Sepatu": F.when(not_a_shoe, F.initcap(service)).otherwise(
                pick(F.col("id"), 5, V.SYNTH_SHOES)
            ),
            "Harga": _price(service, F.col("id")),
        }
    )
    return priced.select(
        "id", "Tanggal", "Nama", "Jenis Sepatu", "Jenis cuci", "Harga", "Discount",
        (F.col("Harga") - F.col("Discount")).alias("Total harga"),
        F.lit(V.SYNTH_NOTE).alias("Keterangan"),
        F.lit(V.SYNTH_PAYMENT_STATUS).alias("Status Pembayaran"),
        "Kang Cuci",
        F.lit(True).alias("is_synthetic"),
    )


def number_feed(drawn: DataFrame) -> DataFrame:
    """Sort by date (ties by id) and put the 1-based ``No`` first."""
    numbered = number_all(drawn, [F.col("Tanggal").asc(), F.col("id").asc()], "No")
    return numbered.select("No", *[c for c in drawn.columns if c != "id"])


def generate_orders(
    spark: SparkSession,
    start: date,
    end: date,
    n_orders: int,
    workers: Sequence[str] = tuple(V.SYNTH_WORKERS),
) -> DataFrame:
    return number_feed(order_draws(spark.range(n_orders), start, end, workers=workers))


def generate_supplies(items: DataFrame, start: date, end: date) -> DataFrame:
    """Recurring purchases: each item every k months while the due date is in range.

    ``items`` has (item_id, item_name, brand, unit_price, quantity, every_months).
    The purchase happens up to ten days after it is due, so it may fall past
    ``end``. Rows come by date, ties by item and turn. A start day above 28 is refused: months lack it.
    """
    if start.day > 28:
        raise ValueError("start day must be 28 or less")
    due = F.sequence(
        F.lit(start), F.lit(end), F.make_ym_interval(F.lit(0), F.col("every_months").cast("int"))
    )
    planned = items.select("*", F.posexplode(due).alias("turn", "due_date"))
    seed = F.col("item_id").cast("bigint") * 1021 + F.col("turn")
    late = draw_below(seed, 8, V.SUPPLY_JITTER_DAYS + 1)
    dated = planned.withColumn("Tanggal", F.date_add("due_date", late)).orderBy("Tanggal", "item_id", "turn")
    return dated.select(
        "Tanggal",
        F.col("item_name").alias("Nama Barang"),
        F.col("brand").alias("Merk"),
        F.col("unit_price").alias("Harga"),
        F.col("quantity").alias("Jumlah"),
        (F.col("unit_price") * F.col("quantity")).alias("Total Harga"),
        F.lit("").alias("Keterangan"),
        F.lit(True).alias("is_synthetic"),
    )
