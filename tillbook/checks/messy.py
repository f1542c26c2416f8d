"""Ledger-shaped text derived from the benchmark tables.

The benchmark tables are clean; ledgers are not. Each benchmark order becomes one
ledger order, each line item one expense, with the spellings, gaps and formats that
the cleaning has to cope with chosen by arithmetic on the row's keys. One scan, no
join and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook import fixed_values as V

SHOES = [
    "On Cloud", "cloud tec", "Nike AJ1", "adidas samba", "NB", "New Balance", "Converse High",
    "gatau", "???", "", None, "vans", "CloudTec",
]
SERVICES = [
    "Deep Clean", "deep clean express", "Fast Clean", "Tas", "KARPET", "sendal",
    "Reparasi lem", "Cuci",
]
ORDER_NOTES = ["BCA", "bayar cash", None, "", "BLU", "  x "]
STATUSES = ["Paid", "paid", "", "N/A", "NULL", "nan", None]
WORKERS = ["Vian", "Rio", "Amory", None]
DISCOUNTS = [-20000, 0, 5000, 8000, 10000, 50000, 1234, None, 0]
MONTH_NOTES = [
    "Januari", " februari", "MARET", "April", "Mei ", "juni", "Juli", "agustus", "September",
    "oktober", "November", "DESEMBER", "x", None,
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _nth(values: list, index: Column) -> Column:
    literals = ", ".join("NULL" if v is None else repr(v) for v in values)
    return F.element_at(F.expr(f"array({literals})"), (index + 1).cast("int"))


def _text(n: Column) -> Column:
    return n.cast("string")


def _dotted(n: Column) -> Column:
    return F.translate(F.format_number(n, 0), ",", ".")


def _rupiah(n: Column) -> Column:
    return F.concat(F.lit("Rp"), _dotted(n))


def orders_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All order feeds in one frame of text, with their labels."""
    k, buyer = F.col("o_orderkey"), F.col("o_custkey")
    synthetic = F.col("o_orderstatus") == "P"
    source = (
        F.when(F.col("o_orderstatus") == "F", V.REAL_2023)
        .when(F.col("o_orderstatus") == "O", V.REAL_2025)
        .otherwise(V.SYNTHETIC_ORDERS)
    )

    day = F.col("o_orderdate").cast("date")
    day = F.when(F.year(day) >= 1999, F.add_months(day, 48)).otherwise(day)
    day_text = (
        F.when(synthetic | (k % 4 == 0), F.date_format(day, "yyyy-MM-dd"))
        .when(k % 499 == 3, F.lit("belum tahu"))
        .when(k % 4 == 2, F.date_format(day, "d/M/yyyy"))
        .otherwise(F.date_format(day, "dd/MM/yyyy"))
    )

    plain_name = F.concat(F.lit("Pelanggan "), _text(buyer))
    name = (
        F.when(k % 53 == 0, F.lit(None))
        .when(buyer % 97 == 0, F.lit("Kost no 12"))
        .when(buyer % 97 == 1, F.lit("Temen Putri"))
        .when(buyer % 97 <= 20, F.concat(F.lit("Kak "), plain_name))
        .when(buyer % 97 <= 30, F.concat(F.lit("Mas "), plain_name))
        .otherwise(plain_name)
    )

    price = F.floor("o_totalprice")
    price_text = (
        F.when(synthetic | (k % 5 == 2), _text(price))
        .when(k % 5 == 0, _rupiah(price))
        .when(k % 5 == 1, F.concat(_rupiah(price), F.lit(",00")))
        .when(k % 5 == 3, F.concat(F.lit("Rp "), _dotted(price)))
        .when(k % 10 == 4, F.lit("gratis"))
    )
    off = F.when(k % 131 == 0, price).otherwise(_nth(DISCOUNTS, k % 9).cast("bigint"))
    off_text = F.when(synthetic, _text(off)).otherwise(_rupiah(off))
    total = F.when(k % 101 == 0, F.lit(0)).otherwise(price - F.coalesce(off, F.lit(0)))
    total_text = F.when(synthetic, _text(total)).otherwise(_rupiah(total))

    return table(spark, sf_dir, "orders").select(
        _text(F.when(k % 50 == 1, k - 1).otherwise(k)).alias("No"),
        day_text.alias("Tanggal"),
        name.alias("Nama"),
        _nth(SHOES, k % 13).alias("Jenis Sepatu"),
        F.when(k % 17 != 0, _nth(SERVICES, k % 8)).alias("Jenis cuci"),
        price_text.alias("Harga"),
        off_text.alias("Discount"),
        total_text.alias("Total harga"),
        _nth(ORDER_NOTES, k % 6).alias("Keterangan"),
        _nth(STATUSES, k % 7).alias("Status Pembayaran"),
        _nth(WORKERS, buyer % 4).alias("Kang Cuci"),
        source.alias("data_source"),
        synthetic.alias("is_synthetic"),
    )


def expenses_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All expense feeds in one frame of text, with their labels."""
    k, line = F.col("l_orderkey"), F.col("l_linenumber")
    part, supplier = F.col("l_partkey"), F.col("l_suppkey")
    synthetic = F.col("l_returnflag") == "N"
    source = (
        F.when(F.col("l_returnflag") == "R", V.REAL_2023)
        .when(F.col("l_returnflag") == "A", V.REAL_2025)
        .otherwise(V.SYNTHETIC_SUPPLIES)
    )

    day = F.col("l_shipdate").cast("date")
    day_text = (
        F.when(synthetic, F.date_format(day, "yyyy-MM-dd"))
        .when(k % 10 == 0, F.lit(None))
        .when(k % 97 == 3, F.lit("belum tahu"))
        .when(k % 4 == 1, F.date_format(day, "MM/dd/yyyy"))
        .when(k % 4 == 2, F.date_format(day, "dd/MM/yyyy"))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
    )
    brand = (
        F.when(k % 20 == 0, F.lit(" Gaji "))
        .when(k % 10 == 0, F.lit("GAJI"))
        .when(line == 7, F.lit(""))
        .when(supplier % 29 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("Brand "), _text(supplier % 25)))
    )
    notes = (
        F.when(k % 10 == 0, _nth(MONTH_NOTES, part % 14))
        .when(line % 3 == 0, F.lit(""))
        .when(line % 3 == 1, F.lit("ok"))
    )

    price, count = F.floor("l_extendedprice"), F.col("l_quantity").cast("int")
    price_text = (
        F.when(synthetic | (part % 4 == 2), _text(price))
        .when(part % 4 == 0, _rupiah(price))
        .when(part % 4 == 1, F.concat(_rupiah(price), F.lit(",00")))
        .when(part % 12 != 3, F.concat(F.lit("Rp "), _dotted(price)))
    )
    count_text = (
        F.when(synthetic, _text(count))
        .when(k % 37 == 1, F.concat(_text(count), F.lit(".5")))
        .when(k % 37 == 2, F.lit("abc"))
        .when(k % 37 == 3, F.concat(_text(count), F.lit("e0")))
        .when(k % 501 == 9, F.concat(F.lit("-"), _text(count)))
        .otherwise(_text(count))
    )
    total = price * count + F.when(k % 11 == 0, F.lit(1000)).otherwise(F.lit(0))
    total_text = (
        F.when(k % 41 == 0, F.lit(None)).when(synthetic, _text(total)).otherwise(_rupiah(total))
    )

    return table(spark, sf_dir, "lineitem").select(
        day_text.alias("Tanggal"),
        F.when(k % 23 != 0, F.concat(F.lit("Barang "), _text(part % 1000))).alias("Nama Barang"),
        brand.alias("Merk"),
        price_text.alias("Harga"),
        count_text.alias("Jumlah"),
        total_text.alias("Total Harga"),
        notes.alias("Keterangan"),
        source.alias("data_source"),
        synthetic.alias("is_synthetic"),
    )


def feed(all_feeds: DataFrame, label: str) -> DataFrame:
    """One feed, as its file would hold it: no labels, and ``is_synthetic`` as text
    in the synthetic ones only."""
    one = all_feeds.filter(F.col("data_source") == label).drop("data_source")
    if label in (V.SYNTHETIC_ORDERS, V.SYNTHETIC_SUPPLIES):
        return one.withColumn("is_synthetic", F.lit("True"))
    return one.drop("is_synthetic")
