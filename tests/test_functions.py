"""Edge rows per cleaning expression."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillbook.functions import dates, numbers, rules, text
from tillbook.operators.columns import keep_numeric
from tillbook.sources.feeds import missing_as_null


def apply(spark, values, fn, ddl="string"):
    """fn over a one-column frame, results in input order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {ddl}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def check(spark, cases, fn, ddl="string"):
    assert apply(spark, [c[0] for c in cases], fn, ddl) == [c[1] for c in cases]


def test_rupiah(spark):
    check(
        spark,
        [
            ("Rp50.000", 50000), ("Rp67.400,00", 67400), ("Rp-20.000", -20000),
            ("-Rp20.000", -20000), ("-Rp1.234,50", -1235), ("Rp67.400,5", 6740),
            ("Rp1,500", 15), ("Rp 50.000", 50000), ("Rp\xa050.000", 50000), ("50.000", 50000),
            ("rp50.000", None), ("Rp50.000,-", None), ("", None), ("gratis", None), (None, None),
            ("9999999999", None), ("0", 0),
        ],
        numbers.rupiah_to_int,
    )


def test_number_to_int(spark):
    check(
        spark,
        [
            ("2", 2), ("2.5", 2), ("1.5", 2), ("3.5", 4), ("1e3", 1000), (" 7 ", 7), ("-4", -4),
            ("abc", None), ("nan", None), ("", None), (None, None), ("5d", None), ("5f", None),
            ("inf", None), ("9999999999", None),
        ],
        numbers.number_to_int,
    )


def test_number_or_zero(spark):
    check(
        spark,
        [("12", 12), ("2.9", 2), ("-2.9", -2), ("abc", 0), ("", 0), (None, 0), ("nan", 0)],
        numbers.number_or_zero,
    )


def test_number_to_long(spark):
    check(
        spark,
        [("62", 62), ("62.0", 62), ("9007199254740993", 9007199254740993), ("Jumlah", None), (None, None)],
        numbers.number_to_long,
    )


def test_keep_numeric(spark):
    df = spark.createDataFrame([("1",), ("Jumlah",), (None,), ("nan",), ("2.0",)], "No string")
    assert [r[0] for r in keep_numeric(df, "No").collect()] == ["1", "2.0"]


def test_indonesian_month(spark):
    check(
        spark,
        [
            (" Januari ", 1), ("DESEMBER", 12), ("mei", 5), ("\tJuli\n", 7), ("\xa0Maret", 3),
            ("Jan", None), ("", None), (None, None),
        ],
        dates.indonesian_month,
    )


def test_order_date(spark):
    check(
        spark,
        [
            ("05/06/2023", dt.date(2023, 6, 5)), ("5/6/2023", dt.date(2023, 6, 5)),
            ("2023-07-30", dt.date(2023, 7, 30)), ("2023-07-09", dt.date(2023, 7, 9)),
            ("2023-07-09 00:00:00", dt.date(2023, 7, 9)), ("31/31/2023", None),
            ("29/02/2023", None), ("2023", None), ("belum", None), ("", None), (None, None),
        ],
        dates.parse_order_date,
    )


def test_expense_date(spark):
    check(
        spark,
        [
            ("05/06/2023", dt.date(2023, 5, 6)), ("25/06/2023", dt.date(2023, 6, 25)),
            ("2023-01-09", dt.date(2023, 1, 9)), ("13/13/2023", None), (None, None),
        ],
        dates.parse_expense_date,
    )


def test_declared_formats(spark):
    only_slashes = lambda c: dates.parse_date(c, ["d/M/yyyy"])
    check(spark, [("2023-07-30", None), ("30/07/2023", dt.date(2023, 7, 30))], only_slashes)
    other = lambda c: dates.parse_date(c, ["dd MMM yyyy"])
    check(spark, [("05 Jun 2023", dt.date(2023, 6, 5)), ("x", None)], other)


def test_salary_imputation(spark):
    rows = [
        (0, None, " Gaji ", "Maret"), (1, None, "gaji", "x"), (2, None, "Olaf", "Maret"),
        (3, "2023-01-09", "gaji", "Maret"), (4, None, None, "Maret"), (5, None, "GAJI", None),
    ]
    df = spark.createDataFrame(rows, "i int, d string, brand string, notes string").orderBy("i")
    parsed = dates.parse_expense_date(F.col("d"))
    payday = dates.salary_date(F.col("brand"), F.col("notes"))
    got = df.select(dates.imputed_date(parsed, payday), dates.is_imputed(parsed, payday)).collect()
    assert [tuple(r) for r in got] == [
        (dt.date(2023, 3, 25), True), (None, False), (None, False),
        (dt.date(2023, 1, 9), False), (None, False), (None, False),
    ]
    other = dates.salary_date(F.col("brand"), F.col("notes"), default_year=2025, salary_day=1)
    assert df.select(other).first()[0] == dt.date(2025, 3, 1)


def test_date_parts(spark):
    df = spark.createDataFrame([(dt.date(2024, 12, 30),), (dt.date(2027, 1, 3),)], "d date")
    got = df.select(F.year("d"), F.month("d"), F.weekofyear("d"), dates.week_start(F.col("d"))).collect()
    assert [tuple(r) for r in got] == [
        (2024, 12, 1, dt.date(2024, 12, 30)), (2027, 1, 53, dt.date(2026, 12, 28)),
    ]


def test_text(spark):
    check(spark, [("", None), (" ", " "), ("x", "x"), (None, None)], text.blank_to_null)
    check(spark, [("  x ", "x"), ("  ", None), ("\t", "\t"), (None, None)], text.trimmed_or_null)


def test_missing_tokens(spark):
    values = ["", "N/A", "nan", "NULL", "None", "na", "Nan", " NA", "0", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, `a b` string")
    got = [r[0] for r in missing_as_null(df).orderBy("i").select("a b").collect()]
    assert got == [None, None, None, None, None, "na", "Nan", " NA", "0", None]


def test_customer_names(spark):
    check(
        spark,
        [
            ("Kost no 12", "Pelanggan Kost 12"), ("Temen Putri", "Teman Putri"),
            ("Kak Anis", "Kak Anis"), ("kost no 12", "kost no 12"), ("", ""), (None, None),
        ],
        rules.customer_name_clean,
    )
    check(
        spark,
        [("Kak Anis", True), ("Ka\tIndra", True), ("Kaka", False), ("Ibu Kak A", False), (None, None)],
        rules.has_honorific,
    )


def test_payment_method(spark):
    check(
        spark,
        [
            ("BCA", "Transfer"), ("tf BCA ok", "Transfer"), (None, "Cash"), ("bayar cash", "Cash"),
            ("", "Unknown"), ("BLU", "Unknown"), ("CASH", "Unknown"), ("cash ok", "Unknown"),
            ("bca", "Unknown"), ("BCA cash", "Transfer"),
        ],
        rules.payment_method,
    )


def test_service_rules(spark):
    services = ["Tas", "SENDAL", "Deep Clean", "deep", "Fast Clean", "REPARASI lem", "Cuci", None]
    assert apply(spark, services, rules.item_type) == [
        "Tas", "SENDAL", "sepatu", "sepatu", "sepatu", "sepatu", "sepatu", "sepatu",
    ]
    assert apply(spark, services, rules.clean_type) == [
        "deep clean", "deep clean", "deep clean", "deep clean", "fast clean", "reparasi", "cuci", None,
    ]


def test_shoe_brand(spark):
    check(
        spark,
        [
            ("CloudTec", "CloudTec"), ("cloud tec", "On Running"), ("On Cloud", "On Running"),
            ("nike aj1", "Nike"), ("adidas (lupa)", "Adidas"), ("NB", "New Balance"),
            ("Converse High", "Converse"), ("gatau", "Unknown"), ("???", "Unknown"),
            ("", "Unknown"), (None, "Unknown"), ("vans", "vans"), (" NB", " NB"),
        ],
        rules.shoe_brand_clean,
    )


@pytest.mark.parametrize(
    ("amount", "label"),
    [
        (-20000, "surcharge"), (0, "none"), (5000, "special"), (8000, "promo"), (10000, "loyalty"),
        (10001, "manual"), (50000, "manual"), (1234, "unknown"), (9999, "unknown"), (None, "unknown"),
    ],
)
def test_discount_type(spark, amount, label):
    assert apply(spark, [amount], rules.discount_type, "int") == [label]


def test_checklist_rules(spark):
    check(
        spark,
        [
            ("tf BCA", "Transfer"), ("BLU", "Transfer"), ("bayar cash ", "Cash"), ("", "Unknown"), (None, "Unknown"), ("bca", "Unknown"),
        ],
        rules.checklist_payment_method,
    )
    check(
        spark,
        [
            (" Tas besar", "Bag"), ("KARPET", "Carpet"), ("sendal", "Sandal"), ("Reparasi lem", "Other"), ("  ", "Other"), (None, "Other"),
            ("Nike AJ1", "Shoe"), ("gatau", "Shoe"),
        ],
        rules.checklist_item_type,
    )
    rows = [("Deep Clean", "Tas"), (" reparasi", "NB"), ("?", "Karpet"), (None, "sendal x"), (None, None), ("Cuci", "NB"), ("FAST", None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, service string, shoe string")
    got = [r[0] for r in df.orderBy("i").select(rules.service_category(F.col("service"), F.col("shoe"))).collect()]
    assert got == ["Deep Clean", "Reparasi", "Karpet", "Sendal", None, None, "Fast Clean"]
