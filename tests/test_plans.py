"""Feeds from files to published tables, staging, marts, synthetic feeds."""

import csv
import datetime as dt
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillbook import fixed_values as V
from tillbook import jobs
from tillbook.operators import profile, quality
from tillbook.operators.columns import union_feeds
from tillbook.plans import ingest, marts, staging, synthetic
from tillbook.plans import normalize as N
from tillbook.sources import feeds, scratch, tables

ORDER_HEADER = list(V.ORDER_HEADERS)
EXPENSE_HEADER = list(V.EXPENSE_HEADERS)


def write(path, header, rows):
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f)
        out.writerow(header)
        out.writerows(rows)
    return str(path)


@pytest.fixture
def paths(tmp_path):
    o23 = [
        ["62", "05/06/2023", "Kost no 12", "Nike AJ1", "Deep Clean", "Rp50.000", "Rp0", "Rp50.000", "BCA", "Paid", "Vian"],
        ["62", "2023-06-07", "Kak Anis", "gatau", "Tas", "Rp80.000,00", "Rp-20.000", "Rp100.000", "", "Paid", "Rio"],
        ["63", "7/8/2023", "Kost no 12", "", "fast clean", "Rp35.000", "Rp10.000", "Rp25.000", "bayar cash", "", "Amory"],
    ]
    o25 = [
        ["1", "30/09/2025", "Mas, Jo \"x\"", "NB", "Reparasi", "Rp40.000", "N/A", "Rp40.000", "BLU", "Paid", "Vian"],
    ]
    syn = [
        ["1", "2025-01-02", "Bella", "Hoka", "Karpet", "40000", "5000", "35000", "Synthetic", "Paid", "Rio", "True"],
    ]
    e23 = [
        ["2023-06-01", "Sabun", "Olaf", "Rp10.000", "2", "Rp20.000", ""],
        ["", "Gaji Vian", " Gaji ", "Rp500.000", "1", "Rp500.000", "Juni"],
    ]
    e25 = [["25/09/2025", "Lap", "", "Rp5.000", "2.5", "Rp12.500", "ok"], ["", "", "gaji", "Rp1", "x", "", "?"]]
    sup = [["2025-01-01", "Spons", "Apen", "13772", "1", "13772", "", "True"]]
    return ingest.FeedPaths(
        write(tmp_path / "o23.csv", ORDER_HEADER, o23),
        write(tmp_path / "o25.csv", [*ORDER_HEADER, "Kas"], [[*r, "9"] for r in o25]),
        write(tmp_path / "syn.csv", [*ORDER_HEADER, "is_synthetic"], syn),
        write(tmp_path / "e23.csv", EXPENSE_HEADER, e23),
        write(tmp_path / "e25.csv", EXPENSE_HEADER, e25),
        write(tmp_path / "sup.csv", [*EXPENSE_HEADER, "is_synthetic"], sup),
    )


def test_load_and_stage(spark, paths, tmp_path):
    out = ingest.load(spark, paths, str(tmp_path / "wh"))
    assert [(r["data_source"], r["row_count"]) for r in out["orders"].collect()] == [
        ("real_2023", 3), ("real_2025", 1), ("synthetic_orders", 1),
    ]
    assert [(r["data_source"], r["row_count"], r["earliest"]) for r in out["expenses"].collect()] == [
        ("real_2023", 2, dt.date(2023, 6, 1)), ("real_2025", 2, dt.date(2025, 9, 25)),
        ("synthetic_supplies", 1, dt.date(2025, 1, 1)),
    ]
    orders = spark.table("raw_orders")
    assert orders.schema.simpleString() == spark.createDataFrame([], V.RAW_ORDERS_SCHEMA).schema.simpleString()
    by_name = {(r["order_no"], r["customer_name"]): r for r in orders.collect()}
    assert by_name[(62, "Kak Anis")]["price"] == 80000
    assert by_name[(62, "Kak Anis")]["discount"] == -20000
    assert by_name[(1, 'Mas, Jo "x"')]["discount"] is None
    assert by_name[(63, "Kost no 12")]["order_date"] == dt.date(2023, 8, 7)
    assert by_name[(1, "Bella")]["is_synthetic"] is True

    expenses = {r["item_name"]: r for r in spark.table("raw_expenses").collect()}
    assert (expenses["Gaji Vian"]["expense_date"], expenses["Gaji Vian"]["is_date_imputed"]) == (dt.date(2023, 6, 25), True)
    assert (expenses["Lap"]["quantity"], expenses["Lap"]["is_date_imputed"]) == (2, False)
    assert expenses["Spons"]["is_date_imputed"] is None
    assert expenses[None]["expense_date"] is None

    ingest.load(spark, paths, str(tmp_path / "wh"))
    assert spark.table("raw_orders").count() == 5

    ingest.stage(spark)
    staged = spark.table("stg_orders")
    assert staged.columns == staging.STG_ORDER_COLUMNS and staged.count() == 5
    assert {r["payment_method"] for r in staged.collect()} == {"Transfer", "Cash", "Unknown"}
    lap = spark.table("stg_expenses").filter("item_name = 'Lap'").first()
    assert (lap["brand"], lap["calculated_total_price"], lap["is_total_price_mismatch"]) == (None, 10000, True)


def test_failed_check_publishes_nothing(spark, paths, tmp_path):
    ingest.load(spark, paths, str(tmp_path / "wh"))
    bad = [["1", "soon", "A", "NB", "Tas", "Rp1", "", "Rp1", "", "", "Vian"]]
    broken = ingest.FeedPaths(
        write(tmp_path / "bad.csv", ORDER_HEADER, bad), *list(vars(paths).values())[1:]
    )
    with pytest.raises(quality.DataQualityError, match="order_date_unparseable"):
        ingest.load(spark, broken, str(tmp_path / "wh"))
    assert spark.table("raw_orders").count() == 5


def test_missing_column_is_an_error(spark, tmp_path):
    path = write(tmp_path / "x.csv", ORDER_HEADER[:-1], [["1"] * 10])
    with pytest.raises(Exception, match="worker"):
        N.normalize_orders_real(feeds.read_orders_csv(spark, path), "x").collect()


def test_explicit_schema_is_checked_against_the_header(spark, tmp_path):
    path = write(tmp_path / "e.csv", EXPENSE_HEADER, [["2023-01-01", "a", "b", "1", "1", "1", ""]])
    assert feeds.read_expenses_csv(spark, path, schema=feeds.EXPENSES_FEED).first()["Merk"] == "b"
    swapped = write(tmp_path / "s.csv", EXPENSE_HEADER[::-1], [["1"] * 7])
    with pytest.raises(Exception, match="(?i)header"):
        feeds.read_expenses_csv(spark, swapped, schema=feeds.EXPENSES_FEED).collect()


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi", ok', None), (2, "b", "c")], "No int, Nama string, x string")
    tables.save_csv(df, str(tmp_path / "out"))
    back = feeds.read_csv(spark, str(tmp_path / "out")).orderBy("No")
    assert [tuple(r) for r in back.collect()] == [("1", 'say "hi", ok', None), ("2", "b", "c")]


def test_table_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, data_source string")
    for _ in range(2):
        tables.save_table(df, "sink_check")
        tables.save_parquet(df, str(tmp_path / "p"), ["data_source"])
    assert spark.table("sink_check").count() == 2
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2
    spark.sql("DROP TABLE sink_check")
    assert len(tables.first_rows(df, [F.col("n")], 1)) == 1


@pytest.mark.parametrize("line", ["1,2023-01-01,A,EXTRA,LOST", "1,2023-01-01"])
def test_lines_of_another_length_are_refused(spark, tmp_path, line):
    (tmp_path / "f.csv").write_text(f"No,Tanggal,Nama\n1,2023-01-01,A\n{line}\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        feeds.read_csv(spark, str(tmp_path / "f.csv")).select("No").collect()


def test_quoted_line_break(spark, tmp_path):
    (tmp_path / "f.csv").write_text('No,Nama,x\n1,"A\nB",c\n')
    assert feeds.read_csv(spark, str(tmp_path / "f.csv"), multiline=True).first()["Nama"] == "A\nB"


def orders_frame(spark, rows):
    """(no, date, name, price, discount) rows as a staged frame."""
    full = [(n, d, c, "NB", "Tas", p, x, p - (x or 0), None, "Paid", "Vian", "real_2023", False) for n, d, c, p, x in rows]
    return staging.staged_orders(spark.createDataFrame(full, V.RAW_ORDERS_SCHEMA))


def test_loyalty_audit(spark):
    d = dt.date
    rows = [
        (1, d(2023, 6, 1), "A", 50000, 0), (2, d(2023, 6, 1), "A", 50000, 10000), (3, d(2023, 7, 1), "A", 50000, 0),
        (4, d(2023, 8, 1), "A", 50000, 5000), (5, d(2024, 1, 1), "A", 50000, 0), (6, d(2023, 6, 1), "B", 50000, None),
        (7, d(2023, 6, 2), "B", 50000, None),
    ]
    for given in (rows, rows[::-1]):
        got = {r["order_no"]: r for r in marts.fct_orders(orders_frame(spark, given)).collect()}
        assert {n: r["order_sequence_per_customer"] for n, r in got.items()} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1, 6: 1, 7: 2}
        assert {n: r["is_discount_missed"] for n, r in got.items()} == {
            1: False, 2: False, 3: False, 4: True, 5: False, 6: None, 7: None,
        }
        assert got[4]["discount_gap"] == 5000 and got[1]["is_repeat_customer"] is False


def test_order_ids_are_unique(spark):
    d = dt.date(2023, 8, 1)
    rows = [(62, d, "A", 1, 0), (62, d, "B", 1, 0), (12345, d, "A", 1, 0), (1234, d, "A", 1, 0), (7, d, "A", 1, 0)]
    rows += [(None, d, "A", 1, 0), (2023, None, "A", 1, 0), (-5, d, "A", 1, 0), (None, None, "A", 1, 0)]
    for given in (rows, rows[::-1]):
        keyed = marts.order_surrogate_key(orders_frame(spark, given)).collect()
        assert sorted(r["order_id"] for r in keyed) == sorted([
            "2023_0062", "2023_0062_2", "2023_12345", "2023_1234", "2023_0007",
            "2023_none", "none_2023", "2023_-0005", "none_none",
        ])
        assert {r["customer_name"] for r in keyed if r["order_id"] == "2023_0062_2"} == {"B"}


def test_unpaid_and_free_orders_earn_nothing(spark):
    d = dt.date(2023, 8, 1)
    rows = [
        (n, d, "A", "NB", "Tas", p, 0, p, None, status, "Vian", "real_2023", False)
        for n, (p, status) in enumerate([(50000, "Paid"), (50000, None), (50000, "  "), (0, "Paid"), (None, "Paid")])
    ]
    full = staging.with_revenue(staging.staged_orders(spark.createDataFrame(rows, V.RAW_ORDERS_SCHEMA)))
    month = marts.fct_monthly_revenue(full, "net_revenue").first()
    assert (month["orders"], month["revenue"]) == (5, 50000)
    left_out = {r["reason"]: (r["orders"], r["excluded"]) for r in marts.revenue_excluded_orders(full).collect()}
    assert left_out == {"unpaid": (2, 100000), "no_total": (2, 0)}


def test_profit_keeps_one_sided_months(spark):
    orders = orders_frame(spark, [(1, dt.date(2023, 6, 1), "A", 1001, 0), (2, None, "A", 10, 0)])
    bills = spark.createDataFrame(
        [(dt.date(2023, 7, 1), "x", "Olaf", 50, 2, 100, None, "s", False, False),
         (dt.date(2023, 7, 25), "y", "gaji", 50, 2, 900, None, "s", False, True),
         (None, "z", None, 1, 1, 7, None, "s", False, False)],
        V.RAW_EXPENSES_SCHEMA,
    )
    got = {(r["year"], r["month"]): r for r in marts.fct_profit(orders, staging.stg_expenses(bills), "0.4").collect()}
    assert {k: (r["revenue"], r["expenses"], float(r["salary"]), float(r["profit"])) for k, r in got.items()} == {
        (2023, 6): (1001, 0, 400.4, 600.6), (2023, 7): (0, 100, 0.0, -100.0), (None, None): (10, 7, 4.0, -1.0),
    }
    margin = {r["month"]: r["net_margin"] for r in marts.net_margin(marts.fct_profit(orders, staging.stg_expenses(bills), "0.4")).collect()}
    assert margin[7] is None and margin[6] == 1.0
    with pytest.raises(ValueError):
        marts.fct_salary(orders, "1.5")


def test_month_gaps(spark):
    orders = orders_frame(spark, [(1, dt.date(2023, 11, 30), "A", 1, 0), (2, dt.date(2024, 2, 1), "A", 1, 0), (3, None, "A", 1, 0)])
    assert sorted(r["month_start"] for r in marts.month_gaps(orders).collect()) == [dt.date(2023, 12, 1), dt.date(2024, 1, 1)]


def test_material_lookup(spark):
    orders = orders_frame(spark, [(1, dt.date(2023, 1, 1), "A", 1, 0)])
    names = "shoe_brand_clean string, shoe_material string, material_complexity string"
    table = spark.createDataFrame([("New Balance", "Suede", "High")], names)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for bound in (before, "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
            row = marts.with_material(orders, table).first()
            assert (row["shoe_material"], row["material_complexity"]) == ("Suede", "High")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert marts.with_material(orders, table.limit(0)).first()["shoe_material"] == "Unknown"
    with pytest.raises(Exception, match="repeats the brand"):
        marts.with_material(orders, table.union(table)).collect()


def test_union_keeps_every_row_and_staging_too(spark):
    a = spark.createDataFrame([("1", "x")], "a string, b string")
    b = spark.createDataFrame([("2",), ("3",)], "a string")
    merged = union_feeds(a, b, b)
    assert merged.count() == 5 and merged.filter("b IS NULL").count() == 4


START, END = dt.date(2025, 1, 1), dt.date(2026, 4, 14)


def test_synthetic_orders(spark):
    feed = synthetic.generate_orders(spark, START, END, 4000).cache()
    rows = feed.orderBy("No").collect()
    assert [r["No"] for r in rows] == list(range(1, 4001))
    assert [r["Tanggal"] for r in rows] == sorted(r["Tanggal"] for r in rows)
    assert START <= rows[0]["Tanggal"] and rows[-1]["Tanggal"] <= END
    assert feed.columns == [*ORDER_HEADER, "is_synthetic"]
    for r in rows:
        assert r["Harga"] in V.SYNTH_PRICES[r["Jenis cuci"]] and r["Total harga"] == r["Harga"] - r["Discount"]
        assert r["Jenis Sepatu"] == r["Jenis cuci"] if r["Jenis cuci"] in ("Tas", "Karpet") else r["Jenis Sepatu"] in V.SYNTH_SHOES
    share = {k: sum(r["Jenis cuci"] == k for r in rows) / 40 for k in V.SYNTH_SERVICE_PERCENT}
    for kind, percent in V.SYNTH_SERVICE_PERCENT.items():
        assert abs(share[kind] - percent) < 2
    assert abs(sum(r["Discount"] == 0 for r in rows) / 4000 - 0.6) < 0.03
    assert len({r["Nama"] for r in rows}) == 40 and len({r["Kang Cuci"] for r in rows}) == 3
    other_split = synthetic.order_draws(spark.range(0, 4000, 1, 3), START, END)
    first_split = synthetic.order_draws(spark.range(0, 4000, 1, 11), START, END)
    assert first_split.exceptAll(other_split).isEmpty()


def test_recurring_schedule(spark):
    items = spark.createDataFrame(
        [(i, f"item{k}", "b", 100, 2, k) for i, k in enumerate((1, 2, 3, 4, 6))],
        "item_id int, item_name string, brand string, unit_price int, quantity int, every_months int",
    )
    rows = synthetic.generate_supplies(items, START, END).collect()
    counts = {k: sum(r["Nama Barang"] == f"item{k}" for r in rows) for k in (1, 2, 3, 4, 6)}
    assert counts == {1: 16, 2: 8, 3: 6, 4: 4, 6: 3}
    assert all(r["Total Harga"] == 200 and 1 <= r["Tanggal"].day <= 11 for r in rows)
    with pytest.raises(ValueError):
        synthetic.generate_supplies(items, dt.date(2025, 1, 31), END)


GOLDEN = os.environ.get("TILLBOOK_GOLDEN_ORDERS"), os.environ.get("TILLBOOK_GOLDEN_EXPENSES")


@pytest.mark.skipif(not all(GOLDEN), reason="paths to the 300-order and 63-expense feeds not given")
def test_golden_feeds(spark):
    orders = N.normalize_orders_synth(feeds.read_synthetic_csv(spark, GOLDEN[0]))
    bills = N.normalize_expenses_synth(feeds.read_synthetic_csv(spark, GOLDEN[1]))
    staged, bills = staging.staged_orders(orders).cache(), staging.stg_expenses(
        union_feeds(bills, spark.createDataFrame([], "is_date_imputed boolean"))
    )
    counts = lambda c: {r[0]: r["count"] for r in profile.value_counts(staged, c).collect()}
    assert staged.agg(F.sum("price"), F.sum("discount"), F.sum("total_price"), F.avg("total_price")).first()[:] == (
        15245000, 920000, 14325000, 47750.0,
    )
    assert counts("item_type") == {"sepatu": 286, "Tas": 11, "Karpet": 3}
    assert counts("clean_type") == {"deep clean": 270, "fast clean": 24, "reparasi": 6}
    assert counts("discount_type") == {"none": 171, "special": 74, "loyalty": 55}
    assert counts("payment_method") == {"Unknown": 300}
    brands = counts("shoe_brand_clean")
    assert [brands.get(b, 0) for b in ("Converse", "On Running", "New Balance", "Adidas", "Nike", "Unknown")] == [36, 19, 17, 11, 10, 0]
    workers = {r["worker"]: (r["orders"], r["earnings"]) for r in marts.fct_worker_performance(staged).collect()}
    assert workers == {"Vian": (107, 5225000), "Rio": (102, 4755000), "Amory": (91, 4345000)}
    revenue = {(r["year"], r["month"]): (r["orders"], r["revenue"]) for r in marts.fct_monthly_revenue(staged).collect()}
    assert revenue[(2025, 1)] == (19, 920000) and revenue[(2026, 4)] == (6, 270000) and len(revenue) == 16
    spent = {(r["year"], r["month"]): (r["purchases"], r["expenses"]) for r in marts.fct_monthly_expenses(bills).collect()}
    assert spent[(2025, 1)] == (9, 462288) and spent[(2026, 4)] == (3, 213300) and len(spent) == 16
    assert bills.agg(F.count_if("is_total_price_mismatch"), F.count("is_date_imputed"), F.min("expense_date"), F.max("expense_date")).first()[:] == (
        0, 0, dt.date(2025, 1, 1), dt.date(2026, 4, 11),
    )
    fct = marts.fct_orders(staged)
    audit = {
        r["year"]: r[1:]
        for r in fct.groupBy("year").agg(
            F.count("*"), F.count_if("is_repeat_customer"), F.count_if(F.col("expected_discount") > 0), F.count_if("is_discount_missed")
        ).collect()
    }
    assert audit == {2025: (235, 195, 108, 90), 2026: (65, 30, 23, 18)}
    assert {r["year"]: r["missed_discounts"] for r in marts.discount_alert(fct).collect()} == {2025: 90, 2026: 18}


def test_jobs_generate_then_load(spark, paths, tmp_path):
    items = spark.createDataFrame(
        [(1, "Spons", "Apen", 13772, 1, 2)],
        "item_id int, item_name string, brand string, unit_price int, quantity int, every_months int",
    )
    items.write.parquet(str(tmp_path / "items"))
    jobs.run(spark, ["generate", "--start", "2025-01-01", "--end", "2026-04-14", "--orders", "500",
                     "--items", str(tmp_path / "items"), "--out", str(tmp_path / "gen")])
    given = {**vars(paths), "synthetic_orders": str(tmp_path / "gen/synthetic_orders"),
             "synthetic_supplies": str(tmp_path / "gen/synthetic_supplies")}
    argv = ["load", "--warehouse", str(tmp_path / "wh")]
    for name, value in given.items():
        argv += ["--" + name.replace("_", "-"), value]
    jobs.run(spark, argv)
    by_source = {r["data_source"]: r["n"] for r in spark.table("stg_orders").groupBy("data_source").agg(F.count("*").alias("n")).collect()}
    assert by_source == {"real_2023": 3, "real_2025": 1, "synthetic_orders": 500}
    assert spark.table("stg_expenses").filter("is_synthetic").count() == 8
    assert spark.table("raw_orders").filter("order_date IS NULL").isEmpty()
    jobs.run(spark, ["marts", "--share", "0.40"])
    assert spark.table("fct_orders").count() == 504
    paid = spark.table("fct_salary").agg(F.sum("salary"), F.sum("kas"), F.sum("revenue")).first()
    assert paid[0] + paid[1] == paid[2]
    assert spark.table("dim_customers").agg(F.sum("total_orders")).first()[0] == 504
    assert spark.table("fct_profit").agg(F.sum("revenue")).first()[0] == paid[2]
    own = f"{scratch.scratch_root(spark)}/tillbook-{spark.sparkContext.applicationId}"
    assert not os.path.exists(own)


def test_inspect(spark):
    orders = orders_frame(spark, [(1, dt.date(2023, 1, 1), "A", 5, 0)])
    found = profile.inspect(orders, [F.col("order_no")])
    assert set(found) == {"shape", "null_counts", "head", "price_stats"}
    assert {r["column_name"] for r in found["price_stats"].collect()} == {"price", "total_price"}


def test_amounts_stored_as_numbers(spark):
    real = spark.createDataFrame(
        [("1", "05/06/2023", "A", "NB", "Tas", 50000.9, -20000.5, float("nan"), None, "Paid", "V")],
        ", ".join(f"`{h}` {'double' if h in ('Harga', 'Discount', 'Total harga') else 'string'}" for h in ORDER_HEADER),
    )
    row = N.normalize_orders_real(real, "x").first()
    assert (row["price"], row["discount"], row["total_price"]) == (50000, -20000, None)
    row = N.normalize_orders_synth(real).first()
    assert (row["price"], row["discount"], row["total_price"]) == (50001, -20000, None)


words = st.one_of(st.none(), st.sampled_from(["", "Tas", "deep x", "FAST", "nike", "NB", "BCA", "cash", "Kak A", "?"]), st.text(max_size=6))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(words, words, words, words, st.one_of(st.none(), st.integers(-20000, 60000))), min_size=1, max_size=30))
def test_staging_keeps_rows_and_stays_in_vocabulary(spark, rows):
    raw = spark.createDataFrame(
        [(i, dt.date(2023, 1, 1), n, sh, sv, 1, d, 1, no, None, None, "real_2023", False) for i, (n, sh, sv, no, d) in enumerate(rows)],
        V.RAW_ORDERS_SCHEMA,
    )
    staged = staging.stg_orders(raw).collect()
    assert sorted(r["order_no"] for r in staged) == list(range(len(rows)))
    for r in staged:
        name, shoe, service, notes, discount = rows[r["order_no"]]
        assert r["payment_method"] in ("Transfer", "Cash", "Unknown")
        assert r["item_type"] in ("sepatu", service) and r["item_type"] is not None
        assert (r["clean_type"] is None) == (service is None)
        assert r["shoe_brand_clean"] in ("On Running", "Nike", "Adidas", "New Balance", "Converse", "Unknown", shoe)
        assert r["shoe_brand_clean"] is not None
        assert r["discount_type"] in V.DISCOUNT_TYPES
        assert r["notes"] is None or r["notes"].strip(" ") == r["notes"] != ""
        assert r["customer_name_clean"] == name or name in V.CUSTOMER_ALIASES


def test_row_wise_plans_accept_a_stream(spark, paths, tmp_path):
    stream = spark.readStream.schema(feeds.ORDERS_FEED).option("header", True).csv(os.path.dirname(paths.orders_2023) + "/o23*")
    staged = staging.stg_orders(N.normalize_orders_real(feeds.missing_as_null(stream), V.REAL_2023))
    query = staged.writeStream.format("memory").queryName("staged_stream").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert {r["payment_method"] for r in spark.table("staged_stream").collect()} == {"Transfer", "Cash"}
