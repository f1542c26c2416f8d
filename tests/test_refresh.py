"""Statistics of any number, ids that stay, marts by period."""

import datetime as dt
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_load import changed
from test_plans import ORDER_HEADER, orders_frame, paths, write  # noqa: F401

from tillbook import jobs
from tillbook import fixed_values as V
from tillbook.operators import profile
from tillbook.operators.quantiles import describe_numbers
from tillbook.plans import ingest, marts, refresh, staging
from tillbook.sources import versions


# --- statistics ------------------------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 2, 3, 1000])
def test_statistics_of_any_number(spark, n):
    draw = random.Random(n)
    inf, nan = float("inf"), float("nan")
    rows = [
        (
            draw.choice([None, draw.randint(-(2**62), 2**62), draw.randint(-3, 3)]),
            draw.choice([None, nan, -0.0, 0.0, draw.gauss(0, 1e10), draw.gauss(0, 1e-300), -5e-324, 5e-324]),
            draw.choice([None, draw.gauss(0, 1)]),
            draw.randint(-(2**31), 2**31 - 1),
            None,
        )
        for _ in range(n)
    ]
    frame = spark.createDataFrame(rows, "l long, d double, f float, i int, nothing double")
    frame = frame.withColumn("m", (F.col("i") / 1000).cast("decimal(18,3)"))
    got = {r["column_name"]: r for r in describe_numbers(frame, ["l", "d", "f", "i", "m", "nothing"]).collect()}
    for name in got:
        values = np.array([float(r[name]) for r in frame.select(name).collect() if r[name] is not None and r[name] == r[name]])
        r = got[name]
        assert r["count"] == len(values)
        if not len(values):
            assert (r["mean"], r["min"], r["p50"], r["max"]) == (None,) * 4
            continue
        exact = [np.quantile(values, q) for q in (0, 0.25, 0.5, 0.75, 1)]
        assert [r[k] for k in ("min", "p25", "p50", "p75", "max")] == pytest.approx(exact, rel=1e-12, abs=0)
        assert r["mean"] == pytest.approx(values.mean(), rel=1e-9, abs=1e-6)
        assert (r["std"] is None) == (len(values) == 1)
    edge = spark.createDataFrame([(inf,), (-inf,), (1.0,), (inf,)], "d double")
    r = describe_numbers(edge, ["d"]).first()
    assert (r["min"], r["max"], r["p75"]) == (-inf, inf, inf)


def test_price_statistics_of_stored_numbers(spark):
    frame = spark.createDataFrame([(1.5, 2**40), (-2.5, -(2**40)), (float("nan"), None)], "price double, harga long")
    got = {r["column_name"]: r for r in profile.price_stats(frame).collect()}
    assert (got["price"]["count"], got["price"]["p50"], got["harga"]["p25"]) == (2, -0.5, -(2**39))
    with pytest.raises(TypeError):
        describe_numbers(spark.createDataFrame([("a",)], "s string"), ["s"])
    with pytest.raises(TypeError):
        describe_numbers(frame.select(F.col("harga").cast("decimal(30,0)").alias("w")), ["w"])


# --- ids that stay ----------------------------------------------------------------


def ids_of(frame):
    return sorted((r["customer_name"], r["price"], r["notes"] or "", r["order_id"]) for r in frame.collect())


def test_ids_stay_when_earlier_orders_arrive(spark):
    d = dt.date
    first = [(62, d(2023, 8, 2), "B", 1, 0), (62, d(2023, 8, 3), "C", 1, 0), (7, d(2023, 8, 1), "A", 1, 0), (7, d(2023, 8, 1), "A", 1, 0), (None, None, "N", 1, 0)]
    frame = orders_frame(spark, first)
    with_ids, ids = marts.stable_order_ids(frame, None)
    plain = marts.order_surrogate_key(frame)
    assert sorted(r["order_id"] for r in with_ids.collect()) == sorted(r["order_id"] for r in plain.collect())
    assert {r["order_id"] for r in with_ids.filter("customer_name = 'C'").collect()} == {"2023_0062_2"}
    before = ids_of(with_ids)

    # An earlier order of the same number, a further twin, and a new number; C has gone.
    second = [r for r in first if r[2] != "C"]
    second += [(62, d(2023, 8, 1), "Early", 1, 0), (7, d(2023, 8, 1), "A", 1, 0), (8, d(2023, 8, 1), "A", 1, 0), (62, d(2023, 8, 9), "Z", 1, 0)]
    again, more = marts.stable_order_ids(orders_frame(spark, second), ids)
    after = ids_of(again)
    assert [r for r in before if r[0] != "C"] == [r for r in after if r in before]
    got = {r["customer_name"]: r["order_id"] for r in again.filter("order_no = 62").collect()}
    assert got == {"B": "2023_0062", "Early": "2023_0062_3", "Z": "2023_0062_4"}  # C keeps _2 for itself
    assert sorted(r["order_id"] for r in again.filter("order_no = 7").collect()) == ["2023_0007", "2023_0007_2", "2023_0007_3"]
    back, _ = marts.stable_order_ids(frame, more)
    assert ids_of(back) == before
    assert len({r["order_id"] for r in again.collect()}) == len(second)


def test_ids_do_not_follow_notes(spark):
    frame = orders_frame(spark, [(1, dt.date(2023, 1, 1), "A", 1, 0), (1, dt.date(2023, 1, 2), "B", 1, 0)])
    _, ids = marts.stable_order_ids(frame, None)
    again, more = marts.stable_order_ids(frame.withColumns({"notes": F.lit("paid later"), "payment_status": F.lit(None).cast("string")}), ids)
    assert {r["customer_name"]: r["order_id"] for r in again.collect()} == {"A": "2023_0001", "B": "2023_0001_2"}
    assert more.count() == 2
    none, left = marts.stable_order_ids(frame.limit(0), more)
    assert none.count() == 0 and left.count() == 2


def test_ids_of_few_copies_move_by_their_keys(spark, monkeypatch):
    """Groups of a few rows need no range sort; large ones, null keys too, get the same numbers."""
    from tillbook.operators import numbering

    rows = [(k, i % 7, i) for k in (None, 1, 2) for i in range(5 if k == 1 else 40)] + [(3, 0, 0)]
    frame = spark.createDataFrame(rows, "k int, v int, t int")
    order = [F.col("v"), F.col("t")]
    want = sorted(map(str, numbering.number_within(frame, ["k"], order, "n").collect()))
    with monkeypatch.context() as m:
        m.setattr(numbering, "LARGE_ROWS", 10)
        got = numbering.number_in_groups(frame, ["k"], order, "n")
        assert sorted(map(str, got.collect())) == want and len(want) == 86

    def sorts(*_):
        raise AssertionError("sorted over ranges")

    monkeypatch.setattr(numbering, "sort_over_ranges", sorts)
    assert sorted(map(str, numbering.number_in_groups(frame, ["k"], order, "n").collect())) == want
    orders = orders_frame(spark, [(1, dt.date(2023, 1, d % 3 + 1), "A", 1, 0) for d in range(6)])
    with_ids, _ = marts.stable_order_ids(orders, None)
    assert sorted(r["order_id"] for r in with_ids.collect()) == ["2023_0001", *(f"2023_0001_{i}" for i in range(2, 7))]


def test_a_wide_write_leaves_the_session_as_it_was(spark):
    from tillbook.sources import scratch

    had = spark.conf.get(scratch.METHOD_LIMIT)
    spark.conf.set(scratch.METHOD_LIMIT, "65000")
    try:
        assert scratch.write_scratch(spark.range(3), wide=True).count() == 3
        assert spark.conf.get(scratch.METHOD_LIMIT) == "65000"
    finally:
        spark.conf.set(scratch.METHOD_LIMIT, had)


# --- marts by period ----------------------------------------------------------------


def stored(folder):
    """Data files with their sizes and times of change."""
    out = {}
    for at, _, names in os.walk(folder):
        for name in names:
            if name.startswith("part-"):
                path = os.path.join(at, name)
                out[os.path.relpath(path, folder)] = (os.path.getsize(path), os.path.getmtime(path))
    return out


ORDERS = [
    ["1", "05/01/2024", "A", "NB", "Tas", "Rp50.000", "Rp0", "Rp50.000", "", "Paid", "Vian"],
    ["2", "06/01/2024", "A", "NB", "Tas", "Rp40.000", "Rp0", "Rp40.000", "", "Paid", "Vian"],
    ["3", "07/02/2024", "A", "NB", "Tas", "Rp30.000", "Rp0", "Rp30.000", "", "Paid", "Rio"],
    ["4", "08/03/2023", "B", "NB", "Tas", "Rp20.000", "Rp0", "Rp20.000", "", "Paid", "Rio"],
]


def test_only_touched_months_are_written(spark, paths, tmp_path):  # noqa: F811
    warehouse = str(tmp_path / "wh")
    given = changed(paths, orders_2023=write(tmp_path / "a.csv", ORDER_HEADER, ORDERS))
    ingest.load(spark, given, warehouse)
    jobs.run(spark, ["refresh", "--warehouse", warehouse, "--share", "0.40"])
    before = {name: stored(f"{warehouse}/marts/{name}") for name in ("fct_orders", *refresh.monthly("0.40"))}
    january = spark.table("fct_monthly_revenue").filter("year = 2024 AND month = 1").first()
    assert (january["orders"], january["revenue"]) == (2, 90000)

    # Another price in January, and the only order of February moves to the year before.
    moved = [list(r) for r in ORDERS]
    moved[1][5] = moved[1][7] = "Rp45.000"
    moved[2][1] = "07/02/2023"
    ingest.load(spark, changed(paths, orders_2023=write(tmp_path / "b.csv", ORDER_HEADER, moved)), warehouse)
    done = refresh.refresh_marts(spark, warehouse, "0.40", since=1)
    assert done["months"] == [(2023, 2), (2024, 1), (2024, 2)] and done["years"] == [(2023,), (2024,)]
    for name in ("fct_salary", "fct_monthly_revenue", "fct_profit"):
        after = stored(f"{warehouse}/marts/{name}")
        keep = lambda files: {f: s for f, s in files.items() if not any(p in f for p in ("year=2024/month=1/", "year=2024/month=2/", "year=2023/month=2/"))}
        assert keep(before[name]) and keep(before[name]) == keep(after)
        assert not any("year=2024/month=2/" in f for f in after)

    # The same as building everything anew.
    orders = staging.staged_orders(spark.table("raw_orders"))
    bills = staging.stg_expenses(spark.table("raw_expenses"))
    for name, build in refresh.monthly("0.40").items():
        whole = build(orders, bills)
        assert sorted(map(str, spark.table(name).select(*whole.columns).collect())) == sorted(map(str, whole.collect())), name
    whole = marts.fct_orders(orders)
    assert sorted(map(str, spark.table("fct_orders").select(*whole.columns).collect())) == sorted(map(str, whole.collect()))

    # Nothing has changed since: nothing is written.
    files = {name: stored(f"{warehouse}/marts/{name}") for name in before}
    assert refresh.refresh_marts(spark, warehouse, "0.40", since=2) == {"months": [], "years": []}
    assert files == {name: stored(f"{warehouse}/marts/{name}") for name in before}


def test_ids_are_published_and_gone_on_from(spark, paths, tmp_path):  # noqa: F811
    warehouse = str(tmp_path / "wh")
    ingest.load(spark, changed(paths, orders_2023=write(tmp_path / "a.csv", ORDER_HEADER, ORDERS)), warehouse)
    jobs.run(spark, ["ids", "--warehouse", warehouse])
    first = {r["order_id"] for r in spark.table("orders_with_ids").collect()}
    early = [["1", "01/01/2024", "Early", "NB", "Tas", "Rp1.000", "Rp0", "Rp1.000", "", "Paid", "Rio"], *ORDERS]
    ingest.load(spark, changed(paths, orders_2023=write(tmp_path / "b.csv", ORDER_HEADER, early)), warehouse)
    jobs.run(spark, ["ids", "--warehouse", warehouse])
    ids = {(r["customer_name"], r["order_id"]) for r in spark.table("orders_with_ids").collect()}
    assert first < {i for _, i in ids} and ("Early", "2024_0001_2") in ids and ("A", "2024_0001") in ids
    assert set(versions.manifest(spark, warehouse)["tables"]) == {"raw_orders", "raw_expenses", "load_rejects", "order_ids", "orders_with_ids"}
    assert spark.table("raw_orders").columns == [f.split()[0] for f in V.RAW_ORDERS_SCHEMA.split(", ")]


# --- the checklist's findings -----------------------------------------------------


def test_findings(spark):
    d = dt.date
    rows = [
        (1, d(2023, 6, 1), "A", 50000, 10000), (2, d(2023, 6, 2), "A", 50000, 10000), (3, d(2023, 7, 1), "A", 50000, 8000),
        (4, d(2023, 8, 1), "A", 50000, 8000), (5, d(2023, 8, 2), "B", 50000, 5000), (6, d(2023, 8, 3), "B", 50000, 5000),
        (7, d(2023, 8, 4), "B", 50000, None), (8, None, "C", 50000, 7000), (9, None, "C", 50000, 10000),
    ]
    frame = orders_frame(spark, rows)
    fct = marts.fct_orders(frame)
    assert {r["order_no"] for r in marts.unearned_loyalty(fct).collect()} == {1}
    audit = {r["year"]: r[1:] for r in marts.loyalty_audit(fct).collect()}
    assert audit == {2023: (1, 2, 1), None: (1, 0, 0)}
    assert sorted((tuple(r) for r in marts.confined_discounts(frame).collect()), reverse=True) == [(10000, 2023, 6, 2), (5000, 2023, 8, 2)]
    bags = frame.withColumn("service_type", F.when(F.col("order_no") < 3, "Deep Clean").when(F.col("order_no") < 5, " TAS ").otherwise("?"))
    bags = bags.withColumn("price", F.when(F.col("order_no") < 3, 50000).otherwise(80000)).withColumn("shoe_type", F.lit("vans"))
    got = {r["service_category"]: (r["orders"], r["avg_price"], r["is_above"]) for r in marts.services_above(bags).collect()}
    assert got == {"Deep Clean": (2, 50000.0, False), "Tas": (2, 80000.0, True), None: (5, 80000.0, True)}


def test_numbering_moves_rows_once(spark):
    from tillbook.operators.numbering import number_within

    rows = [(None if i % 3 else "hot", i % 7, f"t{i}") for i in range(5000)]
    frame = spark.createDataFrame(rows, "k string, v int, t string")
    numbered = number_within(frame, ["k"], [F.col("v"), F.col("t")], "n")
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "__range" in line]
    assert not wide and "Bucketed: true" in plan
    want = {}
    for key in (None, "hot"):
        for n, r in enumerate(sorted((r for r in rows if r[0] == key), key=lambda r: r[1:]), 1):
            want[r] = n
    assert {tuple(r)[:3]: r["n"] for r in numbered.collect()} == want
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("scratch_")]
