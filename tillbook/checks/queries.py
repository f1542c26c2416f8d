"""One registered query per operator, each over whole benchmark tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook import fixed_values as V
from tillbook.checks import messy
from tillbook.functions import dates, numbers, rules, text
from tillbook.operators import columns, date_order, profile, quality
from tillbook.operators.numbering import number_all
from tillbook.operators.quantiles import describe_numbers
from tillbook.plans import ingest, marts, refresh, staging, synthetic
from tillbook.plans import normalize as N
from tillbook.sources import feeds, scratch
from tillbook.sources.feeds import missing_as_null

Query = Callable[[SparkSession, str], DataFrame]

# Test-supplied: the ledgers leave both to the shop.
SHARE = "0.40"
MATERIALS = [
    ("Converse", "Canvas", "Low"),
    ("On Running", "Mesh", "Medium"),
    ("Nike", "Leather", "Medium"),
    ("New Balance", "Suede", "High"),
]
SYNTH_START, SYNTH_END = date(2025, 1, 1), date(2026, 4, 14)

_REGISTRY: dict[str, Query] = {}


def _query(fn: Query) -> Query:
    _REGISTRY[fn.__name__.lstrip("_")] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


# --- shared frames -----------------------------------------------------------


def orders_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Typed orders of all feeds, in one scan."""
    cells = missing_as_null(messy.orders_text(spark, sf))
    typed = N.normalize_orders(cells, F.col("data_source"), F.col("is_synthetic"))
    return columns.enforce_schema(typed, V.RAW_ORDERS_SCHEMA)


def expenses_ledger(spark: SparkSession, sf: str) -> DataFrame:
    cells = missing_as_null(messy.expenses_text(spark, sf))
    typed = N.normalize_expenses(cells, F.col("data_source"), F.col("is_synthetic"))
    return columns.enforce_schema(typed, V.RAW_EXPENSES_SCHEMA)


def staged(spark: SparkSession, sf: str) -> DataFrame:
    return staging.staged_orders(orders_ledger(spark, sf))


def staged_expenses(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stg_expenses(expenses_ledger(spark, sf))


def order_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Order text under target names, before any cleaning."""
    return columns.rename(messy.orders_text(spark, sf), V.ORDER_HEADERS)


def expense_cells(spark: SparkSession, sf: str) -> DataFrame:
    return columns.rename(messy.expenses_text(spark, sf), V.EXPENSE_HEADERS)


def _rounded(df: DataFrame, places: int, *names: str) -> DataFrame:
    """Fixed decimals for averages, whose last digit depends on summing order."""
    return df.withColumns({c: F.round(F.col(c), places) for c in names})


# --- scans, loads, projections, unions ---------------------------------------


@_query
def na_tokens_to_null(spark, sf):
    cells = missing_as_null(order_cells(spark, sf))
    return cells.select("order_no", "shoe_type", "notes", "payment_status")


@_query
def raw_orders_load(spark, sf):
    return ingest.raw_orders(orders_ledger(spark, sf))


@_query
def raw_expenses_load(spark, sf):
    return ingest.raw_expenses(expenses_ledger(spark, sf))


@_query
def orders_rename_project(spark, sf):
    return columns.project(order_cells(spark, sf), list(V.ORDER_HEADERS.values()))


@_query
def expenses_rename_project(spark, sf):
    return columns.project(expense_cells(spark, sf), list(V.EXPENSE_HEADERS.values()))


@_query
def lenient_project(spark, sf):
    wanted = ["order_no", "order_date", "customer_name", "delivery_date", "total_price"]
    return columns.project_present(order_cells(spark, sf), wanted)


@_query
def enforce_schema(spark, sf):
    gaps = ["order_date", "price", "discount", "total_price", "payment_status"]
    return columns.enforce_schema(order_cells(spark, sf).drop(*gaps), V.RAW_ORDERS_SCHEMA)


@_query
def truncate_columns_after(spark, sf):
    return columns.keep_up_to(messy.orders_text(spark, sf), "Kang Cuci")


@_query
def union_orders(spark, sf):
    cells = missing_as_null(messy.orders_text(spark, sf))
    merged = columns.union_feeds(
        N.normalize_orders_real(messy.feed(cells, V.REAL_2023), V.REAL_2023),
        N.normalize_orders_real(messy.feed(cells, V.REAL_2025), V.REAL_2025),
        N.normalize_orders_synth(messy.feed(cells, V.SYNTHETIC_ORDERS)),
    )
    return columns.enforce_schema(merged, V.RAW_ORDERS_SCHEMA)


@_query
def union_expenses(spark, sf):
    cells = missing_as_null(messy.expenses_text(spark, sf))
    merged = columns.union_feeds(
        N.normalize_expenses_real(messy.feed(cells, V.REAL_2023), V.REAL_2023),
        N.normalize_expenses_real(messy.feed(cells, V.REAL_2025), V.REAL_2025),
        N.normalize_expenses_synth(messy.feed(cells, V.SYNTHETIC_SUPPLIES)),
    )
    return columns.enforce_schema(merged, V.RAW_EXPENSES_SCHEMA)


# --- filters -----------------------------------------------------------------


@_query
def filter_numeric_order_no(spark, sf):
    """Among numbered rows, summary lines and blanks as sheets have them."""
    key = F.col("o_orderkey")
    number = F.when(key % 50 == 1, key - 1).otherwise(key).cast("string")
    lines = messy.table(spark, sf, "orders").select(
        F.when(key % 211 == 5, "Jumlah")
        .when(key % 211 == 6, "")
        .when(key % 211 == 7, "nan")
        .when(key % 211 == 8, F.concat(number, F.lit(".0")))
        .otherwise(number)
        .alias("order_no_text")
    )
    kept = columns.keep_numeric(lines, "order_no_text")
    return kept.select(numbers.number_to_long(F.col("order_no_text")).alias("order_no"), "order_no_text")


@_query
def filter_null_dates(spark, sf):
    return columns.drop_null(orders_ledger(spark, sf), "order_date")


@_query
def filter_placeholder_rows(spark, sf):
    return columns.drop_placeholders(orders_ledger(spark, sf))


# --- cleaning functions ------------------------------------------------------


@_query
def rp_to_int(spark, sf):
    return messy.orders_text(spark, sf).select(
        F.col("No").alias("order_no"),
        F.col("Harga").alias("price_text"),
        numbers.rupiah_to_int(F.col("Harga")).alias("price"),
        F.col("Discount").alias("discount_text"),
        numbers.rupiah_to_int(F.col("Discount")).alias("discount"),
        numbers.rupiah_to_int(F.col("Total harga")).alias("total_price"),
    )


@_query
def indonesian_month(spark, sf):
    notes = F.col("notes")
    return expense_cells(spark, sf).select(notes, dates.indonesian_month(notes).alias("month_number"))


@_query
def parse_date_dayfirst(spark, sf):
    day = F.col("order_date")
    return order_cells(spark, sf).select(
        "order_no", day.alias("date_text"), dates.parse_order_date(day).alias("order_date")
    )


@_query
def parse_date_multi(spark, sf):
    day = F.col("expense_date")
    return expense_cells(spark, sf).select(
        day.alias("date_text"), dates.parse_expense_date(day).alias("expense_date")
    )


@_query
def safe_quantity(spark, sf):
    count = F.col("quantity")
    return expense_cells(spark, sf).select(
        count.alias("quantity_text"), numbers.number_to_int(count).alias("quantity")
    )


@_query
def impute_expense_date(spark, sf):
    rows = expense_cells(spark, sf).select(
        F.col("expense_date").alias("date_text"),
        "brand",
        "notes",
        dates.parse_expense_date(F.col("expense_date")).alias("parsed"),
        dates.salary_date(F.col("brand"), F.col("notes")).alias("payday"),
    )
    parsed, payday = F.col("parsed"), F.col("payday")
    return rows.select(
        "date_text",
        "brand",
        "notes",
        dates.imputed_date(parsed, payday).alias("expense_date"),
        dates.is_imputed(parsed, payday).alias("is_date_imputed"),
    )


@_query
def coerce_fill_zero(spark, sf):
    count, price = F.col("quantity"), F.col("unit_price")
    return expense_cells(spark, sf).select(
        count.alias("quantity_text"),
        price.alias("price_text"),
        numbers.number_or_zero(count).alias("quantity"),
        numbers.number_or_zero(price).alias("unit_price"),
    )


@_query
def date_parts(spark, sf):
    return staged(spark, sf).select("order_no", "order_date", "year", "month", "week")


@_query
def week_start(spark, sf):
    return orders_ledger(spark, sf).select(
        "order_no", "order_date", dates.week_start(F.col("order_date")).alias("week_start")
    )


@_query
def expense_blank_to_null(spark, sf):
    return expense_cells(spark, sf).select(
        F.col("brand").alias("brand_text"),
        text.blank_to_null(F.col("brand")).alias("brand"),
        text.blank_to_null(F.col("notes")).alias("notes"),
    )


@_query
def notes_clean(spark, sf):
    return order_cells(spark, sf).select(
        "order_no", text.trimmed_or_null(F.col("notes")).alias("notes")
    )


@_query
def expense_calc_total(spark, sf):
    return staged_expenses(spark, sf).select("unit_price", "quantity", "calculated_total_price")


@_query
def expense_price_mismatch(spark, sf):
    return staged_expenses(spark, sf).select(
        "unit_price", "quantity", "total_price", "is_total_price_mismatch"
    )


# --- staging rules, on the text as written (blank and null both occur) --------


@_query
def customer_name_clean(spark, sf):
    name = F.col("customer_name")
    return order_cells(spark, sf).select(
        name, rules.customer_name_clean(name).alias("customer_name_clean")
    )


@_query
def honorific_flag(spark, sf):
    name = F.col("customer_name")
    return order_cells(spark, sf).select(name, rules.has_honorific(name).alias("has_honorific"))


@_query
def payment_method(spark, sf):
    notes = F.col("notes")
    return order_cells(spark, sf).select(notes, rules.payment_method(notes).alias("payment_method"))


@_query
def item_type(spark, sf):
    service = F.col("service_type")
    return order_cells(spark, sf).select(service, rules.item_type(service).alias("item_type"))


@_query
def clean_type(spark, sf):
    service = F.col("service_type")
    return order_cells(spark, sf).select(service, rules.clean_type(service).alias("clean_type"))


@_query
def shoe_brand(spark, sf):
    shoe = F.col("shoe_type")
    return order_cells(spark, sf).select(
        shoe, rules.shoe_brand_clean(shoe).alias("shoe_brand_clean")
    )


@_query
def discount_type(spark, sf):
    return staged(spark, sf).select("discount", "discount_type")


@_query
def stg_orders(spark, sf):
    return staging.stg_orders(orders_ledger(spark, sf))


@_query
def stg_expenses(spark, sf):
    return staged_expenses(spark, sf)


@_query
def staged_item_discount_summary(spark, sf):
    """The flagship: cleaning, rules and one aggregate, end to end."""
    return (
        staged(spark, sf)
        .groupBy("item_type", "discount_type")
        .agg(F.count("*").alias("orders"), F.sum("total_price").alias("revenue"))
    )


# --- profiling and summaries -------------------------------------------------


@_query
def verify_orders(spark, sf):
    summary = profile.source_summary(orders_ledger(spark, sf), "order_date")
    return _rounded(summary, 6, "avg_total_price")


@_query
def verify_expenses(spark, sf):
    summary = profile.source_summary(expenses_ledger(spark, sf), "expense_date")
    return _rounded(summary, 6, "avg_total_price")


@_query
def profile_null_counts(spark, sf):
    return profile.null_counts(orders_ledger(spark, sf))


@_query
def null_rate(spark, sf):
    rates = profile.null_rates(orders_ledger(spark, sf), ["worker", "customer_name", "price"])
    return _rounded(rates, 9, "null_rate")


@_query
def profile_price_stats(spark, sf):
    return _rounded(profile.price_stats(orders_ledger(spark, sf)), 6, "mean", "std")


@_query
def profile_shape(spark, sf):
    return profile.shape(orders_ledger(spark, sf))


@_query
def value_counts_worker(spark, sf):
    return profile.value_counts(orders_ledger(spark, sf), "worker")


@_query
def date_range(spark, sf):
    return profile.date_range(orders_ledger(spark, sf), "order_date")


@_query
def sample_head(spark, sf):
    ledger = orders_ledger(spark, sf)
    order = ["order_date", "order_no", "customer_name", "total_price"]
    order += [c for c in ledger.columns if c not in order]
    return profile.head(ledger, [F.col(c).asc_nulls_last() for c in order])


@_query
def sequence_number(spark, sf):
    order = ["order_date", "order_no", "price", "total_price", "shoe_type", "service_type", "notes"]
    ledger = orders_ledger(spark, sf).select(*order)
    numbered = number_all(ledger, [F.col(c).asc_nulls_last() for c in order], "no")
    return numbered.select("no", "order_date", "order_no", "total_price", "shoe_type")


# --- data quality ------------------------------------------------------------


@_query
def dq_orders(spark, sf):
    return _rounded(quality.order_checks(orders_ledger(spark, sf)), 9, "rate")


@_query
def dq_expenses(spark, sf):
    return _rounded(quality.expense_checks(expenses_ledger(spark, sf)), 9, "rate")


@_query
def dq_required_columns(spark, sf):
    orders = quality.column_presence(orders_ledger(spark, sf), V.REQUIRED_ORDER_COLUMNS)
    expenses = quality.column_presence(expenses_ledger(spark, sf), V.REQUIRED_EXPENSE_COLUMNS)
    named = lambda df, name: df.select(F.lit(name).alias("ledger"), "*")
    return named(orders, "orders").unionByName(named(expenses, "expenses"))


@_query
def dq_not_null(spark, sf):
    names = ["order_no", "order_date", "customer_name_clean", "total_price", "payment_status"]
    return quality.not_null(
        staged(spark, sf), names, where={"payment_status": F.col("total_price") > 0}
    )


@_query
def dq_unique(spark, sf):
    return quality.unique(orders_ledger(spark, sf), "order_no")


@_query
def dq_order_id_unique(spark, sf):
    return quality.unique(marts.order_surrogate_key(staged(spark, sf)), "order_id")


@_query
def dq_order_id_not_null(spark, sf):
    return quality.not_null(marts.order_surrogate_key(staged(spark, sf)), ["order_id"])


@_query
def dq_accepted_values(spark, sf):
    return quality.accepted_values(
        staged(spark, sf),
        {
            "discount_type": V.DISCOUNT_TYPES,
            "item_type": [V.DEFAULT_ITEM, *V.NON_SHOE_SERVICES],
            "clean_type": list(V.SERVICE_PREFIXES.values()),
        },
    )


@_query
def dq_discount_alert(spark, sf):
    return marts.discount_alert(marts.fct_orders(staged(spark, sf)))


# --- facts and dimensions ----------------------------------------------------


@_query
def fct_orders(spark, sf):
    return marts.fct_orders(staged(spark, sf)).select(
        *staging.STG_ORDER_COLUMNS,
        "price",
        "discount",
        "order_sequence_per_customer",
        "is_repeat_customer",
        "expected_discount",
        "discount_gap",
        "is_discount_missed",
    )


@_query
def order_surrogate_key(spark, sf):
    keyed = marts.order_surrogate_key(staged(spark, sf))
    return keyed.select("order_no", "order_date", "source_year", "total_price", "order_id")


@_query
def fct_monthly_revenue(spark, sf):
    return marts.fct_monthly_revenue(staged(spark, sf))


@_query
def fct_monthly_expenses(spark, sf):
    return marts.fct_monthly_expenses(staged_expenses(spark, sf))


@_query
def fct_salary(spark, sf):
    salary = marts.fct_salary(staged(spark, sf), SHARE)
    return salary.withColumns({c: F.col(c).cast("double") for c in ("salary", "kas")})


def _profit(spark, sf):
    return marts.fct_profit(staged(spark, sf), staged_expenses(spark, sf), SHARE)


@_query
def fct_profit(spark, sf):
    return _profit(spark, sf).withColumns(
        {c: F.col(c).cast("double") for c in ("salary", "profit")}
    )


@_query
def net_margin(spark, sf):
    return _rounded(marts.net_margin(_profit(spark, sf)), 9, "net_margin")


@_query
def fct_worker_performance(spark, sf):
    return marts.fct_worker_performance(staged(spark, sf))


@_query
def dim_customers(spark, sf):
    return marts.dim_customers(staged(spark, sf))


@_query
def dim_service_types(spark, sf):
    return _rounded(marts.dim_service_types(staged(spark, sf)), 6, "avg_price")


@_query
def fct_expenses(spark, sf):
    return marts.fct_expenses(staged_expenses(spark, sf))


@_query
def top_customers(spark, sf):
    return marts.top_customers(staged(spark, sf), 10)


@_query
def repeat_rate(spark, sf):
    return _rounded(marts.repeat_rate(staged(spark, sf)), 9, "repeat_rate")


@_query
def missed_discount_by_year(spark, sf):
    return marts.missed_discount_by_year(marts.fct_orders(staged(spark, sf)))


@_query
def pricing_anomalies(spark, sf):
    return marts.pricing_anomalies(staged(spark, sf))


@_query
def month_gaps(spark, sf):
    return marts.month_gaps(staged(spark, sf))


@_query
def shoe_material(spark, sf):
    materials = spark.createDataFrame(
        MATERIALS, "shoe_brand_clean string, shoe_material string, material_complexity string"
    )
    joined = marts.with_material(staged(spark, sf), materials)
    return joined.select("order_no", "shoe_brand_clean", "shoe_material", "material_complexity")


# --- revenue without unpaid and free orders -----------------------------------


def _revenue(spark, sf):
    return staging.with_revenue(staged(spark, sf))


@_query
def payment_status_filled(spark, sf):
    return _revenue(spark, sf).select(
        "order_no", "payment_status", "total_price", "payment_status_filled", "is_revenue", "net_revenue"
    )


@_query
def net_monthly_revenue(spark, sf):
    return marts.fct_monthly_revenue(_revenue(spark, sf), "net_revenue")


@_query
def net_profit(spark, sf):
    profit = marts.fct_profit(
        _revenue(spark, sf), staged_expenses(spark, sf), SHARE, revenue="net_revenue"
    )
    return profit.withColumns({c: F.col(c).cast("double") for c in ("salary", "profit")})


@_query
def revenue_by_year(spark, sf):
    return marts.yearly_revenue(_revenue(spark, sf), "net_revenue")


@_query
def worker_performance_in_year(spark, sf):
    return marts.fct_worker_performance(_revenue(spark, sf), "net_revenue", year=1996)


@_query
def revenue_excluded_orders(spark, sf):
    return marts.revenue_excluded_orders(_revenue(spark, sf))


@_query
def dq_net_not_null(spark, sf):
    names = ["net_revenue", "payment_status_filled", "is_revenue"]
    return quality.not_null(_revenue(spark, sf), names)


# --- feeds read from files, date votes, ids that stay, touched periods ----------


@_query
def csv_rejects(spark, sf):
    """Orders written as a CSV feed, some lines too short or too long, and read back."""
    key = F.col("o_orderkey")
    good = F.concat_ws(",", key, F.to_date("o_orderdate"), F.concat(F.lit("Pelanggan "), "o_custkey"))
    line = F.when(key % 97 == 5, F.concat_ws(",", key, F.to_date("o_orderdate"))).when(
        key % 97 == 6, F.concat(good, F.lit(",extra"))
    )
    # One column of whole lines; the separator and the quote are characters that no line has.
    lines = messy.table(spark, sf, "orders").select(F.coalesce(line, good).alias("No,Tanggal,Nama"))
    path = scratch.scratch_path(spark)
    lines.write.option("header", True).option("sep", "\x01").option("quote", "").csv(path)
    rows = feeds.read_csv(spark, path, keep_rejects=True)
    read = F.col("reject_line").isNull()
    cells = [F.when(read, F.col(h)).alias(name) for h, name in (("No", "order_no"), ("Tanggal", "date_text"), ("Nama", "customer"))]
    return rows.select(*cells, "reject_line", F.col("reject_file").isNotNull().alias("is_rejected"))


@_query
def expense_date_vote(spark, sf):
    cells = missing_as_null(messy.expenses_text(spark, sf))
    return date_order.vote(cells, "Tanggal", V.EXPENSE_DATE_FORMATS, "data_source")


@_query
def expense_dates_as_voted(spark, sf):
    cells = missing_as_null(messy.expenses_text(spark, sf))
    read = date_order.parse_as_voted(cells, "Tanggal", V.EXPENSE_DATE_FORMATS, "data_source", "expense_date")
    return read.select("data_source", F.col("Tanggal").alias("date_text"), "expense_date")


@_query
def stable_order_ids(spark, sf):
    """All orders, one feed of which arrives with a second load."""
    orders = scratch.write_scratch(staged(spark, sf), wide=True)  # one parse for both loads
    _, ids = marts.stable_order_ids(orders.filter(F.col("data_source") != V.REAL_2023), None, stored=True)
    with_ids, _ = marts.stable_order_ids(orders, ids, stored=True)
    return with_ids.select("order_no", "order_date", "source_year", "total_price", "order_id")


@_query
def touched_months(spark, sf):
    """Months that the late feed brings rows for."""
    orders = orders_ledger(spark, sf)
    return refresh.touched(orders.filter(F.col("data_source") != V.REAL_2023), orders, "order_date")


@_query
def describe_any_number(spark, sf):
    buyers = messy.table(spark, sf, "customer")
    key = F.col("c_custkey")
    described = describe_numbers(
        buyers.select(
            (key * 3_000_000_000 - 40_000_000_000).alias("wide"),
            "c_acctbal",
            F.when(key % 7 == 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal") / 3).alias("with_nan"),
            F.col("c_acctbal").cast("decimal(12,2)").alias("exact"),
        ),
        ["wide", "c_acctbal", "with_nan", "exact"],
    )
    return _rounded(described, 4, "mean", "std", "min", "p25", "p50", "p75", "max")


# --- the checklist's rules and findings -------------------------------------------


@_query
def service_category(spark, sf):
    service, shoe = F.col("service_type"), F.col("shoe_type")
    return order_cells(spark, sf).select(
        service, shoe, rules.service_category(service, shoe).alias("service_category"),
        rules.service_category(shoe, service).alias("category_of_shoe_first"),
    )


@_query
def dq_service_category(spark, sf):
    category = rules.service_category(F.col("service_type"), F.col("shoe_type"))
    rows = staged(spark, sf).withColumn("service_category", category)
    accepted = quality.accepted_values(rows, {"service_category": list(V.SERVICE_CATEGORIES.values())})
    return accepted.unionByName(quality.not_null(rows, ["service_category"]))


@_query
def checklist_payment_method(spark, sf):
    notes = F.col("notes")
    return order_cells(spark, sf).select(notes, rules.checklist_payment_method(notes).alias("payment_method"))


@_query
def checklist_item_type(spark, sf):
    """The rule over the shoe column, and over the service column, where bags and carpets stand."""
    shoe, service = F.col("shoe_type"), F.col("service_type")
    return order_cells(spark, sf).select(
        shoe, rules.checklist_item_type(shoe).alias("item_type"),
        service, rules.checklist_item_type(service).alias("item_type_of_service"),
    )


@_query
def loyalty_audit(spark, sf):
    return marts.loyalty_audit(marts.fct_orders(staged(spark, sf)))


@_query
def unearned_loyalty(spark, sf):
    return marts.unearned_loyalty(marts.fct_orders(staged(spark, sf)))


@_query
def confined_discounts(spark, sf):
    return marts.confined_discounts(staged(spark, sf), least=1)


@_query
def services_above(spark, sf):
    return _rounded(marts.services_above(staged(spark, sf)), 6, "avg_price", "base_price")


# --- synthetic feeds, grown from the tables' own keys -------------------------


def _synth(spark, sf):
    ids = messy.table(spark, sf, "orders").select("o_orderkey")
    return synthetic.order_draws(ids, SYNTH_START, SYNTH_END, id_column="o_orderkey")


@_query
def synth_orders(spark, sf):
    return synthetic.number_feed(_synth(spark, sf))


@_query
def synth_service_mix(spark, sf):
    return (
        _synth(spark, sf)
        .groupBy(F.col("Jenis cuci").alias("service_type"))
        .agg(F.count("*").alias("orders"), F.sum("Total harga").alias("revenue"))
    )


@_query
def recurring_schedule(spark, sf):
    part = F.col("p_partkey")
    items = messy.table(spark, sf, "part").select(
        part.alias("item_id"),
        F.col("p_name").alias("item_name"),
        F.col("p_brand").alias("brand"),
        F.floor("p_retailprice").cast("int").alias("unit_price"),
        F.col("p_size").alias("quantity"),
        F.element_at(
            F.array(*[F.lit(k) for k in (1, 2, 3, 4, 6)]), (part % 5 + 1).cast("int")
        ).alias("every_months"),
    )
    return synthetic.generate_supplies(items, SYNTH_START, SYNTH_END)
