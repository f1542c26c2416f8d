"""Facts and dimensions over the staged ledgers.

Aggregates combine before they shuffle, so a hot worker, month or customer costs
no more than any other. The two marts that number rows within a group use
``number_within``, which splits every group over the ranges of a sort.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillbook import fixed_values as V
from tillbook.functions import rules
from tillbook.functions.text import folded
from tillbook.operators.numbering import number_in_groups, number_within
from tillbook.sources.scratch import write_scratch

# What settles the order of a customer's orders on one day; all remaining columns follow,
# so only rows that are alike in everything are interchangeable.
TIE_BREAK = ["order_no", "price", "discount", "total_price", "shoe_type", "service_type", "worker"]

# Stands in an order id for a year or number that is not known.
MISSING_PART = "none"


def _total_order(df: DataFrame, first: Sequence[str]) -> list[Column]:
    """The given columns, then all others by name."""
    rest = sorted(c for c in df.columns if c not in first)
    return [F.col(c).asc_nulls_last() for c in [*first, *rest]]


def _sum(c: str | Column) -> Column:
    return F.sum(c).cast("bigint")


# --- order grain ------------------------------------------------------------


def fct_orders(staged: DataFrame, tie_break: Sequence[str] = tuple(TIE_BREAK), stored: bool = False) -> DataFrame:
    """Staged orders with their place in the customer's year and the loyalty audit.

    Every even order of a customer in a year earns the loyalty discount; a smaller
    discount than earned counts as missed. ``stored`` as in ``number_within``.
    """
    order = _total_order(staged, ["order_date", *tie_break])
    numbered = number_within(
        staged, ["customer_name_clean", "year"], order, "order_sequence_per_customer", stored
    )
    place = F.col("order_sequence_per_customer")
    earned = F.when(place % 2 == 0, F.lit(V.LOYALTY_DISCOUNT)).otherwise(F.lit(0))
    return numbered.withColumns(
        {
            "is_repeat_customer": place > 1,
            "expected_discount": earned,
            "discount_gap": earned - F.col("discount"),
            "is_discount_missed": earned - F.col("discount") > 0,
        }
    )


def order_id(copy: Column, width: int = 4) -> Column:
    """Year and padded number, ``_n`` from the second copy of a number on."""
    number = F.abs("order_no").cast("string")
    sign = F.when(F.col("order_no") < 0, F.lit("-")).otherwise(F.lit(""))
    padded = F.concat(sign, F.lpad(number, F.greatest(F.lit(width), F.length(number)), F.lit("0")))
    missing = F.lit(MISSING_PART)
    return F.concat_ws(
        "_",
        F.coalesce(F.col("year").cast("string"), missing),
        F.coalesce(padded, missing),
        F.when(copy > 1, copy.cast("string")),
    )


def _copies_order(staged: DataFrame) -> list[Column]:
    tie = [c for c in TIE_BREAK if c != "order_no"]
    return _total_order(staged, ["order_date", "customer_name_clean", *tie])


def order_surrogate_key(staged: DataFrame, width: int = 4) -> DataFrame:
    """``source_year`` and ``order_id``: year and padded number, ``_n`` on repeats.

    Numbers longer than the pad width are kept whole, a sign stands before the padding,
    and a missing part reads ``none``: no two rows share an id. Ids follow all rows, so a
    late row can move them; ``stable_order_ids`` keeps those once given.
    """
    with_copy = number_within(staged, ["year", "order_no"], _copies_order(staged), "__copy")
    return with_copy.withColumns({"source_year": F.col("year"), "order_id": order_id(F.col("__copy"), width)}).drop("__copy")


#: What makes an order the same order in a later load: who brought what, when, at which price.
#: Notes and payment status may change without a new id.
IDENTITY = ["order_date", "customer_name_clean", *TIE_BREAK]

#: Ids given so far: the order by content, which of its exact copies, and its place among the
#: orders of its year and number.
ORDER_IDS_SCHEMA = "content string, twin bigint, year int, order_no bigint, copy bigint"
_ORDER_IDS = ["content", "twin", "year", "order_no", "copy"]


def stable_order_ids(
    staged: DataFrame, known: DataFrame | None, width: int = 4, stored: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Orders with ids that stay, and the ids given so far, to be stored for the next load.

    ``known`` is what the previous call returned as its second frame, None at first. Orders
    it has (alike in ``IDENTITY``) keep their id; new ones take the copies behind the greatest
    given for their year and number, in the order of ``order_surrogate_key``. Ids of
    orders that have gone are not given again. Orders alike in ``IDENTITY`` are twins:
    which twin has which id is settled by their other columns and may change with them.
    ``stored`` as in ``number_within``.
    """
    content = F.sha2(F.to_json(F.struct(*IDENTITY), {"ignoreNullFields": "false"}), 256)
    keyed = staged.withColumn("__content", content)
    named = number_in_groups(keyed, ["__content"], _total_order(keyed, ["__content"]), "__twin", stored)
    named = write_scratch(named.withColumnsRenamed({"__content": "content", "__twin": "twin"}))
    # Orders alike in IDENTITY are twins, so their order of copies is that of the twins.
    order = [F.asc_nulls_last(c) for c in ("__given", *(c for c in IDENTITY if c != "order_no"), "twin")]
    new = named.select("content", "twin", "year", *IDENTITY)
    if known is None:
        both = new.withColumn("__given", F.lit(None).cast("bigint"))
    else:
        fresh = new.join(known.select("content", "twin"), ["content", "twin"], "left_anti")
        given = known.withColumnRenamed("copy", "__given")
        # Orders with an id come first, in its order, and so take the same place again.
        both = given.unionByName(fresh, allowMissingColumns=True)
    ids = write_scratch(number_in_groups(both, ["year", "order_no"], order, "copy").select(*_ORDER_IDS))
    # A row on each side for each (content, twin): no key is hot.
    joined = named.join(ids.select("content", "twin", "copy"), ["content", "twin"])
    with_ids = joined.withColumns({"source_year": F.col("year"), "order_id": order_id(F.col("copy"), width)})
    return with_ids.select(*staged.columns, "source_year", "order_id"), ids


# --- monthly facts ----------------------------------------------------------


# Marts of revenue sum ``total_price``; with revenue="net_revenue", on the result of
# ``staging.with_revenue``, unpaid and free orders count as orders but earn nothing.


def fct_monthly_revenue(staged: DataFrame, revenue: str = "total_price") -> DataFrame:
    return staged.groupBy("year", "month").agg(
        F.count("*").alias("orders"), _sum(revenue).alias("revenue")
    )


def yearly_revenue(staged: DataFrame, revenue: str = "total_price") -> DataFrame:
    return staged.groupBy("year").agg(
        F.count("*").alias("orders"), _sum(revenue).alias("revenue")
    )


def revenue_excluded_orders(with_revenue: DataFrame) -> DataFrame:
    """Per year: orders kept out of net revenue, by reason, and the totals they name."""
    status = F.col("payment_status_filled") == V.UNKNOWN_PAYMENT_STATUS
    reason = F.when(status, F.lit("unpaid")).otherwise(F.lit("no_total"))
    return (
        with_revenue.filter(~F.col("is_revenue"))
        .groupBy("year", reason.alias("reason"))
        .agg(F.count("*").alias("orders"), _sum("total_price").alias("excluded"))
    )


def fct_monthly_expenses(expenses: DataFrame) -> DataFrame:
    """Supplies per month; salary rows are not supplies."""
    return (
        expenses.filter(expense_category(F.col("brand")) != V.SALARY_BRAND)
        .groupBy(F.year("expense_date").alias("year"), F.month("expense_date").alias("month"))
        .agg(F.count("*").alias("purchases"), _sum("total_price").alias("expenses"))
    )


def fct_salary(
    staged: DataFrame, share: Decimal | str, payday: int = V.SALARY_DAY, revenue: str = "total_price"
) -> DataFrame:
    """Per worker and month: revenue, the worker's share, what stays in the till.

    The share is the shop's to state; there is no default.
    """
    part = F.lit(Decimal(share)).cast("decimal(9,6)")
    if not 0 <= Decimal(share) <= 1:
        raise ValueError("share must lie between 0 and 1")
    earned = F.col("revenue").cast("decimal(20,0)")
    paid = (earned * part).cast("decimal(26,2)")
    return (
        staged.groupBy("worker", "year", "month")
        .agg(_sum(revenue).alias("revenue"))
        .withColumns(
            {
                "salary": paid,
                "kas": (earned - paid).cast("decimal(26,2)"),
                "pay_date": F.make_date(F.col("year"), F.col("month"), F.lit(payday)),
            }
        )
    )


def fct_profit(
    staged: DataFrame, expenses: DataFrame, share: Decimal | str, revenue: str = "total_price"
) -> DataFrame:
    """Per month: revenue, supplies, salaries and what is left.

    The monthly figures are stacked and summed. That keeps months only one side
    has, as a full outer join would, and needs no join. Revenue and salaries come
    from the same aggregate, so orders are read once.
    """
    zero = F.lit(0)
    earned = fct_salary(staged, share, revenue=revenue).select(
        "year", "month", "revenue", zero.alias("expenses"), "salary"
    )
    supplies = fct_monthly_expenses(expenses).select(
        "year", "month", zero.alias("revenue"), "expenses", zero.alias("salary")
    )
    stacked = earned.unionByName(supplies)
    money = lambda c: F.coalesce(F.sum(c), zero)
    monthly = stacked.groupBy("year", "month").agg(
        money("revenue").cast("bigint").alias("revenue"),
        money("expenses").cast("bigint").alias("expenses"),
        money("salary").cast("decimal(26,2)").alias("salary"),
    )
    left = F.col("revenue") - F.col("expenses") - F.col("salary")
    return monthly.withColumn("profit", left.cast("decimal(26,2)"))


def net_margin(profit: DataFrame) -> DataFrame:
    """Per month: goods cost against revenue; null where there is no revenue."""
    goods = (F.col("revenue") - F.col("expenses")).cast("double")
    share = F.try_divide(goods, F.col("revenue").cast("double"))
    return profit.select("year", "month", "revenue", "expenses", share.alias("net_margin"))


# --- dimensions and summaries ------------------------------------------------


def fct_worker_performance(
    staged: DataFrame, revenue: str = "total_price", year: int | None = None
) -> DataFrame:
    """Per worker: orders and earnings, of all years or of one."""
    chosen = staged if year is None else staged.filter(F.col("year") == year)
    return chosen.groupBy("worker").agg(
        F.count("*").alias("orders"), _sum(revenue).alias("earnings")
    )


def dim_customers(staged: DataFrame) -> DataFrame:
    return staged.groupBy("customer_name_clean").agg(
        F.count("*").alias("total_orders"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )


def dim_service_types(staged: DataFrame) -> DataFrame:
    return staged.groupBy("service_type").agg(
        F.count("*").alias("orders"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.avg("price").alias("avg_price"),
    )


def expense_category(brand: Column) -> Column:
    """Salary, or cost of goods."""
    is_salary = F.coalesce(folded(brand) == V.SALARY_BRAND, F.lit(False))
    return F.when(is_salary, F.lit(V.SALARY_BRAND)).otherwise(F.lit("COGS"))


def fct_expenses(expenses: DataFrame) -> DataFrame:
    return expenses.groupBy(expense_category(F.col("brand")).alias("category")).agg(
        F.count("*").alias("purchases"), _sum("total_price").alias("expenses")
    )


def top_customers(staged: DataFrame, k: int = 10, revenue: str = "total_price") -> DataFrame:
    """The k customers with the most revenue; ties by name."""
    return (
        staged.groupBy("customer_name_clean")
        .agg(_sum(revenue).alias("revenue"))
        .orderBy(F.desc_nulls_last("revenue"), F.asc_nulls_last("customer_name_clean"))
        .limit(k)
    )


def repeat_rate(staged: DataFrame) -> DataFrame:
    """Share of repeat orders per year.

    All of a customer's orders in a year but the first are repeats, so counting per
    customer and year is enough; no row needs its place.
    """
    per_customer = staged.groupBy("year", "customer_name_clean").agg(F.count("*").alias("n"))
    return per_customer.groupBy("year").agg(
        _sum("n").alias("orders"), (F.sum(F.col("n") - 1) / F.sum("n")).alias("repeat_rate")
    )


def missed_discount_by_year(orders: DataFrame) -> DataFrame:
    return orders.groupBy("year").agg(F.count_if("is_discount_missed").alias("missed_discounts"))


def discount_alert(
    orders: DataFrame, limit: int = V.MAX_MISSED_DISCOUNTS_PER_YEAR
) -> DataFrame:
    """Years with more missed discounts than ``limit``."""
    return missed_discount_by_year(orders).filter(F.col("missed_discounts") > limit)


def loyalty_audit(orders: DataFrame) -> DataFrame:
    """Per year: what became of the loyalty discount, by the order's place.

    ``earned`` even orders got it, or more; ``missed`` ones got less; ``unearned`` odd orders
    carry the loyalty label all the same. Orders whose discount is not known count nowhere.
    ``orders`` is ``fct_orders``.
    """
    earned, off = F.col("expected_discount") > 0, F.col("discount")
    return orders.groupBy("year").agg(
        F.count_if(earned & (off >= F.col("expected_discount"))).alias("earned"),
        F.count_if(earned & (off < F.col("expected_discount"))).alias("missed"),
        F.count_if(~earned & (off == V.LOYALTY_DISCOUNT)).alias("unearned"),
    )


def unearned_loyalty(orders: DataFrame) -> DataFrame:
    """The orders that carry the loyalty label on an odd place."""
    columns = ["order_no", "order_date", "customer_name_clean", "order_sequence_per_customer", "discount", "total_price"]
    return orders.filter((F.col("expected_discount") == 0) & (F.col("discount") == V.LOYALTY_DISCOUNT)).select(*columns)


def confined_discounts(staged: DataFrame, least: int = 2) -> DataFrame:
    """Discounts that were given at least so often, but in one month only: undocumented promotions.

    Orders without a date are left out. Counted per discount and month, then per discount.
    """
    dated = staged.filter(F.col("order_date").isNotNull() & (F.col("discount") > 0))
    per_month = dated.groupBy("discount", "year", "month").agg(F.count("*").alias("orders"))
    return (
        per_month.groupBy("discount")
        .agg(F.count("*").alias("months"), *[F.max(c).alias(c) for c in ("year", "month", "orders")])
        .filter((F.col("months") == 1) & (F.col("orders") >= least))
        .drop("months")
    )


def services_above(staged: DataFrame, base: str = "Deep Clean") -> DataFrame:
    """Per service category: prices beside the base category's, and whether they lie above on average.

    Orders of no category are one of their own. After the aggregate there is one row per
    category, few enough for a window without keys.
    """
    category = rules.service_category(F.col("service_type"), F.col("shoe_type"))
    prices = staged.groupBy(category.alias("service_category")).agg(
        F.count("*").alias("orders"), F.avg("price").alias("avg_price"), F.max("price").alias("max_price")
    )
    base_price = F.max(F.when(F.col("service_category") == base, F.col("avg_price"))).over(Window.partitionBy())
    return prices.withColumn("base_price", base_price).withColumn("is_above", F.col("avg_price") > F.col("base_price"))


def pricing_anomalies(staged: DataFrame) -> DataFrame:
    """Free orders (discount equals price) and surcharges (negative discount)."""
    kind = F.when(F.col("discount") < 0, F.lit("surcharge")).when(
        F.col("discount") == F.col("price"), F.lit("free_order")
    )
    columns = [
        "order_no", "order_date", "customer_name_clean", "price", "discount", "total_price",
    ]
    return staged.select(*columns, kind.alias("anomaly")).filter(F.col("anomaly").isNotNull())


def month_gaps(staged: DataFrame) -> DataFrame:
    """Months between the first and the last order that have no order."""
    months = staged.groupBy(F.trunc("order_date", "month").alias("month")).agg(
        F.count("*").alias("orders")
    )
    # One row per calendar month is left: few enough for a window without keys, and
    # the months missing between two neighbours need no second scan or join.
    following = F.lead("month").over(Window.orderBy("month"))
    holes = months.filter(F.col("month").isNotNull()).select(
        F.add_months("month", 1).alias("first"), F.add_months(following, -1).alias("last")
    )
    gaps = holes.filter(F.col("first") <= F.col("last")).select(
        F.explode(F.expr("sequence(first, last, interval 1 month)")).alias("month_start")
    )
    return gaps.select(
        "month_start",
        F.year("month_start").alias("year"),
        F.month("month_start").alias("month"),
    )


#: Ways a brand is cut when the lookup is too large to be broadcast.
BRAND_SALTS = 64


def with_material(staged: DataFrame, materials: DataFrame, salts: int = BRAND_SALTS) -> DataFrame:
    """Add ``shoe_material`` and ``material_complexity`` from the shop's own table.

    ``materials`` has (shoe_brand_clean, shoe_material, material_complexity), one
    row per brand; a repeated brand is an error when the result is computed. Brands it
    lacks are ``Unknown``. The optimiser broadcasts a lookup that is small in bytes; a
    larger one is joined by brand and salt, so one brand is spread over many tasks.
    """
    names = ("shoe_material", "material_complexity")
    repeated = F.concat(F.lit("material lookup repeats the brand "), F.col("shoe_brand_clean"))
    single = materials.groupBy("shoe_brand_clean").agg(
        F.count("*").alias("__n"), *[F.first(c).alias(c) for c in names]
    )
    lookup = single.select(
        "shoe_brand_clean",
        *[F.when(F.col("__n") == 1, F.col(c)).otherwise(F.raise_error(repeated)).alias(c) for c in names],
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("__salt"),
    )
    # From the row itself, so a repeated task deals rows alike.
    salt = F.pmod(F.xxhash64(*staged.columns), F.lit(salts)).cast("int")
    joined = staged.withColumn("__salt", salt).join(lookup, ["shoe_brand_clean", "__salt"], "left")
    return joined.drop("__salt").withColumns(
        {c: F.coalesce(F.col(c), F.lit("Unknown")) for c in names}
    )
