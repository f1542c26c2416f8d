"""The load: feeds to validated, published raw tables."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillbook import fixed_values as V
from tillbook.functions.dates import other_reading
from tillbook.operators import date_order, profile, quality
from tillbook.operators.columns import enforce_schema, union_feeds
from tillbook.operators.observed import Figures, figures
from tillbook.plans import marts, staging
from tillbook.plans import normalize as N
from tillbook.sources import feeds, tables, versions


@dataclass(frozen=True)
class FeedPaths:
    orders_2023: str
    orders_2025: str
    synthetic_orders: str
    expenses_2023: str
    expenses_2025: str
    synthetic_supplies: str


def union_orders(spark: SparkSession, paths: FeedPaths, multiline: Collection[str] = ()) -> DataFrame:
    return union_feeds(
        N.normalize_orders_real(feeds.read_orders_csv(spark, paths.orders_2023, multiline="orders_2023" in multiline), V.REAL_2023),
        N.normalize_orders_real(feeds.read_orders_csv(spark, paths.orders_2025, multiline="orders_2025" in multiline), V.REAL_2025),
        N.normalize_orders_synth(feeds.read_synthetic_csv(spark, paths.synthetic_orders, multiline="synthetic_orders" in multiline)),
    )


def union_expenses(spark: SparkSession, paths: FeedPaths, multiline: Collection[str] = ()) -> DataFrame:
    return union_feeds(
        N.normalize_expenses_real(feeds.read_expenses_csv(spark, paths.expenses_2023, multiline="expenses_2023" in multiline), V.REAL_2023),
        N.normalize_expenses_real(feeds.read_expenses_csv(spark, paths.expenses_2025, multiline="expenses_2025" in multiline), V.REAL_2025),
        N.normalize_expenses_synth(feeds.read_synthetic_csv(spark, paths.synthetic_supplies, multiline="synthetic_supplies" in multiline)),
    )


ORDERS_ORDER = ["order_date", "order_no"]
EXPENSES_ORDER = ["expense_date", "item_name"]


def raw_orders(orders: DataFrame) -> DataFrame:
    """The orders table's rows in table order."""
    return tables.in_order(tables.stage_typed(orders, V.RAW_ORDERS_SCHEMA), ORDERS_ORDER)


def raw_expenses(expenses: DataFrame) -> DataFrame:
    return tables.in_order(tables.stage_typed(expenses, V.RAW_EXPENSES_SCHEMA), EXPENSES_ORDER)


REJECTS = "load_rejects"
REJECTS_SCHEMA = "data_source string, reject_file string, reject_line string"


@dataclass(frozen=True)
class _Ledger:
    """One raw table and how its feeds become it."""

    name: str
    schema: str
    order: Sequence[str]
    date: str
    header: str
    formats: Sequence[str]
    rules: Sequence[quality.Check]
    required: Sequence[str]
    feeds: Mapping[str, tuple]


def _orders_ledger() -> _Ledger:
    real, synthetic = N.normalize_orders_real, N.normalize_orders_synth
    return _Ledger(
        "raw_orders", V.RAW_ORDERS_SCHEMA, ORDERS_ORDER, "order_date", "Tanggal", V.ORDER_DATE_FORMATS,
        quality.order_rules(), V.REQUIRED_ORDER_COLUMNS,
        {"orders_2023": (real, V.REAL_2023), "orders_2025": (real, V.REAL_2025), "synthetic_orders": (synthetic, V.SYNTHETIC_ORDERS)},
    )


def _expenses_ledger() -> _Ledger:
    real, synthetic = N.normalize_expenses_real, N.normalize_expenses_synth
    return _Ledger(
        "raw_expenses", V.RAW_EXPENSES_SCHEMA, EXPENSES_ORDER, "expense_date", "Tanggal", V.EXPENSE_DATE_FORMATS,
        quality.expense_rules(), V.REQUIRED_EXPENSE_COLUMNS,
        {"expenses_2023": (real, V.REAL_2023), "expenses_2025": (real, V.REAL_2025), "synthetic_supplies": (synthetic, V.SYNTHETIC_SUPPLIES)},
    )


class _Staged:
    """A ledger's feeds, parsed once into staged files, and what was seen on the way."""

    def __init__(self, spark: SparkSession, ledger: _Ledger, paths: FeedPaths, multiline: Collection[str], date_formats: Mapping[str, Sequence[str]]):
        self.ledger = ledger
        self.formats = {label: date_formats.get(feed, ledger.formats) for feed, (_, label) in ledger.feeds.items()}
        typed, seen, votes = [], {}, {}
        for feed, (normalize, label) in ledger.feeds.items():
            formats = self.formats[label]
            raw = feeds.read_csv(spark, getattr(paths, feed), multiline=feed in multiline, keep_rejects=True)
            good = F.col(feeds.REJECT_COLUMNS[1]).isNull()
            text = F.when(good, F.col(ledger.header))
            votes[label] = Observation()
            ballots = date_order.ballots(text, formats)
            raw = raw.observe(votes[label], F.count_if(~good).alias("rejects"), *[n.alias(f) for f, n in ballots.items()])
            raw = raw.withColumn(N.OTHER_READING, other_reading(text, formats))
            rows = normalize(raw, label, date_formats=formats)
            quality.require_columns(rows, ledger.required)
            rows = enforce_schema(rows, f"{ledger.schema}, {N.OTHER_READING} date, {', '.join(f'{c} string' for c in feeds.REJECT_COLUMNS)}")
            seen[label] = Observation()
            typed.append(rows.observe(seen[label], *figures(rows, good, ledger.rules, ledger.date, N.OTHER_READING, N.CARRIED)))
        self.rows = tables.write_scratch(union_feeds(*typed))
        self.votes = {label: o.get for label, o in votes.items()}
        self.elected = {label: date_order.elected(self.votes[label], f) for label, f in self.formats.items()}
        # Dates were read by the first slashed format declared; these feeds wrote another one.
        self.turned = [label for label, f in self.formats.items() if self.elected[label] not in (None, date_order.slashed(f)[0])]
        self.seen = {label: Figures(o.get, ledger.rules, label in self.turned) for label, o in seen.items()}

    def accepted(self) -> DataFrame:
        """The table's rows, dated as each feed was elected to write."""
        date, other = F.col(self.ledger.date), F.col(N.OTHER_READING)
        rows = feeds.accepted(self.rows)
        if self.turned:
            turned = F.col("data_source").isin(self.turned) & other.isNotNull()
            rows = rows.withColumn(self.ledger.date, F.when(turned, other).otherwise(date))
        return rows.drop(N.OTHER_READING)

    def n_rejects(self) -> int:
        return sum(v["rejects"] for v in self.votes.values())

    def rejects(self) -> DataFrame:
        return feeds.rejected(self.rows).select("data_source", *feeds.REJECT_COLUMNS)

    def date_votes(self) -> list[tuple]:
        out = []
        for label, formats in self.formats.items():
            counts, orders = self.votes[label], date_order.slashed(formats)
            cast = {date_order.label(f): counts[f] for f in orders}
            lost = sum(counts[f] for f in orders if f != self.elected[label])
            out.append((self.ledger.name, label, cast.get("day_first"), cast.get("month_first"), counts["ambiguous"], self.elected[label], lost))
        return out


def load(
    spark: SparkSession,
    paths: FeedPaths,
    warehouse: str,
    multiline: Collection[str] = (),
    max_rejects: int = 0,
    date_formats: Mapping[str, Sequence[str]] | None = None,
) -> dict[str, DataFrame]:
    """Read, normalise, validate, publish; returns what was seen.

    Each feed is parsed once, and counted while its typed rows are staged: broken lines, the
    vote on its date order, nulls, checks, price figures and the summary per source take no
    scan of their own. Broken lines become rows of ``load_rejects`` with their file and
    text; more than ``max_rejects`` of them, a failed check or a failed write raise and leave
    the tables as they were (``load_rejects`` is then still shown). Else the tables are
    sorted into files of this run and switched together, see ``sources.versions``.

    ``multiline`` names the feeds (fields of ``FeedPaths``) whose cells hold line breaks;
    ``date_formats`` gives feeds formats of their own. Files of earlier loads stay until
    ``versions.expire`` clears them.

    Returns frames: orders and expenses (summary per source); for each also _shape, _nulls,
    _prices, _checks and _head; date_votes; rejects. All but the heads are a few rows that are
    known already.
    """
    run = versions.new_run()
    folder = versions.run_folder(warehouse, run)
    staged = {
        name: _Staged(spark, ledger, paths, multiline, date_formats or {})
        for name, ledger in (("orders", _orders_ledger()), ("expenses", _expenses_ledger()))
    }
    broken = sum(s.n_rejects() for s in staged.values())
    found = union_feeds(*[s.rejects() for s in staged.values()]) if broken else spark.createDataFrame([], REJECTS_SCHEMA)
    rejects = f"{folder}/{REJECTS}"
    tables.save_parquet(found, rejects)
    if broken > max_rejects:
        versions.point(spark, REJECTS, rejects)
        raise quality.DataQualityError(f"rejected_lines failed: {broken} lines, {max_rejects} allowed; see {REJECTS}, {rejects}")
    checks = {name: profile.observed_checks(s.seen.values(), s.ledger.rules) for name, s in staged.items()}
    for failed in (c for some in checks.values() for c in some if not c["passed"]):
        raise quality.failure(failed)
    written = {REJECTS: rejects}
    for s in staged.values():
        written[s.ledger.name] = f"{folder}/{s.ledger.name}"
        tables.save_parquet(tables.in_order(s.accepted(), s.ledger.order), written[s.ledger.name])
    versions.publish(spark, warehouse, run, written)

    report = {
        "date_votes": spark.createDataFrame(
            [row for s in staged.values() for row in s.date_votes()],
            "table_name string, feed string, day_first bigint, month_first bigint, ambiguous bigint, elected string, contradicting bigint",
        ),
        "rejects": spark.read.parquet(rejects),
    }
    for name, s in staged.items():
        report |= profile.observed(spark, name, s.seen, s.ledger.schema, checks[name])
        report[f"{name}_head"] = profile.head(spark.read.parquet(written[s.ledger.name]), [F.col(c).asc_nulls_last() for c in s.ledger.order])
    return report


def build_marts(spark: SparkSession, share: str) -> list[str]:
    """Save the facts and dimensions as tables; returns their names.

    Orders are numbered once: what depends on a customer's order sequence reads the
    saved ``fct_orders``.
    """
    orders = staging.staged_orders(tables.source(spark, "raw_orders"))
    expenses = staging.stg_expenses(tables.source(spark, "raw_expenses"))
    tables.save_table(marts.fct_orders(orders, stored=True), "fct_orders")
    fct_orders = tables.source(spark, "fct_orders")
    built = {
        "fct_monthly_revenue": marts.fct_monthly_revenue(fct_orders),
        "fct_monthly_expenses": marts.fct_monthly_expenses(expenses),
        "fct_salary": marts.fct_salary(fct_orders, share),
        "fct_profit": marts.fct_profit(fct_orders, expenses, share),
        "fct_expenses": marts.fct_expenses(expenses),
        "fct_worker_performance": marts.fct_worker_performance(fct_orders),
        "dim_customers": marts.dim_customers(fct_orders),
        "dim_service_types": marts.dim_service_types(fct_orders),
        "missed_discount_by_year": marts.missed_discount_by_year(fct_orders),
        "loyalty_audit": marts.loyalty_audit(fct_orders),
        "confined_discounts": marts.confined_discounts(fct_orders),
        "services_above": marts.services_above(fct_orders),
    }
    for name, mart in built.items():
        tables.save_table(mart, name)
    return ["fct_orders", *built]


def stage(spark: SparkSession) -> None:
    """Register the staging views over the published tables."""
    tables.register(staging.stg_orders(tables.source(spark, "raw_orders")), "stg_orders")
    tables.register(staging.stg_expenses(tables.source(spark, "raw_expenses")), "stg_expenses")
