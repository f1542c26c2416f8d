"""Numbering, quantiles, projections, checks and profiles against brute force."""

import random
import re
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tillbook import fixed_values as V
from tillbook.functions.draws import PRIME, draw
from tillbook.operators import columns, profile, quality
from tillbook.operators.numbering import number_all, number_within
from tillbook.operators.ordering import sort_over_ranges
from tillbook.operators.quantiles import describe_ints
from tillbook.sources.scratch import write_scratch_by_partition


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most rows, half of them exact copies on the sort key."""
    rng = random.Random(7)
    rows = [("hot", rng.randrange(50) if i % 2 else 7, i) for i in range(3000)]
    rows += [(f"c{i % 400}", rng.randrange(9), 10_000 + i) for i in range(1200)]
    rows += [(None, 1, 20_000 + i) for i in range(700)]
    return rows, spark.createDataFrame(rows, "g string, k int, id int").repartition(7)


def expected_numbers(rows, key):
    out, seen = {}, {}
    for g, k, i in sorted(rows, key=lambda r: (r[1], r[2])):
        seen[key(g)] = seen.get(key(g), 0) + 1
        out[i] = seen[key(g)]
    return out


def test_number_all(skewed):
    rows, df = skewed
    got = {r["id"]: r["n"] for r in number_all(df, [F.col("k"), F.col("id")], "n").collect()}
    assert got == expected_numbers(rows, lambda g: 0)


def test_number_within(skewed):
    rows, df = skewed
    out = number_within(df, ["g"], [F.col("k"), F.col("id")], "n")
    assert out.columns == ["g", "k", "id", "n"]
    assert {r["id"]: r["n"] for r in out.collect()} == expected_numbers(rows, lambda g: g)


def test_rows_of_partitions_beyond_those_promised_are_kept(spark):
    stored = write_scratch_by_partition(spark.range(0, 1000, 1, 7), "part", 3)
    found = {r["part"]: r["n"] for r in stored.groupBy("part").agg(F.count("*").alias("n")).collect()}
    assert len(found) == 7 and sum(found.values()) == 1000 and None not in found


def test_number_within_where_more_ranges_are_made_than_asked_for(spark, skewed, monkeypatch):
    rows, df = skewed
    kind, deal = type(df), type(df).repartitionByRange
    monkeypatch.setattr(kind, "repartitionByRange", lambda self, n, *cols: deal(self, max(n, 29), *cols))
    out = number_within(df, ["g"], [F.col("k"), F.col("id")], "n")
    assert {r["id"]: r["n"] for r in out.collect()} == expected_numbers(rows, lambda g: g)


def test_number_within_ties_use_each_number_once(skewed):
    rows, df = skewed
    out = number_within(df, ["g"], [F.col("k")], "n").filter("g = 'hot'")
    got = sorted((r["n"], r["k"]) for r in out.collect())
    assert [n for n, _ in got] == list(range(1, 3001))
    assert [k for _, k in got] == sorted(k for g, k, _ in rows if g == "hot")


def test_hot_group_is_cut_over_ranges(spark, skewed):
    _, df = skewed
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = number_within(df.filter("g = 'hot'"), ["g"], [F.col("k")], "n")
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) >= 4 and max(sizes) < 1500


def test_many_equal_groups_and_one_with_half_of_the_rows(spark):
    """Half of the rows are one group, the others 20,000 groups of five."""
    group = F.when(F.col("id") % 2 == 0, F.lit(-1)).otherwise(F.col("id") % 20_000)
    df = spark.range(0, 200_000, 1, 8).select("id", group.alias("g"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = number_within(df, ["g"], [F.desc("id")], "n").withColumn("task", F.spark_partition_id())
        hot = [r["count"] for r in out.filter("g = -1").groupBy("task").count().collect()]
        groups = out.groupBy("g").agg(F.max("n").alias("top"), F.count_distinct("n").alias("numbers"), F.count("*").alias("rows"))
        assert groups.filter("top <> rows OR numbers <> rows").isEmpty()
        assert max(hot) < 60_000 and len(hot) >= 3
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_ranges_grow_with_stored_bytes(spark, tmp_path):
    spark.range(0, 400_000, 1, 1).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    counts = []
    try:
        for size in ("8m", "64k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            plan = sort_over_ranges(spark.read.parquet(str(tmp_path / "t")), [F.col("id").asc()])
            plan = plan._jdf.queryExecution().optimizedPlan().toString()
            counts.append(int(re.search(r"RepartitionByExpression \[.*\], (\d+)", plan)[1]))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert counts[1] > counts[0] and stored.count() == 400_000


def test_draws_differ_beyond_the_prime(spark):
    ids = [5, 5 + PRIME, 5 + 2 * PRIME, 5 + 2**32, 5 + 2**40]
    rows = spark.createDataFrame([(i,) for i in ids], "id bigint").select(
        *[draw(F.col("id"), s).alias(f"d{s}") for s in range(1, 8)]
    ).collect()
    assert len({tuple(r) for r in rows}) == len(ids)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    values=st.lists(
        st.one_of(st.none(), st.integers(-(2**31), 2**31 - 1), st.integers(-3, 3)), min_size=2, max_size=60
    ).filter(lambda v: any(x is not None for x in v))
)
def test_describe_ints(spark, values):
    row = describe_ints(spark.createDataFrame([(v,) for v in values], "price int"), ["price"]).first()
    kept = sorted(v for v in values if v is not None)
    at = lambda q: (len(kept) - 1) * q

    def quantile(q):
        low = int(at(q))
        high = min(low + 1, len(kept) - 1)
        return kept[low] + (at(q) - low) * (kept[high] - kept[low])

    assert row["count"] == len(kept)
    assert (row["min"], row["max"]) == (kept[0], kept[-1])
    assert row["mean"] == pytest.approx(statistics.fmean(kept), rel=1e-9, abs=1e-6)
    for name, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
        assert row[name] == pytest.approx(quantile(q), rel=1e-9, abs=1e-6)
    if len(kept) > 1:
        assert row["std"] == pytest.approx(statistics.stdev(kept), rel=1e-9, abs=1e-5)
    else:
        assert row["std"] is None


def test_describe_ints_refuses_other_types(spark):
    with pytest.raises(TypeError):
        describe_ints(spark.createDataFrame([(1.5,)], "price double"), ["price"])


def test_projections(spark):
    df = spark.createDataFrame([("1", "a", "z")], "`No` string, `Nama` string, extra string")
    renamed = columns.rename(df, V.ORDER_HEADERS)
    assert renamed.columns == ["order_no", "customer_name", "extra"]
    assert columns.project_present(renamed, ["worker", "order_no"]).columns == ["order_no"]
    with pytest.raises(AnalysisException):
        columns.project(renamed, ["order_no", "worker"]).collect()
    assert columns.keep_up_to(df, "Nama").columns == ["No", "Nama"]
    with pytest.raises(ValueError):
        columns.keep_up_to(df, "Kang Cuci")
    fixed = columns.enforce_schema(renamed, V.RAW_ORDERS_SCHEMA)
    assert len(fixed.columns) == 13 and fixed.first()["worker"] is None


def test_headers_match_case_exactly(spark):
    df = spark.createDataFrame([("1",)], "`Total Harga` string")
    assert columns.rename(df, V.ORDER_HEADERS).columns == ["Total Harga"]
    assert columns.rename(df, V.EXPENSE_HEADERS).columns == ["total_price"]


@pytest.mark.parametrize(("nulls", "passes"), [(3, True), (4, False)])
def test_null_rate_limit(spark, nulls, passes):
    rows = [(None if i < nulls else "x", 1, 1) for i in range(10)]
    df = spark.createDataFrame(rows, "item_name string, quantity int, total_price int")
    if passes:
        quality.validate_expenses(df)
    else:
        with pytest.raises(ValueError, match="item_name_null_rate"):
            quality.validate_expenses(df)


def test_empty_frame_passes(spark):
    quality.validate_expenses(spark.createDataFrame([], "item_name string, quantity int, total_price int"))


ORDERS = "order_no int, order_date date, service_type string, total_price int, worker string"


def test_first_failure_is_reported(spark):
    rows = [(1, None, "x", -5, None)]
    with pytest.raises(quality.DataQualityError, match="order_date_unparseable"):
        quality.validate_orders(spark.createDataFrame(rows, ORDERS))
    with pytest.raises(quality.DataQualityError, match=r"missing columns: \['worker'\]"):
        quality.validate_orders(spark.createDataFrame(rows, ORDERS).drop("worker"))


def test_null_total_is_not_negative(spark):
    df = spark.sql("SELECT 1 order_no, DATE'2023-01-01' order_date, 'x' service_type, CAST(NULL AS INT) total_price, 'w' worker")
    quality.validate_orders(df)


def test_column_presence(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    got = {r["column_name"]: (r["is_present"], r["filled_rows"]) for r in quality.column_presence(df, ["a", "b", "c"]).collect()}
    assert got == {"a": (True, 2), "b": (True, 1), "c": (False, 0)}


def test_spec_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", 2), (None, 3)], "v string, t int")
    assert quality.unique(df, "v").first()["failing"] == 1
    assert quality.accepted_values(df, {"v": ["a"]}).first()["failing"] == 1
    assert quality.not_null(df, ["v"]).first()["failing"] == 1
    assert quality.not_null(df, ["v"], {"v": F.col("t") > 5}).first()["passed"] is True


def test_profile(spark):
    df = spark.createDataFrame([(1, "x", 5), (None, "x", 5), (3, None, 6)], "unit_price int, w string, `Total HARGA` int")
    assert profile.price_columns(df) == ["unit_price", "Total HARGA"]
    assert {r[0]: r[1] for r in profile.null_counts(df).collect()} == {"unit_price": 1, "w": 1, "Total HARGA": 0}
    assert [tuple(r) for r in profile.value_counts(df, "w").collect()] == [("x", 2)]
    assert {r["row_count"] for r in profile.shape(df).collect()} == {3}
    assert [r["unit_price"] for r in profile.head(df, [F.col("unit_price").asc_nulls_last()], 2).collect()] == [1, 3]
