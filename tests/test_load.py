"""The load: broken lines, date votes, one parse, switching tables, retention."""

import datetime as dt
import os
import shutil
import threading
import time

import pytest
from test_plans import EXPENSE_HEADER, ORDER_HEADER, paths, write  # noqa: F401

from tillbook import jobs
from tillbook.operators import profile, quality
from tillbook.plans import ingest
from tillbook.sources import feeds, tables, versions


def changed(given, **new):
    return ingest.FeedPaths(**{**vars(given), **new})


def spoiled(tmp_path, given, feed, name, *lines):
    """A feed's file with broken lines behind the good ones."""
    text = open(getattr(given, feed), encoding="utf-8").read()
    (tmp_path / name).write_text(text + "".join(f"{line}\n" for line in lines), encoding="utf-8")
    return changed(given, **{feed: str(tmp_path / name)})


def test_broken_lines_are_kept_apart(spark, paths, tmp_path):  # noqa: F811
    warehouse = str(tmp_path / "wh")
    ingest.load(spark, paths, warehouse)
    before = sorted(map(tuple, spark.table("raw_orders").collect()), key=str)
    bad = spoiled(tmp_path, paths, "orders_2023", "o23bad.csv", "64,05/06/2023,too,short", "65,1,2,3,4,5,6,7,8,9,10,11,12")
    bad = spoiled(tmp_path, bad, "expenses_2025", "e25bad.csv", "only one")
    with pytest.raises(quality.DataQualityError, match="rejected_lines failed: 3 lines"):
        ingest.load(spark, bad, warehouse)
    assert sorted(map(tuple, spark.table("raw_orders").collect()), key=str) == before
    found = {(r["data_source"], os.path.basename(r["reject_file"]), r["reject_line"]) for r in spark.table("load_rejects").collect()}
    assert found == {
        ("real_2023", "o23bad.csv", "64,05/06/2023,too,short"),
        ("real_2023", "o23bad.csv", "65,1,2,3,4,5,6,7,8,9,10,11,12"),
        ("real_2025", "e25bad.csv", "only one"),
    }
    out = ingest.load(spark, bad, warehouse, max_rejects=3)
    assert out["rejects"].count() == 3 and spark.table("raw_orders").count() == 5
    assert {r["data_source"]: r["row_count"] for r in out["orders"].collect()}["real_2023"] == 3


def test_kept_rejects_of_one_file(spark, tmp_path):
    (tmp_path / "f.csv").write_text("No,Tanggal,Nama\n1,2023-01-01,A\n2,x\nNA,NA,NA\n")
    rows = feeds.read_csv(spark, str(tmp_path / "f.csv"), keep_rejects=True)
    assert [tuple(r) for r in feeds.accepted(rows).collect()] == [("1", "2023-01-01", "A"), (None, None, None)]
    assert [r["reject_line"] for r in feeds.rejected(rows).collect()] == ["2,x"]
    (tmp_path / "g.csv").write_text("No,reject_line\n1,2\n")
    with pytest.raises(ValueError, match="reject_line"):
        feeds.read_csv(spark, str(tmp_path / "g.csv"), keep_rejects=True)


def test_each_feed_is_parsed_once(spark, paths, tmp_path, monkeypatch):  # noqa: F811
    """The files are taken away as soon as they are staged; the whole load still succeeds."""
    copies = {}
    for feed, path in vars(paths).items():
        copies[feed] = str(tmp_path / f"once_{feed}.csv")
        shutil.copy(path, copies[feed])
    write_scratch, staged = tables.write_scratch, []

    def once(df):
        out = write_scratch(df)
        for path in (f.removeprefix("file://") for f in df.inputFiles()):
            if os.path.basename(path).startswith("once_"):
                staged.append(os.path.basename(path))
                os.rename(path, path + ".taken")
        return out

    monkeypatch.setattr(tables, "write_scratch", once)
    out = ingest.load(spark, ingest.FeedPaths(**copies), str(tmp_path / "wh"))
    assert len(staged) == 6 and len(set(staged)) == 6
    orders, expenses = spark.table("raw_orders"), spark.table("raw_expenses")
    for name, table, date in (("orders", orders, "order_date"), ("expenses", expenses, "expense_date")):
        assert [tuple(r) for r in out[name].collect()] == [tuple(r) for r in profile.source_summary(table, date).collect()]
        assert [tuple(r) for r in out[f"{name}_shape"].collect()] == [tuple(r) for r in profile.shape(table).collect()]
        assert [tuple(r) for r in out[f"{name}_nulls"].collect()] == [tuple(r) for r in profile.null_counts(table).collect()]
        rules = quality.order_checks if name == "orders" else quality.expense_checks
        assert [tuple(r) for r in out[f"{name}_checks"].collect()] == [tuple(r)[1:] for r in rules(table).collect()]
        stats = {r["column_name"]: r for r in profile.price_stats(table).collect()}
        for r in out[f"{name}_prices"].collect():
            want = stats[r["column_name"]]
            assert (r["count"], r["min"], r["max"]) == (want["count"], want["min"], want["max"])
            assert r["mean"] == pytest.approx(want["mean"]) and r["std"] == pytest.approx(want["std"])
        assert out[f"{name}_head"].count() == table.count()


def expense_feed(tmp_path, name, *days):
    return write(tmp_path / name, EXPENSE_HEADER, [[d, f"i{n}", "b", "Rp1.000", "1", "Rp1.000", ""] for n, d in enumerate(days)])


@pytest.mark.parametrize(
    ("days", "read", "vote"),
    [
        (["05/06/2023", "25/06/2023", "2023-01-02", "7/7/2023"], [(6, 5), (6, 25), (1, 2), (7, 7)], (1, 0, 1, "d/M/yyyy", 0)),
        (["05/06/2023", "06/25/2023"], [(5, 6), (6, 25)], (0, 1, 1, "M/d/yyyy", 0)),
        (["05/06/2023", "01/02/2023"], [(5, 6), (1, 2)], (0, 0, 2, "M/d/yyyy", 0)),
        (["05/06/2023", "25/06/2023", "26/06/2023", "06/27/2023"], [(6, 5), (6, 25), (6, 26), (6, 27)], (2, 1, 1, "d/M/yyyy", 1)),
    ],
)
def test_a_feed_votes_on_its_date_order(spark, paths, tmp_path, days, read, vote):  # noqa: F811
    out = ingest.load(spark, changed(paths, expenses_2023=expense_feed(tmp_path, "days.csv", *days)), str(tmp_path / "wh"))
    got = {r["item_name"]: (r["expense_date"].month, r["expense_date"].day) for r in spark.table("raw_expenses").filter("data_source = 'real_2023'").collect()}
    assert [got[f"i{n}"] for n in range(len(days))] == read
    row = out["date_votes"].filter("table_name = 'raw_expenses' AND feed = 'real_2023'").first()
    assert (row["day_first"], row["month_first"], row["ambiguous"], row["elected"], row["contradicting"]) == vote
    first = out["expenses"].filter("data_source = 'real_2023'").first()
    assert (first["earliest"], first["latest"]) == (dt.date(2023, *min(read)), dt.date(2023, *max(read)))


def test_readers_never_miss_a_table(spark, paths, tmp_path):  # noqa: F811
    warehouse = str(tmp_path / "wh")
    ingest.load(spark, paths, warehouse)
    fewer = changed(
        paths,
        orders_2023=write(tmp_path / "few.csv", ORDER_HEADER, [["62", "05/06/2023", "A", "NB", "Tas", "Rp1", "Rp0", "Rp1", "", "", "V"]]),
        expenses_2023=expense_feed(tmp_path, "fewe.csv", "2023-01-01"),
    )
    wrong, seen, stop = [], set(), threading.Event()

    def read():
        while not stop.is_set():
            try:
                assert spark.table("raw_orders").count() in (3, 5)
                both = versions.snapshot(spark, warehouse)
                seen.add((both["raw_orders"].count(), both["raw_expenses"].count()))
            except Exception as error:  # noqa: BLE001
                wrong.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(10):
        ingest.load(spark, fewer if n % 2 == 0 else paths, warehouse)
    stop.set()
    reader.join()
    assert not wrong, wrong[0]
    assert seen == {(5, 5), (3, 4)}  # both tables of one load, never of two
    assert versions.numbers(spark, warehouse) == list(range(1, 12))


def folders(warehouse):
    return set(os.listdir(os.path.join(warehouse, "runs")))


def test_retention_deletes_only_what_nobody_names(spark, paths, tmp_path):  # noqa: F811
    warehouse = str(tmp_path / "wh")
    for _ in range(4):
        ingest.load(spark, paths, warehouse)
    runs = [versions.manifest(spark, warehouse, n)["run"] for n in range(1, 5)]
    assert versions.expire(spark, warehouse, keep=2, older_than_hours=1) == []  # all too young
    os.makedirs(os.path.join(warehouse, "runs", "being_written"))
    time.sleep(0.1)
    versions.point(spark, "raw_orders", versions.manifest(spark, warehouse, 1)["tables"]["raw_orders"])
    gone = versions.expire(spark, warehouse, keep=2, older_than_hours=0.00001)
    assert gone == sorted([runs[1], "being_written"])  # the first is still named by a view
    assert folders(warehouse) == {runs[0], runs[2], runs[3]}
    assert versions.numbers(spark, warehouse) == [3, 4]
    assert spark.table("raw_orders").count() == 5
    jobs.run(spark, ["restore", "--warehouse", warehouse, "--number", "3"])
    assert versions.manifest(spark, warehouse)["number"] == 5
    assert versions.manifest(spark, warehouse)["run"] == runs[2]
    time.sleep(0.1)
    jobs.run(spark, ["expire", "--warehouse", warehouse, "--keep", "1", "--older-than-hours", "0.00001"])
    assert folders(warehouse) == {runs[2]}
    assert spark.table("raw_orders").count() == 5
    with pytest.raises(ValueError):
        versions.expire(spark, warehouse, keep=0)


def test_two_loads_commit_in_turn(spark, tmp_path, monkeypatch):
    warehouse = str(tmp_path / "wh")
    numbers, late = versions.numbers, []

    def raced(session, place):
        """Another load commits just after this one has looked."""
        known = numbers(session, place)
        if not late:
            late.append(1)
            versions.commit(session, place, "other", {"b": "/b"})
        return known

    monkeypatch.setattr(versions, "numbers", raced)
    assert versions.commit(spark, warehouse, "own", {"a": "/a"}) == 2
    assert versions.manifest(spark, warehouse)["tables"] == {"a": "/a", "b": "/b"}
