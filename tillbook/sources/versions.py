"""Which run's files the tables are, as a numbered list of manifests in the warehouse.

A load writes its files into a folder of its own, ``runs/<run>/<table>``, and then adds one
manifest that names them all: a file renamed into place, which fails if the number is
taken. Until then readers have the former run, from then on the new one, never a mixture
and never none. Views of the tables' names follow the newest manifest for users of SQL;
each is replaced in one step. Files of former runs stay until ``expire`` removes those
that no kept manifest names.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

RUNS, MANIFESTS = "runs", "_manifests"
ATTEMPTS = 20


def _fs(spark: SparkSession, path: str):
    """(file system, path) of the JVM."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _listed(spark: SparkSession, path: str) -> list:
    fs, at = _fs(spark, path)
    return list(fs.listStatus(at)) if fs.exists(at) else []


def run_folder(warehouse: str, run: str) -> str:
    return f"{warehouse.rstrip('/')}/{RUNS}/{run}"


def new_run() -> str:
    return uuid.uuid4().hex


def _manifest_path(warehouse: str, number: int) -> str:
    return f"{warehouse.rstrip('/')}/{MANIFESTS}/{number:012d}.json"


def numbers(spark: SparkSession, warehouse: str) -> list[int]:
    """Numbers of all manifests, oldest first."""
    names = [f.getPath().getName() for f in _listed(spark, f"{warehouse.rstrip('/')}/{MANIFESTS}")]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))


def manifest(spark: SparkSession, warehouse: str, number: int | None = None) -> dict | None:
    """The newest manifest, or that of a number; None before the first load.

    Keys: number, run, tables (name to path).
    """
    for _ in range(ATTEMPTS):
        known = numbers(spark, warehouse)
        if not known:
            return None
        fs, at = _fs(spark, _manifest_path(warehouse, known[-1] if number is None else number))
        try:
            file = fs.open(at)
        except Exception:
            # The newest may expire between listing and reading, but not without a newer one.
            if number is not None or fs.exists(at):
                raise
            continue
        try:
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8")
        finally:
            file.close()
        return json.loads(text)
    raise RuntimeError(f"no manifest could be read in {warehouse}")


def commit(spark: SparkSession, warehouse: str, run: str, tables: Mapping[str, str]) -> int:
    """Make these files the tables; returns the manifest's number.

    Of two loads that commit at once, the later one gets the next number. Tables that the
    newest manifest has and ``tables`` lacks stay as they are.
    """
    for _ in range(ATTEMPTS):
        newest = manifest(spark, warehouse)
        number = newest["number"] + 1 if newest else 1
        all_tables = {**(newest["tables"] if newest else {}), **tables}
        target = _manifest_path(warehouse, number)
        fs, draft = _fs(spark, f"{warehouse.rstrip('/')}/{MANIFESTS}/.{uuid.uuid4().hex}")
        out = fs.create(draft)
        try:
            out.write(json.dumps({"number": number, "run": run, "tables": all_tables}).encode())
        finally:
            out.close()
        if _moved(spark, draft, target):
            return number
        fs.delete(draft, False)
    raise RuntimeError(f"{warehouse} is being committed to all the time")


def _moved(spark: SparkSession, draft, target: str) -> bool:
    """Rename unless the name is taken."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(target)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        at.getFileSystem(spark._jsc.hadoopConfiguration()).getUri(), spark._jsc.hadoopConfiguration()
    )
    none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(draft, at, none)
    except Exception as error:
        if "FileAlreadyExistsException" in str(error):
            return False
        raise
    return True


def snapshot(spark: SparkSession, warehouse: str, number: int | None = None) -> dict[str, DataFrame]:
    """All tables of one manifest, so tables that belong together come from the same load."""
    found = manifest(spark, warehouse, number)
    return {} if found is None else {name: spark.read.parquet(path) for name, path in found["tables"].items()}


def point(spark: SparkSession, name: str, path: str) -> None:
    """Let a name in the catalog read these files, in one step.

    A real table of that name, as earlier versions of this library made, is dropped first.
    """
    quoted = path.replace("`", "``")
    view = f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{quoted}`"
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType not in ("VIEW", "TEMPORARY"):
        spark.sql(f"DROP TABLE {name}")
    spark.sql(view)


def publish(spark: SparkSession, warehouse: str, run: str, tables: Mapping[str, str]) -> int:
    """Commit, then point the names in the catalog at the files."""
    number = commit(spark, warehouse, run, tables)
    for name, path in tables.items():
        point(spark, name, path)
    return number


def restore(spark: SparkSession, warehouse: str, number: int) -> int:
    """Make an earlier manifest's files the tables again, under a new number."""
    earlier = manifest(spark, warehouse, number)
    return publish(spark, warehouse, earlier["run"], earlier["tables"])


def _pointed_at(spark: SparkSession, names: Sequence[str]) -> list[str]:
    """Definitions of the views of these names."""
    texts = []
    for name in names:
        try:
            rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
        except PySparkException:
            continue
        texts += [r["data_type"] for r in rows if r["col_name"] == "View Text"]
    return texts


def expire(spark: SparkSession, warehouse: str, keep: int = 3, older_than_hours: float = 24.0) -> list[str]:
    """Delete what no longer counts; returns the runs deleted.

    The newest ``keep`` manifests stay, and each run that one of them or a view in the
    catalog names. Other runs go once nothing in them has been written for so many hours:
    a load that has not been committed yet is left alone, and so are readers that began
    with a run shortly before it was replaced.
    """
    if keep < 1:
        raise ValueError("the newest manifest cannot be deleted")
    known = numbers(spark, warehouse)
    kept = [manifest(spark, warehouse, n) for n in known[-keep:]]
    names = sorted({name for m in kept for name in m["tables"]})
    in_use = [path for m in kept for path in m["tables"].values()] + _pointed_at(spark, names)
    cutoff = (time.time() - older_than_hours * 3600) * 1000
    gone = []
    for folder in _listed(spark, f"{warehouse.rstrip('/')}/{RUNS}"):
        run = folder.getPath().getName()
        path = run_folder(warehouse, run)
        written = [folder.getModificationTime(), *[f.getModificationTime() for f in _listed(spark, path)]]
        if any(run in place for place in in_use) or max(written) > cutoff:
            continue
        fs, at = _fs(spark, path)
        fs.delete(at, True)
        gone.append(run)
    for number in known[:-keep]:
        fs, at = _fs(spark, _manifest_path(warehouse, number))
        if fs.getFileStatus(at).getModificationTime() <= cutoff:
            fs.delete(at, False)
    return sorted(gone)
