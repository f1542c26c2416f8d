"""Intermediate results that must be read twice, kept where executors can be lost."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.session import SETTINGS

METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    Where that is unset, the warehouse's ``_scratch`` folder stands in, but never a folder of
    one machine for a job on several: that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    master = spark.sparkContext.master
    on_one_machine = master == "local" or master.startswith("local[")
    if not on_one_machine and (warehouse.startswith("file:") or ":/" not in warehouse):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{warehouse}/_scratch"


def _own_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark).rstrip('/')}/tillbook-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession) -> str:
    """A new path in the shared folder."""
    return f"{_own_folder(spark)}/{uuid.uuid4().hex}"


def write_scratch(df: DataFrame, wide: bool = False, **options: int) -> DataFrame:
    """Write once as parquet and read back, cutting the lineage.

    ``options`` are those of the parquet writer. ``wide``: for a projection that would fill one method the JVM refuses to compile; while it
    is written, the session has the limit of ``session.SETTINGS``, whatever it has otherwise.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    had = spark.conf.get(METHOD_LIMIT)
    spark.conf.set(METHOD_LIMIT, SETTINGS[METHOD_LIMIT] if wide else had)
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(METHOD_LIMIT, had)
    return spark.read.schema(df.schema).parquet(path)


def write_scratch_by_partition(df: DataFrame, name: str, partitions: int) -> DataFrame:
    """Write once and read back with each of ``df``'s partitions still in one task.

    Adds a column ``name`` that tells the partitions apart. Spark knows the copy to be dealt
    out by it, so grouping or numbering by it and more moves nothing. The files are buckets,
    one to a partition: ``bucket_values`` has a value for each that falls into a bucket of
    its own. The table that buckets have to be written through is dropped at once; its files
    stay like any other scratch.
    """
    spark = df.sparkSession
    # Constant and part of the projection: a small frame and a join would start Python workers.
    values = F.split(F.lit(",".join(map(str, bucket_values(partitions).tolist()))), ",").cast("array<int>")
    # A partition beyond those promised still has a value of its own, in whatever bucket.
    value = F.coalesce(F.get(values, F.spark_partition_id()), -1 - F.spark_partition_id())
    dealt = df.withColumn(name, value)
    table = f"scratch_{uuid.uuid4().hex}"
    writer = dealt.write.format("parquet").bucketBy(partitions, name).option("path", scratch_path(spark))
    writer.saveAsTable(table)
    stored = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return stored


def bucket_values(n: int) -> np.ndarray:
    """For each of n buckets an integer that Spark's bucketing hash (Murmur3, seed 42) puts there.

    Not one after another: bucket k holds what the k-th value stands for.
    """
    found = np.full(n, -1, np.int64)
    left, start, step = n, 0, max(1024, 4 * n)
    while left:
        tried = np.arange(start, start + step, dtype=np.uint32)
        buckets = _murmur3(tried).astype(np.int32).astype(np.int64) % n
        first, at = np.unique(buckets, return_index=True)
        new = found[first] < 0
        found[first[new]] = tried[at[new]]
        left, start = int((found < 0).sum()), start + step
    return found


def _murmur3(values: np.ndarray) -> np.ndarray:
    """32-bit Murmur3 of 32-bit integers."""
    turned = lambda x, k: (x << np.uint32(k)) | (x >> np.uint32(32 - k))
    with np.errstate(over="ignore"):
        k = turned(values.astype(np.uint32) * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)
        h = turned(np.uint32(42) ^ k, 13) * np.uint32(5) + np.uint32(0xE6546B64)
        h ^= np.uint32(4)
        h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
        h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
        return h ^ (h >> np.uint32(16))


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote, once its results are stored elsewhere.

    Frames built on scratch files cannot be read afterwards.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
