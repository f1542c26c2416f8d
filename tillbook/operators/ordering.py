"""Total order over stored rows, whatever the keys' distribution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TIE = "__tie"


def n_ranges(stored: DataFrame) -> int:
    """One per scan split, as far as Spark stores that many buckets (raise that setting with the input)."""
    most = int(stored.sparkSession.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    return min(max(1, stored.rdd.getNumPartitions()), most)


def sort_over_ranges(stored: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Sort a stored frame into as many ranges as it has scan splits.

    A range thus holds about ``spark.sql.files.maxPartitionBytes`` of stored data, however
    much there is; raise that setting to have fewer, larger ranges. A running id 
    stands behind the keys: rows with equal keys, even exact copies, can then be cut over
    several ranges instead of filling one. Over stored files the id is the same whenever
    a task is repeated, so a lost executor changes nothing.
    """
    ranges = n_ranges(stored)
    keys = [*order, F.col(_TIE).asc()]
    tied = stored.withColumn(_TIE, F.monotonically_increasing_id())
    return tied.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys).drop(_TIE)
