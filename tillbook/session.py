"""Session settings this library relies on.

On a cluster the platform owns the session. ``local_session`` is for tests,
benchmarks and notebooks only.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime re-planning carries most of the scale behaviour: small shuffle
# partitions are merged, skewed join partitions are split, and file sizes follow
# the advisory size. ANSI mode stays on; the library uses try_* where bad input
# is expected.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # The JVM does not compile methods above 8000 bytes of bytecode. Staging is one
    # wide projection, which whole-stage generation puts into a single method; past
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Python call-site capture for error messages took about a third of the time
    # needed to state a wide projection (1.6 s with it, 1.1 s without).
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cpus: int | str = "*", app: str = "tillbook", **conf: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    builder = builder.config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
    builder = builder.config("spark.sql.shuffle.partitions", "8")
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
