"""Session defaults for jobs started by this package."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # bigger scan splits than the 128 MB default: fewer, longer tasks on very large inputs
    "spark.sql.files.maxPartitionBytes": "256m",
    # the JVM does not compile methods beyond 8000 bytes; for very wide projections several
    # small generated methods are much faster than one that stays interpreted
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


#: Settings that a running session can take, for sessions built elsewhere. With the second one AQE starts from
#: many shuffle partitions and puts small ones together, so what a task holds does not grow with the input.
#: With the third a task that holds few months writes them side by side instead of sorting its rows first.
RUNTIME = {
    "spark.sql.codegen.hugeMethodLimit": DEFAULTS["spark.sql.codegen.hugeMethodLimit"],
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "400",
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


def tuned(spark: SparkSession) -> SparkSession:
    """``spark`` with the settings of ``RUNTIME``, but for those it has been given."""
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "monthmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the package defaults; keyword keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    overrides = {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in {**DEFAULTS, **overrides}.items():
        builder = builder.config(key, value)
    return tuned(builder.getOrCreate())
