"""Cutting lineage: intermediate tables written to the shared checkpoint folder.

A staged table is plain Parquet, so later passes read only the columns they need and a
lost executor costs a re-read instead of a recomputation.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from monthmill.workspace import shared_folder

#: Folders of the scope that is open in this thread, if one is.
_scope: ContextVar[list[str] | None] = ContextVar("staging_scope", default=None)
#: With this setting Spark removes the shuffle files of an execution when that ends.
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Staged tables and layers are read a few times at most, so they are kept as small as may be.
COMPRESSION = "zstd"
_ROW_BY_ROW = {"Project", "Filter", "SubqueryAlias", "View", "LogicalRelation", "LocalRelation", "Range"}


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared folder (not created yet)."""
    folder = f"{shared_folder(spark)}/monthmill/{label}-{uuid.uuid4().hex}"
    owned = _scope.get()
    if owned is not None:
        owned.append(folder)
    return folder


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files behind. By default they stay until the driver's JVM finds
    that nothing refers to them, so those of finished jobs lie beside those of the running one."""
    if spark.conf.get(CLEAN, None) == "true":
        yield
        return
    before = spark.conf.get(CLEAN, None)
    spark.conf.set(CLEAN, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEAN)
        else:
            spark.conf.set(CLEAN, before)


def remove(spark: SparkSession, folder: str) -> None:
    """Remove a folder and all below it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once and return a scan of what was written."""
    folder = new_folder(df.sparkSession, label)
    with shuffles_removed(df.sparkSession):
        df.write.option("compression", COMPRESSION).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def is_scan(df: DataFrame) -> bool:
    """Whether a table is read and computed row by row, without joins, aggregates or shuffles.

    Such a table costs no more than its scan each time it is used, and its rows come in the
    same order each time, also when lost work is repeated. This is read off the operators that
    were asked for, so it depends neither on sizes nor on the plan that is chosen for them.
    """
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() in _ROW_BY_ROW:
        if not plan.children().size():
            return True
        plan = plan.children().apply(0)
    return False


def settled(df: DataFrame, label: str = "settled") -> DataFrame:
    """``df`` itself if it is a scan, else a staged copy. For tables that are used repeatedly."""
    return df if is_scan(df) else stage(df, label)


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Remove, on leaving, the tables that this thread staged inside the block."""
    owned: list[str] = []
    token = _scope.set(owned)
    try:
        yield
    finally:
        _scope.reset(token)
        for folder in owned:
            remove(spark, folder)
