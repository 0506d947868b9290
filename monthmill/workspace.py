"""Intermediate tables that one call owns.

A workspace is a folder below the shared checkpoint folder. Tables written to it are plain
Parquet: a lost executor costs a re-read, not a recomputation. Whoever opens a workspace drops
single tables as soon as later ones no longer need them, and closes it once the result is used.
Workspaces share nothing, so threads and sessions cannot remove each other's tables.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a private one only in local mode."""
    context = spark.sparkContext
    local = context.master.startswith("local") and not context.master.startswith("local-cluster")
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not local:
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="monthmill-")
    context.setCheckpointDir(folder)
    return folder


def importable(spark: SparkSession) -> None:
    """Let Python workers on machines that have this folder import the package from it, as the
    driver does. Elsewhere the package is installed or shipped with ``--py-files``."""
    root = str(Path(__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    paths = [path for path in environment.get("PYTHONPATH", "").split(os.pathsep) if path]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


class Workspace:
    """A fresh folder for the intermediate tables of one call."""

    def __init__(self, spark: SparkSession, label: str = "work"):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/monthmill/{label}-{uuid.uuid4().hex}"
        self._count = 0

    def path(self, label: str) -> str:
        """A folder name in the workspace that has not been given out before."""
        self._count += 1
        return f"{self.folder}/{self._count:03d}-{label}"

    def write(self, df: DataFrame, label: str = "table") -> DataFrame:
        """Write ``df`` once and return a scan of what was written; ``drop`` takes that scan."""
        folder = self.path(label)
        df.write.parquet(folder)
        scan = self.spark.read.schema(df.schema).parquet(folder)
        scan.workspace_folder = folder
        return scan

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def drop(self, *tables: DataFrame) -> None:
        """Remove tables that ``write`` returned and that nothing will read any more."""
        for table in tables:
            self._delete(table.workspace_folder)

    def close(self) -> None:
        """Remove everything in the workspace."""
        self._delete(self.folder)
