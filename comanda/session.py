"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Sequence

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

# Hours and dates are cut in UTC; skewed joins are split even when the
# operator above could have reused the join's partitioning.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Session windows are merged map-side before a key's come together.
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
}

# Folders of this process's applications, removed when it ends.
_run_folders: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings every result here relies on."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; where none is set, one in the warehouse.

    Both are folders that the driver and all executors share.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"


def run_folder(spark: SparkSession) -> str:
    """This application's own part of the shared folder."""
    folder = f"{shared_folder(spark)}/comanda-{spark.sparkContext.applicationId}"
    if not _run_folders:
        atexit.register(remove_run_folders)
    _run_folders.add(folder)
    return folder


def remove_run_folders() -> None:
    """Delete the intermediate tables of this process's applications.

    Runs when the process ends; a job that stops its session before calls it
    itself. Results that still read intermediate tables can't be read after.
    """
    context = SparkContext._active_spark_context
    if context is None or context._jvm is None:
        return
    for folder in list(_run_folders):
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
        _run_folders.discard(folder)


def materialise(df: DataFrame, label: str, folders: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder, by ``folders`` if given, and read it back.

    Cuts the lineage in a way that survives lost executors, and keeps column
    pruning for the readers. The size of the files then tells the planner what
    may be broadcast.
    """
    path = f"{run_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.partitionBy(*folders).parquet(path) if folders else df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
