"""The session settings the operators are tuned for."""

from __future__ import annotations

import tempfile
import zipfile
from functools import cache
from pathlib import Path
from threading import Lock

from pyspark.sql import SparkSession

_SHIPPING = Lock()


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "scoreline", shared_folder: str | None = None) -> SparkSession:
    """A session with adaptive execution, skew splitting and UTC timestamps.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: the submit
    command decides them, and adaptive execution merges small partitions.
    ``shared_folder`` becomes ``spark.checkpoint.dir``, where derived tables are written;
    leave it out where the submit command names one.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shared_folder:
        builder = builder.config("spark.checkpoint.dir", shared_folder)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


@cache
def _ship(spark: SparkSession, application: str) -> None:
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(target))


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application, for functions that run in Python workers.

    Spark copies the archive to every executor, later ones included. Fits that run side by side wait for one copy.
    """
    with _SHIPPING:
        _ship(spark, spark.sparkContext.applicationId)
