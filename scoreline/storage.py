"""Tables written to the shared folder of the cluster.

A derived table that a plan reads more than once is written there once and read
back. That cuts the lineage so that a lost executor costs a re-read, not a
recomputation, and it gives the optimizer the real size of the table: a side is
broadcast only when its files are below ``spark.sql.autoBroadcastJoinThreshold``
and joined by shuffle otherwise.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Sequence
from functools import cache

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_SETTING = "spark.checkpoint.dir"


@cache
def _test_folder(application: str) -> str:
    folder = tempfile.mkdtemp(prefix="scoreline-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def _base_folder(spark: SparkSession) -> str:
    named = spark.conf.get(_CHECKPOINT_SETTING, None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_SETTING} to a folder every executor can reach")
    return _test_folder(spark.sparkContext.applicationId)


def _application_folder(spark: SparkSession) -> str:
    return f"{_base_folder(spark).rstrip('/')}/scoreline/{spark.sparkContext.applicationId}"


def workspace(spark: SparkSession, label: str = "table") -> str:
    """A fresh path below the folder named by ``spark.checkpoint.dir``."""
    return f"{_application_folder(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str = "table", folders: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; each value of the columns ``folders`` has a folder of its own."""
    spark = df.sparkSession
    path = workspace(spark, label)
    df.write.partitionBy(*folders).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> bool:
    """Delete every table this application wrote to the shared folder.

    Call it when no result that reads such a table is needed any more.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(_application_folder(spark))
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
