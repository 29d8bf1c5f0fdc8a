"""Writing tables.

Rows are first written to a folder beside the table, and its files then renamed into
place: the plan runs once, and a job that dies leaves the table as it was.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .snapshots import ARRIVAL, Snapshots


def write_table(df: DataFrame, path: str, mode: str) -> bool:
    """Replace or append to a Parquet table; an empty frame writes nothing.

    Returns whether anything was written. Readers see the old or the new table; between
    the two renames of a replacement, for a moment, none.
    """
    if mode not in ("replace", "append"):
        raise ValueError("mode must be 'replace' or 'append'")
    spark, staged = df.sparkSession, f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    df.write.parquet(staged)
    jvm = spark._jvm.org.apache.hadoop.fs
    old, new = jvm.Path(path), jvm.Path(staged)
    files = old.getFileSystem(spark._jsc.hadoopConfiguration())
    if spark.read.schema(df.schema).parquet(staged).isEmpty():
        files.delete(new, True)
        return False
    if mode == "append" and files.exists(old):
        for status in files.listStatus(new):
            if status.getPath().getName().startswith("part-"):
                files.rename(status.getPath(), jvm.Path(old, status.getPath().getName()))
        files.delete(new, True)
    else:
        before = jvm.Path(f"{staged}-before")
        existed = files.exists(old) and files.rename(old, before)
        files.rename(new, old)
        if existed:
            files.delete(before, True)
    return True


def replace_table(df: DataFrame, path: str) -> bool:
    """Replace the table."""
    return write_table(df, path, "replace")


def append_table(df: DataFrame, path: str) -> bool:
    return write_table(df, path, "append")


def store_snapshot(df: DataFrame, path: str, mode: str, batch: tuple[str, int] | None = None) -> bool:
    """Replace or append to a table of snapshots: readers see the old or the new rows at any moment.

    ``batch`` is a source and its number; one that was stored before is left out, so that a job can be run
    again after it died. Returns whether anything was stored. ``read_snapshot`` reads the table.
    """
    if mode not in ("replace", "append"):
        raise ValueError("mode must be 'replace' or 'append'")
    table = Snapshots(df.sparkSession, path)
    return (table.replace if mode == "replace" else table.append)(df, batch)


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of the newest snapshot; a table that was never stored is empty."""
    return Snapshots(spark, path).read(schema).drop(ARRIVAL)
