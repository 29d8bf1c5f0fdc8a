"""Stored tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession


def scan(spark: SparkSession, path: str) -> DataFrame:
    """A whole Parquet table."""
    return spark.read.parquet(path)


def projected_scan(spark: SparkSession, path: str, columns: Sequence[str], condition: Column) -> DataFrame:
    """Some columns of the rows that satisfy a condition; both reach the file reader."""
    return scan(spark, path).where(condition).select(*columns)


def jdbc_scan(spark: SparkSession, url: str, table: str, properties: Mapping[str, str],
              partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
              partitions: int = 1) -> DataFrame:
    """A table of a database; with a partition column it is read by several tasks.

    Filters and columns chosen afterwards are sent to the database.
    """
    options = {"url": url, "dbtable": table, **properties}
    if partition_column is not None:
        options |= {"partitionColumn": partition_column, "lowerBound": str(lower),
                    "upperBound": str(upper), "numPartitions": str(partitions)}
    return spark.read.format("jdbc").options(**options).load()
