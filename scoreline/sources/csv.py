"""CSV files with one header line or with two."""

from __future__ import annotations

import csv
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.columns import join_header_levels
from ..storage import settle


def read_with_header(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header line and a declared schema."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def read_two_row_header(spark: SparkSession, path: str,
                        rule: Callable[[str], str] = lambda name: name) -> DataFrame:
    """CSV files whose column names are header line 1, ``_`` and header line 2.

    All columns are text. Every file has both header lines, the same in all files, and
    no line break inside a cell. They are dropped by their place in the file, so that a data
    row may equal a header line.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    upper_line, lower_line = [r.value for r in lines.where("_metadata.file_block_start = 0").head(2)]
    upper, lower = csv.reader([upper_line, lower_line])
    names = join_header_levels(upper, lower, rule)
    places = [f"c{i}" for i in range(len(names))]
    schema = T.StructType([T.StructField(p, T.StringType()) for p in places])
    # Spark drops the first line of each file; the second is the first row of the file's first block.
    rows = spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("recursiveFileLookup", True).csv(path).select(
        *places, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_place"))
    second = rows.where(F.col("_block") == 0).groupBy(F.col("_file").alias("_of")).agg(F.min("_place").alias("_second"))
    kept = rows.join(settle(second, "header-lines"), (F.col("_file") == F.col("_of")) & (F.col("_place") == F.col("_second")), "left_anti")
    return kept.select(*places).toDF(*names)
