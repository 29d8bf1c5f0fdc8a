"""Joins on keys.

No join carries a broadcast hint. The optimizer broadcasts a side when its size,
read from the files or measured at run time, is below the threshold, and splits
skewed partitions of a shuffle join otherwise; ``storage.settle`` gives derived
tables a measured size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import settle
from .order import keep_one


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str] | Mapping[str, str],
            how: str = "inner") -> DataFrame:
    """Join on equal names, or on differing names given as ``{left: right}``.

    With differing names both key columns stay in the result.
    """
    if not isinstance(keys, Mapping):
        return left.join(right, list(keys), how)
    return left.join(right, reduce(and_, [left[a] == right[b] for a, b in keys.items()]), how)


def role_playing_join(facts: DataFrame, dimension: DataFrame, dimension_keys: Sequence[str],
                      sides: Mapping[str, Sequence[str]], columns: Sequence[str],
                      how: str = "inner") -> DataFrame:
    """Join one table once per side.

    ``sides`` maps a suffix to the key columns of the facts; the columns of the
    dimension arrive as ``<column>_<suffix>``.
    """
    joined = facts
    for suffix, fact_keys in sides.items():
        renamed = [f"_{k}_{suffix}" for k in dimension_keys]
        side = dimension.select(
            *[F.col(k).alias(r) for k, r in zip(dimension_keys, renamed, strict=True)],
            *[F.col(c).alias(f"{c}_{suffix}") for c in columns])
        match = reduce(and_, [F.col(f) == F.col(r) for f, r in zip(fact_keys, renamed, strict=True)])
        joined = joined.join(side, match, how).drop(*renamed)
    return joined


def map_lookup(df: DataFrame, column: str, mapping: DataFrame, key: str, value: str,
               result: str, order: Sequence[str]) -> DataFrame:
    """Add ``value`` of the mapping row whose ``key`` equals ``column``.

    Of rows with an equal key the last in ``order`` counts; an absent key gives NULL.
    """
    unique = keep_one(mapping, [key], order, keep="last").select(
        F.col(key).alias("_lookup_key"), F.col(value).alias(result))
    return df.join(unique, F.col(column) == F.col("_lookup_key"), "left").drop("_lookup_key")


def lookup_with_fallback(df: DataFrame, sources: Sequence[tuple[DataFrame, str, str, str]],
                         result: str) -> DataFrame:
    """The value of the first source that has one.

    A source is (table, column of ``df``, key of the table, value of the table);
    keys must be unique per table.
    """
    found = []
    for i, (table, column, key, value) in enumerate(sources):
        side = table.select(F.col(key).alias(f"_key{i}"), F.col(value).alias(f"_value{i}"))
        df = df.join(side, F.col(column) == F.col(f"_key{i}"), "left").drop(f"_key{i}")
        found.append(f"_value{i}")
    return df.withColumn(result, F.coalesce(*found)).drop(*found)


def delete_arriving(stored: DataFrame, arriving: DataFrame, key: str) -> DataFrame:
    """Stored rows whose key does not arrive again."""
    return stored.join(arriving.select(key).distinct(), key, "left_anti")


def numbered_rows(stored: DataFrame, result: str) -> DataFrame:
    """Number the rows of stored files from 0: by file, then by place in the file, however the files are split for reading.

    Rows are counted per file, and a file begins where those before it end; no task sees all rows.
    """
    place = stored.metadataColumn("_metadata")
    counts = settle(stored.select(place["file_path"].alias("_file")).groupBy("_file").agg(F.count(F.lit(1)).alias("_rows")), "files")
    # One row per file.
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = settle(counts.select(F.col("_file").alias("_name"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")), "offsets")
    rows = stored.withColumns({"_file": place["file_path"], "_index": place["row_index"]})
    return rows.join(offsets, F.col("_file") == F.col("_name")).withColumn(result, F.col("_offset") + F.col("_index")).drop("_file", "_name", "_index", "_offset")


def side_by_side(left: DataFrame, right: DataFrame) -> DataFrame:
    """The first row of one stored table beside the first of the other, and so on, without a common key.

    Where one table is shorter, its columns are NULL. Both must be read from files as they are (a filtered frame
    is settled first); a column that both have is an error.
    """
    both = {c.lower() for c in left.columns} & {c.lower() for c in right.columns}
    if both:
        raise ValueError(f"columns of both tables: {sorted(both)}")
    first, second = numbered_rows(left, "_number"), numbered_rows(right, "_other")
    return first.join(second, F.col("_number") == F.col("_other"), "full").drop("_number", "_other")
