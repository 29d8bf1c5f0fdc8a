"""Row filters. Plain predicates, so that the scan receives them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Text that stands for a missing value in the collected tables.
MISSING_TEXTS = ("nan", "None")


def keep_present(df: DataFrame, *names: str) -> DataFrame:
    """Rows where every named column has a value."""
    return df.na.drop("any", subset=list(names))


def keep_missing(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col(name).isNull())


def null_sentinels(df: DataFrame, names: Sequence[str],
                   sentinels: Sequence[str] = MISSING_TEXTS) -> DataFrame:
    """Turn the texts that stand for a missing value into NULL."""
    return df.withColumns({n: F.when(~F.col(n).isin(*sentinels), F.col(n)) for n in names})


def keep_not_sentinel(df: DataFrame, name: str, sentinels: Sequence[str] = MISSING_TEXTS) -> DataFrame:
    return df.where(F.col(name).isNotNull() & ~F.col(name).isin(*sentinels))


def keep_equal(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    for name, value in values.items():
        df = df.where(F.col(name) == F.lit(value))
    return df


def keep_either_side(df: DataFrame, names: Sequence[str], value: object) -> DataFrame:
    """Rows where any of the named columns has the value."""
    return df.where(reduce(or_, [F.col(n) == F.lit(value) for n in names]))


def drop_matching(df: DataFrame, name: str, pattern: str) -> DataFrame:
    """Rows whose text does not match the pattern."""
    return df.where(~F.col(name).rlike(pattern))


def keep_keys(df: DataFrame, name: str, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in ``keys``: one semi join, no query per key."""
    wanted = keys.select(F.col(key).alias("_wanted")).distinct()
    return df.join(wanted, F.col(name) == F.col("_wanted"), "left_semi")


def drop_any_null(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def distinct_rows(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*names).distinct()
