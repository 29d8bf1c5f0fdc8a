"""Grouped summaries. Every one combines on the map side before it shuffles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import ratio


def mean_by_keys(df: DataFrame, keys: Sequence[str], metrics: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """The mean of each metric per key; a mapping renames ``{metric: result}``."""
    names = metrics if isinstance(metrics, Mapping) else {m: m for m in metrics}
    return df.groupBy(*keys).agg(*[F.avg(m).alias(r) for m, r in names.items()])


def constant_by_key(df: DataFrame, keys: Sequence[str], names: Mapping[str, str]) -> DataFrame:
    """Columns ``{column: result}`` that are equal on all rows of a key, once per key."""
    return df.groupBy(*keys).agg(*[F.min(c).alias(r) for c, r in names.items()])


def mode_by_key(df: DataFrame, keys: Sequence[str], column: str, result: str) -> DataFrame:
    """The most frequent value per key; of equally frequent ones the smallest."""
    return mode_and_means(df, keys, column, result, {})


def mode_and_means(df: DataFrame, keys: Sequence[str], column: str, mode: str,
                   means: Mapping[str, str]) -> DataFrame:
    """The mode of one column and the means ``{column: result}`` of others, per key.

    Counts and sums per key and value come first, so the second step sees one
    row per key and value only.
    """
    parts = df.groupBy(*keys, column).agg(
        F.count(column).alias("_n"),
        *[F.sum(F.col(c).cast("double")).alias(f"_sum_{r}") for c, r in means.items()],
        *[F.count(c).alias(f"_count_{r}") for c, r in means.items()])
    best = F.min_by(F.col(column), F.when(F.col(column).isNotNull(), F.struct(-F.col("_n"), F.col(column))))
    return parts.groupBy(*keys).agg(
        best.alias(mode),
        *[ratio(F.sum(f"_sum_{r}"), F.sum(f"_count_{r}")).alias(r) for r in means.values()])


def count_pivot(df: DataFrame, keys: Sequence[str], column: str, values: Mapping[object, str]) -> DataFrame:
    """Row counts per key with one column per value; ``values`` maps a value to its column."""
    return df.groupBy(*keys).agg(
        *[F.count_if(F.col(column) == F.lit(v)).alias(name) for v, name in values.items()])


def column_sums(df: DataFrame, names: Sequence[str], divisor: float = 1.0) -> DataFrame:
    """One row with the sum of each column over a constant."""
    return df.agg(*[(F.sum(F.col(n).cast("double")) / F.lit(float(divisor))).alias(n) for n in names])


def min_max_rows(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per column with its bounds."""
    bounds = df.agg(*[F.min(F.col(n).cast("double")).alias(f"min_{n}") for n in names],
                    *[F.max(F.col(n).cast("double")).alias(f"max_{n}") for n in names])
    cells = [F.struct(F.lit(n).alias("column_name"), F.col(f"min_{n}").alias("min"),
                      F.col(f"max_{n}").alias("max")) for n in names]
    return bounds.select(F.inline(F.array(*cells)))


def group_values(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """The values of each group as rows, each distinct value with its multiplicity.

    A group may hold any share of the rows, so its values stay spread over rows
    and are never gathered into one array.
    """
    return df.groupBy(*keys, column).agg(F.count(F.lit(1)).alias("n"))


def count_distinct(df: DataFrame, column: str, result: str) -> DataFrame:
    return df.agg(F.count_distinct(column).alias(result))


def share_by_key(df: DataFrame, keys: Sequence[str], condition: Column, result: str) -> DataFrame:
    """The share of rows that satisfy a condition, e.g. of draws won by a side."""
    return df.groupBy(*keys).agg(F.avg(F.when(condition, 1.0).otherwise(0.0)).alias(result))


def team_record(df: DataFrame, keys: Sequence[str], won: Column, wins: str, losses: str, rate: str) -> DataFrame:
    """Wins, losses and win rate per key, from one row per team and match."""
    counted = df.groupBy(*keys).agg(
        F.count_if(won).alias(wins), F.count_if(~won).alias(losses))
    return counted.withColumn(rate, ratio(F.col(wins), F.col(wins) + F.col(losses)))


def sides_to_rows(df: DataFrame, sides: Sequence[Mapping[str, str]], keep: Sequence[str] = ()) -> DataFrame:
    """One row per side of a match.

    Each side maps a result name to the column that holds it. Reads the input once.
    """
    rows = F.array(*[F.struct(*[F.col(c).alias(n) for n, c in side.items()]) for side in sides])
    return df.select(*keep, F.inline(rows))
