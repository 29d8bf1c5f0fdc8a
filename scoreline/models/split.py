"""Splits, folds and weights. Each depends on a seed and the row key only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.seeded import hash_bucket
from ..operators.order import hash_positions
from ..storage import settle


def mark_test(df: DataFrame, percent: int, seed: int | str, row_key: Sequence[str], result: str = "is_test") -> DataFrame:
    """1 for about ``percent`` of the keys, else 0; rows of one key stay together. No shuffle."""
    bucket = hash_bucket(seed, *[F.col(k) for k in row_key])
    return df.withColumn(result, (bucket < F.lit(percent)).cast("int"))


def label_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows per label, written once: a table with one row per class."""
    return settle(df.groupBy(label).agg(F.count(F.lit(1)).alias("n")), "labels")


def mark_test_stratified(df: DataFrame, label: str, share: float, seed: int | str, row_key: Sequence[str],
                         result: str = "is_test") -> DataFrame:
    """1 for the same share of every label (to the nearest row), else 0."""
    counts = label_counts(df, label).select(F.col(label).alias("_label"), F.col("n").alias("_n"))
    placed = hash_positions(df, seed, row_key, "_position", keys=[label])
    joined = placed.join(counts, F.col(label).eqNullSafe(F.col("_label")))
    wanted = F.floor(F.col("_n") * F.lit(share) + F.lit(0.5))
    return joined.withColumn(result, (F.col("_position") <= wanted).cast("int")).drop("_label", "_n", "_position")


def add_folds(df: DataFrame, label: str, folds: int, seed: int | str, row_key: Sequence[str],
              result: str = "fold") -> DataFrame:
    """Fold 0 to ``folds - 1``; the folds of a label differ by one row at most."""
    placed = hash_positions(df, seed, row_key, "_position", keys=[label])
    return placed.withColumn(result, ((F.col("_position") - 1) % F.lit(folds)).cast("int")).drop("_position")


def add_class_weights(df: DataFrame, label: str, result: str = "weight") -> DataFrame:
    """The balanced weight of a row: rows / (classes * rows of its class)."""
    counts = label_counts(df, label)
    total = counts.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes")).first()
    weights = counts.select(F.col(label).alias("_label"),
                            (F.lit(float(total["rows"])) / (F.lit(total["classes"]) * F.col("n"))).alias(result))
    return df.join(weights, F.col(label).eqNullSafe(F.col("_label"))).drop("_label")
