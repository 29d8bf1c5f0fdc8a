"""Measures of a table that has a label and a prediction."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import ratio
from ..operators.order import running_totals
from ..storage import settle


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: the share of rows predicted right."""
    hit = F.when(F.col(label) == F.col(prediction), 1.0).otherwise(0.0)
    return df.agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("rows"))


def _zero_for_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def class_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, f1 and support per class, and their macro and weighted means.

    A measure without rows counts as 0.
    """
    cells = df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))
    hits = F.when(F.col(label) == F.col(prediction), F.col("n")).otherwise(0)
    roles = cells.select(F.inline(F.array(
        F.struct(F.col(label).cast("string").alias("class"), F.col("n").alias("support"),
                 F.lit(0).cast("bigint").alias("predicted"), hits.cast("bigint").alias("hits")),
        F.struct(F.col(prediction).cast("string").alias("class"), F.lit(0).cast("bigint").alias("support"),
                 F.col("n").alias("predicted"), F.lit(0).cast("bigint").alias("hits")))))
    sums = roles.groupBy("class").agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"),
                                      F.sum("hits").alias("hits"))
    precision = _zero_for_null(ratio(F.col("hits"), F.col("predicted")))
    recall = _zero_for_null(ratio(F.col("hits"), F.col("support")))
    classes = settle(sums.select("class", precision.alias("precision"), recall.alias("recall"), "support").withColumn(
        "f1", _zero_for_null(ratio(F.lit(2.0) * F.col("precision") * F.col("recall"),
                                   F.col("precision") + F.col("recall")))), "classes")
    measures = ["precision", "recall", "f1"]
    macro = classes.agg(F.lit("macro avg").alias("class"), *[F.avg(m).alias(m) for m in measures],
                        F.sum("support").alias("support"))
    weighted = classes.agg(
        F.lit("weighted avg").alias("class"),
        *[ratio(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(m) for m in measures],
        F.sum("support").alias("support"))
    return classes.select("class", *measures, "support").unionByName(macro).unionByName(weighted)


def mean_squared_errors(df: DataFrame, targets: Mapping[str, str]) -> DataFrame:
    """One row per target ``{column: predicted column}``."""
    row = df.agg(*[F.avg((F.col(y) - F.col(p)) * (F.col(y) - F.col(p))).alias(y) for y, p in targets.items()])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(y).alias("target"), F.col(y).alias("mse")) for y in targets])))


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row: the exact area under the ROC curve of a 0/1 label; equal scores count half.

    Positive and negative rows are counted per distinct score; the negatives
    below each score come from range totals, not from one sorted task.
    """
    scores = df.where(F.col(score).isNotNull()).groupBy(score).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg"))
    ranked = running_totals(scores, score, ["_neg"])
    wins = F.sum(F.col("_pos").cast("double") * (F.col("_neg_before") + F.col("_neg") / F.lit(2.0)))
    return ranked.agg(F.try_divide(wins, F.sum("_pos").cast("double") * F.sum("_neg").cast("double")).alias("roc_auc"))
