"""The rows beneath the charts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def scatter_rows(averages: DataFrame, players: DataFrame, x: str, y: str, role: str) -> DataFrame:
    """Label, both coordinates and role of each player."""
    named = players.select(F.col("id").alias("player_id"), F.col("tag").alias("label"))
    return averages.join(named, "player_id").select(
        "player_id", "label", F.col(x).alias("x"), F.col(y).alias("y"), F.col(role).alias("role"))


def axis_limits(df: DataFrame, x: str, y: str, margin: float = 0.01) -> DataFrame:
    """One row: the bounds of both axes, widened by a margin."""
    return df.agg(*[edge for axis, column in (("x", x), ("y", y)) for edge in (
        (F.min(column) - F.lit(margin)).alias(f"{axis}_min"), (F.max(column) + F.lit(margin)).alias(f"{axis}_max"))])


def composition_bars(comparison: DataFrame, win_rate: str) -> DataFrame:
    """The mean win rate of each composition."""
    return comparison.groupBy("role_composition").agg(F.avg(win_rate).alias("win_rate"))
