"""Keeping a stored table current, and uniting tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import delete_arriving
from .order import keep_one


def upsert_latest(stored: DataFrame | None, arriving: DataFrame, keys: Sequence[str],
                  order: Sequence[str]) -> DataFrame:
    """Stored and arriving rows, one per key: the arriving one wins.

    ``order`` decides between rows of the same batch. No stored table counts as
    an empty one.
    """
    batches = arriving.withColumn("_batch", F.lit(1))
    if stored is not None:
        batches = stored.withColumn("_batch", F.lit(0)).unionByName(batches)
    return keep_one(batches, keys, ["_batch", *order], keep="last").drop("_batch")


def upsert_delete_append(stored: DataFrame | None, arriving: DataFrame, key: str) -> DataFrame:
    """Delete the stored rows that arrive again, append the arriving ones.

    Needs unique keys on both sides; a small arrival costs no shuffle of the
    stored table.
    """
    if stored is None:
        return arriving
    return delete_arriving(stored, arriving, key).unionByName(arriving)


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows of frames with the same columns, matched by name."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def union_filling(*frames: DataFrame) -> DataFrame:
    """All rows of frames with differing columns; absent ones are NULL."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result
