"""Order-dependent work without a single-task window.

* ``keep_one`` and ``latest_n`` filter on ``row_number``; Spark then prunes every
  map partition to the wanted rows per key before the shuffle, so that a key with
  most of the rows ships only a few per partition.
* ``running_totals`` range-partitions the values, accumulates inside each range
  in parallel and adds the range offsets.
* ``hash_positions`` numbers rows in hash order the same way, with the leading
  hex digits of the hash as buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.seeded import key_hash
from ..storage import settle


def _directed(order: Sequence[str], descending: bool) -> list[Column]:
    return [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_last() for c in order]


def latest_n(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The last ``n`` rows of each key; ``order`` must end in a unique column."""
    window = W.partitionBy(*keys).orderBy(*_directed(order, descending=True))
    return df.withColumn("_position", F.row_number().over(window)).where(
        F.col("_position") <= n).drop("_position")


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: str = "first") -> DataFrame:
    """One row per key: the first or the last in a stated order."""
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    window = W.partitionBy(*keys).orderBy(*_directed(order, descending=keep == "last"))
    return df.withColumn("_position", F.row_number().over(window)).where(
        F.col("_position") == 1).drop("_position")


def running_totals(df: DataFrame, order: str, measures: Sequence[str]) -> DataFrame:
    """Add ``<measure>_before``: the sum over the rows with a smaller ``order`` value.

    ``df`` has one row per ``order`` value. It is range-partitioned and written
    once, so both the totals inside a range and the range offsets see the same
    ranges.
    """
    cut = settle(df.repartitionByRange(order).withColumn("_range", F.spark_partition_id()), "ranges")
    inside = W.partitionBy("_range").orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    local = cut.withColumns({f"{m}_before": F.coalesce(F.sum(m).over(inside), F.lit(0)) for m in measures})
    # One row per range.
    across = W.partitionBy(F.lit(0)).orderBy("_offset_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = cut.groupBy(F.col("_range").alias("_offset_range")).agg(
        *[F.sum(m).alias(f"_{m}") for m in measures]).select(
        "_offset_range", *[F.coalesce(F.sum(f"_{m}").over(across), F.lit(0)).alias(f"_{m}_offset") for m in measures])
    joined = local.join(offsets, F.col("_range") == F.col("_offset_range"))
    return joined.withColumns(
        {f"{m}_before": F.col(f"{m}_before") + F.col(f"_{m}_offset") for m in measures}
    ).select(*df.columns, *[f"{m}_before" for m in measures])


def average_rank(df: DataFrame, score: str, result: str, truncate: bool = True) -> DataFrame:
    """Rank by descending score; equal scores share the mean of their places.

    The ranks are computed on the distinct scores and joined back. A missing
    score has no rank.
    """
    scores = df.where(F.col(score).isNotNull()).groupBy((-F.col(score)).alias("_low")).agg(
        F.count(F.lit(1)).alias("_n"))
    ranks = running_totals(scores, "_low", ["_n"])
    place = F.col("_n_before") + (F.col("_n") + F.lit(1)) / F.lit(2.0)
    if truncate:
        place = F.floor(place).cast("bigint")
    ranks = ranks.select((-F.col("_low")).alias("_score"), place.alias(result))
    return df.join(ranks, F.col(score) == F.col("_score"), "left").drop("_score")


def category_codes(df: DataFrame, column: str, result: str) -> DataFrame:
    """Codes 0, 1, ... of the sorted distinct values; a missing value has code -1."""
    values = df.where(F.col(column).isNotNull()).select(
        F.col(column).alias("_value")).distinct().withColumn("_one", F.lit(1))
    codes = running_totals(values, "_value", ["_one"]).select(
        "_value", F.col("_one_before").cast("bigint").alias("_code"))
    joined = df.join(settle(codes, "codes"), F.col(column) == F.col("_value"), "left")
    return joined.withColumn(result, F.coalesce(F.col("_code"), F.lit(-1).cast("bigint"))).drop("_value", "_code")


def hash_positions(df: DataFrame, seed: int | str, row_key: Sequence[str], result: str,
                   keys: Sequence[str] = (), digits: int = 3) -> DataFrame:
    """Number the rows of each key from 1 in the order of a seeded hash of the row key.

    Each key is cut into ``16 ** digits`` hash buckets that are numbered in
    parallel, so a key with most of the rows is no single task.
    """
    marked = df.withColumn("_hash", key_hash(seed, *[F.col(k) for k in row_key]))
    marked = marked.withColumn("_bucket", F.substring("_hash", 1, digits))
    inside = W.partitionBy(*keys, "_bucket").orderBy("_hash", *row_key)
    local = marked.withColumn("_local", F.row_number().over(inside))
    sizes = marked.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # At most ``16 ** digits`` rows per key.
    across = W.partitionBy(*(keys or [F.lit(0)])).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = settle(sizes.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys], F.col("_bucket").alias("_offset_bucket"),
        F.coalesce(F.sum("_n").over(across), F.lit(0)).alias("_offset")), "offsets")
    same = F.col("_bucket") == F.col("_offset_bucket")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    return local.join(offsets, same).select(
        *df.columns, (F.col("_local") + F.col("_offset")).cast("bigint").alias(result))


def sort_rows(df: DataFrame, order: Sequence[str], descending: Sequence[str] = (),
              nulls_last: bool = True) -> DataFrame:
    """A total sort; end ``order`` in a unique column."""
    terms = []
    for name in order:
        column = F.col(name)
        if name in descending:
            terms.append(column.desc_nulls_last() if nulls_last else column.desc_nulls_first())
        else:
            terms.append(column.asc_nulls_last() if nulls_last else column.asc_nulls_first())
    return df.orderBy(*terms)


def top_k(df: DataFrame, order: Sequence[str], k: int, descending: Sequence[str] = ()) -> DataFrame:
    """The first ``k`` rows of a report."""
    return sort_rows(df, order, descending).limit(k)
