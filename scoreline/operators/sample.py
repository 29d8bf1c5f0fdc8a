"""Seeded samples and augmentation.

A sample of exactly n rows is the n smallest seeded hashes of a unique row key.
The n-th hash is found by counting hash prefixes, after which drawing the sample
is a plain filter: no sort, no shuffle and no gathering of the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.seeded import hash_gaussian, key_hash
from .columns import other_side

_PREFIX_STEP = 3
_SMALL_BUCKET = 10_000


def _nth_hash(hashes: DataFrame, size: Callable[[int], int]) -> str | None:
    """The largest hash of the sample; ``size`` gives the number of rows from that of the table."""
    prefix, wanted = "", None
    while len(prefix) < 4 * _PREFIX_STEP:
        # At most 16 ** _PREFIX_STEP groups.
        counts = hashes.where(F.col("h").startswith(prefix)).groupBy(
            F.substring("h", 1, len(prefix) + _PREFIX_STEP).alias("p")).agg(F.count(F.lit(1)).alias("n"))
        groups = sorted(counts.collect())
        if wanted is None:
            wanted = size(sum(g["n"] for g in groups))
            if wanted == 0:
                return None
        for group in groups:
            if wanted <= group["n"]:
                break
            wanted -= group["n"]
        else:
            raise ValueError("the sample is larger than the table")
        prefix = group["p"]
        if group["n"] <= _SMALL_BUCKET:
            break
    # At most _SMALL_BUCKET rows, or equal hashes only.
    for value, n in sorted(hashes.where(F.col("h").startswith(prefix)).groupBy("h").agg(F.count(F.lit(1)).alias("n")).collect()):
        if n > 1:
            raise ValueError("the row key of a sample is not unique")
        wanted -= n
        if not wanted:
            return value


def _chosen(df: DataFrame, size: Callable[[int], int], seed: int | str, row_key: Sequence[str]) -> Column:
    digest = key_hash(seed, *[F.col(k) for k in row_key])
    last = _nth_hash(df.select(digest.alias("h")), size)
    return F.lit(False) if last is None else digest <= F.lit(last)


def sample_n(df: DataFrame, n: int, seed: int | str, row_key: Sequence[str]) -> DataFrame:
    """Exactly ``n`` rows without replacement; ``row_key`` is unique per row."""
    return df.where(_chosen(df, lambda rows: n, seed, row_key))


def sample_share(df: DataFrame, share: float, seed: int | str, row_key: Sequence[str]) -> DataFrame:
    """``int(rows * share)`` rows without replacement."""
    return df.where(_chosen(df, lambda rows: int(rows * share), seed, row_key))


def _add_copies(df: DataFrame, share: float, seed: int | str, row_key: Sequence[str], flag: str) -> DataFrame:
    """Every row with flag 0, and the sampled ones once more with flag 1, in one pass."""
    chosen = _chosen(df, lambda rows: int(rows * share), seed, row_key)
    copies = F.when(chosen, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.withColumn(flag, F.explode(copies))


def add_swapped(df: DataFrame, share: float, seed: int | str, row_key: Sequence[str],
                flag: str = "swapped") -> DataFrame:
    """Append a sample of matches with the two teams exchanged."""
    both = _add_copies(df, share, seed, row_key, flag)
    return both.select(*[
        F.col(n) if other_side(n) == n else F.when(F.col(flag) == 1, F.col(other_side(n))).otherwise(F.col(n)).alias(n)
        for n in both.columns])


def with_noise(df: DataFrame, columns: Sequence[str], scale: float, seed: int | str, row_key: Sequence[str],
               where: Column | None = None) -> DataFrame:
    """Add N(0, scale) to the columns; the noise depends on row key and column name.

    With ``where`` only the rows that satisfy it are changed.
    """
    key = [F.col(k) for k in row_key]

    def noisy(name: str) -> Column:
        value = F.col(name) + hash_gaussian(seed, *key, F.lit(name), scale=scale)
        return value if where is None else F.when(where, value).otherwise(F.col(name))

    return df.withColumns({c: noisy(c) for c in columns})


def add_noisy(df: DataFrame, columns: Sequence[str], share: float, scale: float, seed: int | str,
              row_key: Sequence[str], flag: str = "noisy") -> DataFrame:
    """Append a sample of rows with noise on the listed columns."""
    both = _add_copies(df, share, seed, row_key, flag)
    return with_noise(both, columns, scale, seed, row_key, F.col(flag) == 1)


def pairwise_difference(df: DataFrame, metrics: Sequence[str] | Mapping[str, str], keep: Sequence[str],
                        sides: tuple[str, str] = ("team1", "team2")) -> DataFrame:
    """``<metric>_diff`` = first side minus second side; the sources are dropped."""
    names = metrics if isinstance(metrics, Mapping) else {m: f"{m}_diff" for m in metrics}
    one, two = sides
    return df.select(*keep, *[(F.col(f"{m}_{one}").cast("double") - F.col(f"{m}_{two}").cast("double")).alias(r)
                              for m, r in names.items()])
