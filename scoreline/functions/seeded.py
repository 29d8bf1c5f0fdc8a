"""Pseudo-random values that depend on a seed and a row key only.

The value of a row is the same under any partitioning, after a retry and on any
number of executors. The md5 forms can be reproduced by other SQL engines; the
xxhash form is cheaper and serves simulations that draw many values per row.
"""

from __future__ import annotations

from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_hash(seed: int | str, *keys: Column) -> Column:
    """32 hex digits from the seed and the key columns."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys]))


def _hex_number(text: Column, start: int, digits: int) -> Column:
    return F.conv(F.substring(text, start, digits), 16, 10).cast("bigint")


def hash_bucket(seed: int | str, *keys: Column, buckets: int = 100) -> Column:
    """A bucket from 0 to ``buckets - 1``."""
    return (_hex_number(key_hash(seed, *keys), 1, 8) % F.lit(buckets)).cast("int")


def _box_muller(u1: Column, u2: Column) -> Column:
    return F.sqrt(F.lit(-2.0) * F.ln(u1)) * F.cos(F.lit(2.0 * pi) * u2)


def hash_gaussian(seed: int | str, *keys: Column, scale: float = 1.0) -> Column:
    """A N(0, scale) value from two 48-bit uniforms of one md5 hash."""
    digest = key_hash(seed, *keys)
    width = F.lit(float(16 ** 12))
    u1 = (_hex_number(digest, 1, 12) + F.lit(0.5)) / width
    u2 = (_hex_number(digest, 13, 12) + F.lit(0.5)) / width
    return F.lit(float(scale)) * _box_muller(u1, u2)


def fast_uniform(seed: int, *keys: Column) -> Column:
    """A value in (0, 1) from the upper 52 bits of an xxhash64."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys), 12)
    return (bits + F.lit(0.5)) / F.lit(float(2 ** 52))


def fast_gaussian(seed: int, *keys: Column, scale: float = 1.0) -> Column:
    """A N(0, scale) value from two xxhash64 uniforms."""
    u1 = fast_uniform(seed, F.lit("radius"), *keys)
    u2 = fast_uniform(seed, F.lit("angle"), *keys)
    return F.lit(float(scale)) * _box_muller(u1, u2)
