"""Near-duplicate vectors by randomised-rotation binary codes.

A vector is rotated at random several times; the signs of the rotated coordinates
are its code, and the rotated vector's inner product with its own signs is the
stored correction factor: the inner product of one vector's signs with the other
rotated vector, divided by the factor, estimates the cosine without bias, and
its error has a known bound.

Parts of the code are hash tables: vectors that agree in one part meet in one bucket.
How many tables of how many bits follows from the number of vectors and the share
of links that may be missed. In a bucket, pairs whose estimate's upper bound reaches
the limit are recomputed exactly, in double precision; all others are passed over. A
pair that meets in several tables counts in the first.

Equal vectors are one class and are compared once. A bucket that is larger than a
block is dealt out as pairs of blocks, so no task holds more than two blocks of it,
and a task returns counts and spanning links, not pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import settle
from .components import connect

LIMIT = 0.95
#: Greatest chance that a pair exactly at the limit meets in no table.
MISSED = 1e-5
#: Deviations of the estimate within which its bounds hold (one pair in some 1e9 lies outside).
DEVIATIONS = 6.0
#: Rotations that an estimate averages over, at most.
ESTIMATED = 3
#: Distinct vectors of a bucket that are compared within one task.
BLOCK = 2048
SEED = 20240229


def plan_tables(n: int, limit: float = LIMIT, missed: float = MISSED) -> tuple[int, int]:
    """(tables, bits of each): buckets of some 16 unrelated vectors, tables enough for the chance to miss a pair."""
    bits = max(6, math.ceil(math.log2(max(n, 2))) - 4)
    agree = (1 - math.acos(limit) / math.pi) ** bits
    return math.ceil(math.log(missed) / math.log(1 - agree)), bits


def rotations(size: int, bits: int, seed: int = SEED) -> np.ndarray:
    """Random orthogonal matrices side by side, with at least ``bits`` columns."""
    random = np.random.default_rng(seed)
    made = [np.linalg.qr(random.standard_normal((size, size)))[0] for _ in range(math.ceil(bits / size))]
    return np.concatenate(made, axis=1)


def bucket_values(signs: np.ndarray, tables: int, bits: int) -> np.ndarray:
    """The bucket of each vector in each table."""
    weight = (1 << np.arange(bits, dtype=np.int64))
    return signs[:, :tables * bits].reshape(len(signs), tables, bits).astype(np.int64) @ weight


def _unit(batch: pa.RecordBatch, column: str, size: int) -> np.ndarray:
    x = np.asarray(batch.column(column).flatten().cast(pa.float64())).reshape(-1, size)
    # Scaling by the largest component first keeps tiny and huge vectors from under- and overflow.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def estimate(signs: np.ndarray, other: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosines of paired rows, and the estimates' deviations.

    ``signs`` are the rotated vectors whose signs and factors are stored, ``other`` the rotated
    partners; both have one block of ``size`` coordinates per rotation.
    """
    rounds = signs.shape[1] // size
    a, b = signs.reshape(-1, rounds, size), other.reshape(-1, rounds, size)
    factor = np.abs(a).sum(2) / math.sqrt(size)
    each = np.einsum("nrs,nrs->nr", np.where(a >= 0, 1.0, -1.0), b) / math.sqrt(size) / factor
    spread = np.sqrt(np.maximum(1 - factor**2, 0) / factor**2 / max(size - 1, 1))
    return each.mean(1), np.sqrt((spread**2).sum(1)) / rounds


def _pairs(key: np.ndarray, side: np.ndarray, left: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of rows with equal keys (sorted), both of one block or one of either."""
    at, step = np.arange(len(key)), 1
    while True:
        at = at[at + step < len(key)]
        at = at[key[at] == key[at + step]]
        if not len(at):
            return
        # side: 0 a bucket or block by itself, 1 the first and 2 the second of two blocks
        wanted = at[(side[at] != side[at + step]) | (side[at] == 0)]
        if len(wanted):
            yield wanted, wanted + step
        step += 1


def _smallest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that links lead to."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (before == label).all():
            return label


class _Compare:
    """Links within buckets, for rows that arrive sorted by bucket."""

    def __init__(self, size: int, tables: int, bits: int, limit: float) -> None:
        self.size, self.tables, self.bits, self.limit = size, tables, bits, limit
        self.matrix = rotations(size, tables * bits)

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if kept is None else pa.concat_tables([kept, pa.Table.from_batches([batch])])
            key = table["bucket"].to_numpy()
            last = int(np.searchsorted(key, key[-1])) if len(key) else 0
            if last:
                yield self.links(table.slice(0, last))
            kept = table.slice(last)
        if kept is not None and kept.num_rows:
            yield self.links(kept)

    def links(self, table: pa.Table) -> pa.RecordBatch:
        batch = table.combine_chunks().to_batches()[0]
        ids, weight = batch.column("id").to_numpy(), batch.column("copies").to_numpy()
        key, side, band = (batch.column(n).to_numpy() for n in ("bucket", "side", "band"))
        x = _unit(batch, "vector", self.size)
        rotated = x @ self.matrix
        values = bucket_values(rotated >= 0, self.tables, self.bits)
        used = self.size * min(ESTIMATED, self.matrix.shape[1] // self.size)
        count, a_all, b_all = np.zeros(len(ids), np.int64), [], []
        for a, b in _pairs(key, side, ids):
            for cut in range(0, len(a), 8192):
                i, j = a[cut:cut + 8192], b[cut:cut + 8192]
                guess, spread = estimate(rotated[i, :used], rotated[j, :used], self.size)
                maybe = guess + DEVIATIONS * spread >= self.limit
                i, j = i[maybe], j[maybe]
                # Only the first table in which the two meet counts them.
                first = np.argmax(values[i] == values[j], axis=1) == band[i]
                i, j = i[first], j[first]
                linked = np.einsum("ij,ij->i", x[i], x[j]) >= self.limit
                i, j = i[linked], j[linked]
                np.add.at(count, i, weight[j])
                np.add.at(count, j, weight[i])
                a_all.append(i)
                b_all.append(j)
        a, b = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (a_all, b_all))
        root = _smallest(len(ids), a, b)
        some = np.flatnonzero(count)
        return pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(count[some]), pa.array(ids[root[some]])], ["id", "links", "root"])


def _buckets(classes: DataFrame, size: int, tables: int, bits: int) -> DataFrame:
    """One row per class and table: id, copies, vector, band, bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = rotations(size, tables * bits)
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                values = bucket_values(_unit(batch, "vector", size) @ matrix >= 0, tables, bits)
                rows = pa.array(np.repeat(np.arange(batch.num_rows), tables))
                band = np.tile(np.arange(tables, dtype=np.int64), batch.num_rows)
                yield pa.RecordBatch.from_arrays([batch.column("id").take(rows), batch.column("copies").take(rows), batch.column("vector").take(rows),
                                                  pa.array(band.astype(np.int32)), pa.array(band << 40 | values.ravel())], ["id", "copies", "vector", "band", "bucket"])

    ship_package(classes.sparkSession)
    return classes.select("id", "copies", "vector").mapInArrow(run, "id bigint, copies bigint, vector array<double>, band int, bucket bigint")


def near_vectors(vectors: DataFrame, limit: float = LIMIT, missed: float = MISSED, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """One row per row of ``vectors``: key, n_links, component_id, kept.

    Vectors of different sizes have no cosine. NULL, empty and zero vectors and those
    with NULL or non-finite components link with nothing. Equal vectors link with
    each other. Repeated rows count as other vectors with the same key; NULL keys name
    a component only if it has no other. An empty input gives no rows. Extra columns
    are not read.
    """
    whole = F.col(column).cast("array<double>")
    usable = (F.coalesce(F.size(whole), F.lit(0)) > 0) & F.forall(whole, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(whole, lambda v: v != 0)
    # Minus zero is zero.
    rows = vectors.select(F.col(key).alias("key"), F.when(usable, F.transform(whole, lambda v: v + F.lit(0.0))).alias("vector"))
    rows = settle(rows.withColumn("size", F.size("vector")).withColumn("digest", F.sha2(F.concat_ws(",", F.transform("vector", lambda v: v.cast("string"))), 256)), "vectors")
    classes = rows.where("vector IS NOT NULL").groupBy("digest").agg(F.min("key").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector"))
    classes = settle(classes.withColumn("id", F.monotonically_increasing_id()).withColumn("size", F.size("vector")), "vector-classes")
    found = None
    # One round per vector size, of which a table usually has one.
    for r in classes.groupBy("size").agg(F.count(F.lit(1)).alias("n")).orderBy("size").toLocalIterator():
        some = _links(classes.where(F.col("size") == r["size"]), r["size"], r["n"], limit, missed)
        found = some if found is None else found.unionByName(some)
    if found is None:
        return rows.select(F.col("key").alias(key), F.lit(0).cast("bigint").alias("n_links"), F.col("key").alias("component_id"), F.lit(True).alias("kept"))
    found = settle(found, "vector-links")
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    roots = connect(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    named = classes.join(roots, F.col("id") == F.col("node"), "left").join(counts, "id", "left").select(
        "digest", "least", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "id").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").select("digest", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id")
    # Unusable vectors may be any share of the rows; without a key to join by they would meet in one task.
    alone = rows.where("vector IS NULL").select("key", F.lit(0).cast("bigint").alias("n_links"), F.col("key").alias("component_id"))
    joined = rows.where("vector IS NOT NULL").select("key", "digest").join(named, "digest").select("key", F.col("n_links").cast("bigint").alias("n_links"), "component_id")
    return joined.unionByName(alone).select(F.col("key").alias(key), "n_links", "component_id", F.col("component_id").eqNullSafe(F.col("key")).alias("kept"))


def _links(classes: DataFrame, size: int, n: int, limit: float, missed: float) -> DataFrame:
    """Links by class and bucket: id, links (of first meetings, with copies), root (a member linked with it)."""
    tables, bits = plan_tables(n, limit, missed)
    rows = _buckets(classes, size, tables, bits)
    large = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK).select(
        F.col("bucket").alias("large"), F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    dealt = rows.join(settle(large, "large-buckets"), F.col("bucket") == F.col("large"), "left")
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    # A row of a large bucket goes to the pair of its block with every block; numbered so that a pair is one key.
    pairs = F.when(F.col("blocks").isNull(), F.array(F.struct(F.lit(0).alias("pair"), F.lit(0).alias("side")))).otherwise(
        F.transform(F.sequence(F.lit(0), F.coalesce(F.col("blocks"), F.lit(1)) - 1), lambda other: F.struct(
            (F.least(own, other) * F.col("blocks") + F.greatest(own, other) + 1).cast("int").alias("pair"),
            F.when(own == other, 0).when(own < other, 1).otherwise(2).alias("side"))))
    dealt = dealt.withColumn("to", F.explode(pairs)).select("id", "copies", "vector", "band", F.xxhash64("bucket", "to.pair").alias("bucket"), F.col("to.side").alias("side"))
    sorted_rows = dealt.repartition("bucket").sortWithinPartitions("bucket")
    return sorted_rows.mapInArrow(_Compare(size, tables, bits, limit), "id bigint, links bigint, root bigint")


def op7_vectors(vectors: DataFrame) -> DataFrame:
    return near_vectors(vectors)
