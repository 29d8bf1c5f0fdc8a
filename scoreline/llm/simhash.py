"""Near-duplicates by SimHash with multi-index hashing.

Fingerprints are linked over distinct values only. A fingerprint is cut into
segments; if two differ in at most ``distance`` bits, some segment of theirs differs
in at most ``distance // segments``. So every fingerprint looks up, in the table
of each segment, the small Hamming ball around its own segment, and what it meets is
verified over all bits. A probe goes only to segment values that are not larger
than its own, as the other side finds the rest.

A large group of near copies would make links of all its pairs. So fingerprints that
differ in at most two bits are joined first, through the values one bit away from
both: 65 rows per fingerprint and at most 65 fingerprints per value, however large
the group. The tables then return links between different groups only.
"""

from __future__ import annotations

from array import array
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, settle
from .components import connect

WORDS = 4
DISTANCE = 4
SEGMENTS = 3
_SEED = 42
#: Shingles whose bits are counted at once.
_AT_ONCE = 1 << 16


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """64 bits: each is set if more than half of the shingles' hashes have it."""
    split = (text or "").encode().lower().split()
    if not split:
        return 0
    joined = b" ".join(split)
    if len(split) < words:
        return xxhash.xxh64_intdigest(joined, _SEED)
    ends = np.cumsum(np.fromiter(map(len, split), np.int64, len(split)) + 1)
    starts = np.concatenate([[0], ends[:len(split) - words]]).tolist()
    hashes, digest = array("Q"), xxhash.xxh64_intdigest
    hashes.extend([digest(joined[a:b], _SEED) for a, b in zip(starts, (ends[words - 1:] - 1).tolist(), strict=True)])
    h = np.frombuffer(hashes, dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), _AT_ONCE):
        part = h[at:at + _AT_ONCE]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += np.add.reduce(bits, axis=0, dtype=np.uint32)
    return int(np.packbits(counts * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """id and fingerprint (as a signed 64-bit number) of every row."""

    def work(batch: pa.RecordBatch) -> dict:
        made = np.array([fingerprint(t, words) for t in batch.column(text).to_pylist()], dtype=np.uint64).view(np.int64)
        return {"id": batch.column(key), "fp": pa.array(made)}

    return arrow_map(docs.select(key, text), work, f"id {dict(docs.dtypes)[key]}, fp bigint", text)


def segment_bounds(segments: int) -> list[tuple[int, int]]:
    """(first bit, bits) of each segment."""
    cuts = [round(64 * i / segments) for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def ball(bits: int, radius: int) -> list[int]:
    """The masks that change at most ``radius`` of ``bits`` bits."""
    return [sum(1 << b for b in chosen) for r in range(radius + 1) for chosen in combinations(range(bits), r)]


def closest(distinct: DataFrame) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints (column ``fp``) which differ in at most two bits."""
    masks = F.array(F.lit(0).cast("bigint"), *[F.lit(1 << b if b < 63 else -(1 << 63)) for b in range(64)])
    around = distinct.select("fp", F.explode(F.transform(masks, lambda m: F.col("fp").bitwiseXOR(m))).alias("value"))
    met = around.groupBy("value").agg(F.min("fp").alias("a"), F.collect_list("fp").alias("all")).where(F.size("all") > 1)
    return met.select("a", F.explode("all").alias("b")).where("a != b").distinct()


def links(distinct: DataFrame, distance: int = DISTANCE, segments: int = SEGMENTS) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints (column ``fp``) within ``distance`` bits, of different groups.

    Column ``group``, if there is one, tells which are joined already. A pair that several
    segments find is given by the first of them alone.
    """
    if "group" not in distinct.columns:
        distinct = distinct.withColumn("group", F.col("fp"))
    radius, bounds = distance // segments, segment_bounds(segments)

    def part(column: str, segment: tuple[int, int]):
        shifted = F.shiftrightunsigned(F.col(column), segment[0])
        return shifted if segment[1] == 64 else shifted.bitwiseAND(F.lit((1 << segment[1]) - 1))

    def reached(segment: tuple[int, int]):
        masks, own = F.array(*[F.lit(m).cast("bigint") for m in ball(segment[1], radius)]), part("fp", segment)
        return F.filter(F.transform(masks, lambda m: own.bitwiseXOR(m)), lambda v: v <= own)

    table = distinct.select(F.col("fp").alias("b"), F.col("group").alias("b_group"), F.explode(F.array(*[
        F.struct(F.lit(i).alias("segment"), part("fp", s).alias("value")) for i, s in enumerate(bounds)])).alias("entry")).select("b", "b_group", "entry.*")
    probes = None
    for i, s in enumerate(bounds):
        some = distinct.select(F.col("fp").alias("a"), F.col("group").alias("a_group"), F.lit(i).alias("segment"), F.explode(reached(s)).alias("value"))
        probes = some if probes is None else probes.unionByName(some)

    def near(i: int):
        return F.bit_count(part("a", bounds[i]).bitwiseXOR(part("b", bounds[i]))) <= radius

    found = (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance) & (F.col("a_group") != F.col("b_group"))
    own_value = F.lit(False)
    for i, s in enumerate(bounds):
        earlier = F.lit(True)
        for j in range(i):
            earlier = earlier & ~near(j)
        # Both sides find a pair whose segments are equal; the smaller fingerprint keeps it.
        own_value = own_value | ((F.col("segment") == i) & earlier & ((part("a", s) != part("b", s)) | (F.col("a") < F.col("b"))))
    return probes.join(table, ["segment", "value"]).where(found & own_value).select("a", "b")


def _rooted(groups: DataFrame, between: DataFrame) -> DataFrame:
    """``groups`` with the root of each fingerprint's component."""
    return groups.join(connect(between), F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE, segments: int = SEGMENTS,
                    key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, fingerprint (16 hex digits), component_id.

    ``component_id`` is the smallest key that links lead to. NULL and empty texts have
    the fingerprint zero and are linked like any other; texts of any length are read
    whole. Repeated rows share a component; a NULL key never names one unless all its
    members are NULL. An empty input gives no rows. Extra columns are not read.
    """
    rows = settle(fingerprints(docs, words, key, text), "fingerprints")
    groups = settle(rows.groupBy("fp").agg(F.min("id").alias("least")), "fingerprint-groups")
    if distance >= 2:
        groups = settle(_rooted(groups, closest(groups.select("fp"))), "fingerprint-groups")
    else:
        groups = groups.withColumn("root", F.col("fp"))
    between = links(groups.select("fp", F.col("root").alias("group")), distance, segments)
    members = groups.where("fp != root").select(F.col("fp").alias("a"), F.col("root").alias("b"))
    named = _rooted(groups.drop("root"), between.unionByName(members))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = settle(named.join(least, "root").select("fp", "component_id"), "components")
    return rows.join(named.hint("merge"), "fp").select(F.col("id").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_simhash(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs)
