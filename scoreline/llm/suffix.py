"""Repeated byte strings by a logarithmic family of suffix arrays.

The suffix arrays are sparse: of the strings of ``length`` bytes that begin side by side
only the suffixes at anchors are kept, an anchor being the place of the least hash among
the short grams of such a string. Equal strings have equal anchors, so that every
repetition shows up between suffixes that begin with the same gram and the few bytes
before them. An entry is the suffix after its anchor, the bytes before, and where the run
of strings with that anchor begins; entries are partitioned by gram and sorted by suffix.

The grams that repeat are counted out exactly, and bits whose number follows theirs tell
which entries can match anything; only those are stored and moved. Batches of documents come in order. A batch is sorted,
merge-scanned together with the levels of the index, and every string of it that an earlier
entry contains is removed. Then the batch becomes a level, after levels
of equal size were merged, so that an index of n batches has about log2 n levels.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from . import sketch, spans
from .common import arrow_map, discard, settle, shuffles_dropped, text_bytes, workspace
from .rolling import Rolling, mix

LENGTH = 100
#: Bytes of a gram: short enough that strings share anchors, long enough to be seldom repeated by chance.
GRAM = 40
#: Batches that the registered query cuts the documents into.
BATCHES = 3
_STEP = 1 << 20
#: Entries that a task scans at once, if no gram has more; the tables of powers are some hundred times their bytes.
_ENTRIES = 5_000


class Anchors:
    """Runs of strings with one anchor, over a batch of texts."""

    def __init__(self, column: pa.Array, length: int, gram: int) -> None:
        self.data, self.offsets = text_bytes(column)
        self.length = length
        n = len(self.data) - length + 1
        self.first = self.last = self.anchor = self.text = np.zeros(0, np.int64)
        self.grams = np.zeros(0, np.uint64)
        if n <= 0:
            return
        grams = Rolling(self.data).windows(gram)
        place_bits = max(int(len(grams)).bit_length(), 1)
        place = np.arange(len(grams), dtype=np.uint64)
        order = (grams >> np.uint64(place_bits) << np.uint64(place_bits)) | place
        # The least of ``span`` neighbours by doubling.
        span, have = length - gram + 1, 1
        while have * 2 <= span:
            order = np.minimum(order[:-have], order[have:])
            have *= 2
        if span > have:
            order = np.minimum(order[:len(order) - (span - have)], order[span - have:])
        anchor = (order[:n] & np.uint64((1 << place_bits) - 1)).astype(np.int64)
        sizes = np.diff(self.offsets)
        text = np.repeat(np.arange(len(sizes)), sizes)[:n]
        valid = np.arange(n) + length <= self.offsets[text + 1]
        start = valid.copy()
        start[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
        end = valid.copy()
        end[:-1] &= ~valid[1:] | start[1:]
        self.first, self.last = np.flatnonzero(start), np.flatnonzero(end)
        self.anchor, self.text = anchor[self.first], text[self.first]
        self.grams = grams[self.anchor]


def _pieces(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """Stretches of a byte array as binary values."""
    size = end - begin
    offsets = np.concatenate([[0], np.cumsum(size)])
    taken = data[np.arange(offsets[-1]) + np.repeat(begin - offsets[:-1], size)]
    return pa.BinaryArray.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(taken.tobytes())])


def _entries(batch: pa.RecordBatch, length: int, gram: int, bits: sketch.Repeats) -> dict | None:
    found = Anchors(batch.column("text"), length, gram)
    some = np.flatnonzero(bits.test(mix(sketch.prefixes(found.grams))))
    if not len(some):
        return None
    first, anchor, end, text = found.first[some], found.anchor[some], found.last[some] + length, found.text[some]
    grams, rows, ids = found.grams[some].view(np.int64), batch.column("row").to_numpy(), batch.column("id")
    # Of equal entries the earliest is sent on; the strings of the others are known to be later ones.
    whole, check = (Rolling(found.data, seed).between(first, end) for seed in (0, 1))
    place = first - found.offsets[text]
    turn = np.empty(len(rows), np.int64)
    turn[np.lexsort((rows, ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False)))] = np.arange(len(rows))
    order = np.lexsort((place, turn[text], check, whole, anchor - first, grams))
    same = np.zeros(len(some), bool)
    same[1:] = np.logical_and.reduce([v[order][1:] == v[order][:-1] for v in (grams, anchor - first, whole, check)])
    lead, copy = order[~same], order[same]
    strings = end - first - length + 1
    # Runs of later strings that follow each other are one.
    copy = copy[np.lexsort((place[copy], text[copy]))]
    after = place[copy] + strings[copy]
    fresh = np.ones(len(copy), bool)
    fresh[1:] = (text[copy][1:] != text[copy][:-1]) | (place[copy][1:] != after[:-1])
    owner, begin = text[copy][fresh], place[copy][fresh]
    count = np.add.reduceat(strings[copy], np.flatnonzero(fresh)) if len(copy) else begin
    spread = np.random.default_rng(int(rows[0])).integers(-(1 << 62), 1 << 62, len(owner))
    every, nothing = np.concatenate([text[lead], owner]), np.zeros(len(owner), np.int64)
    return {"gram": pa.array(np.concatenate([grams[lead], spread])),
            "suffix": _pieces(found.data, np.concatenate([anchor[lead], nothing]), np.concatenate([end[lead], nothing])),
            "before": _pieces(found.data, np.concatenate([first[lead], nothing]), np.concatenate([anchor[lead], nothing])),
            "id": ids.take(pa.array(every)), "row": pa.array(rows[every]), "place": pa.array(np.concatenate([place[lead], begin]).astype(np.int32)),
            "n": pa.array(np.concatenate([np.zeros(len(lead), np.int64), count]).astype(np.int32))}


def _scan(table: pa.Table, length: int) -> pa.RecordBatch:
    """Removed runs of the batch's rows, among entries sorted by gram, suffix; whole grams at a time."""
    table = table.combine_chunks()
    known = table["n"].to_numpy() > 0
    sure = [table[c].to_numpy()[known] for c in ("row", "place", "n")]
    if known.any():
        table = table.filter(pa.array(~known)).combine_chunks()
    if not table.num_rows:
        return pa.RecordBatch.from_arrays([pa.array(v) for v in sure], ["row", "place", "n"])
    gram, row, place, indexed = (table[c].to_numpy() for c in ("gram", "row", "place", "indexed"))
    ids = table["id"].combine_chunks() if isinstance(table["id"], pa.ChunkedArray) else table["id"]
    n = len(gram)
    rank = np.empty(n, np.int64)
    rank[np.lexsort((place, row, ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False), ~indexed))] = np.arange(n)
    before, _ = text_bytes(_as_text(table["before"]))
    suffix, suffix_at = text_bytes(_as_text(table["suffix"]))
    _, before_at = text_bytes(_as_text(table["before"]))
    left, right = np.diff(before_at), np.diff(suffix_at)
    # Every entry's bytes on end: what is before its anchor, then the suffix.
    size = left + right
    offset = np.concatenate([[0], np.cumsum(size)])
    data = np.empty(offset[-1], np.uint8)
    data[np.arange(len(before)) + np.repeat(offset[:-1] - before_at[:-1], left)] = before
    data[np.arange(len(suffix)) + np.repeat(offset[:-1] + left - suffix_at[:-1], right)] = suffix
    # Equal entries first: all but the earliest lose all their strings.
    whole, check = _hashes(data, offset[:-1], offset[1:])
    order = np.lexsort((rank, check, whole, left, gram))
    same = np.zeros(n, bool)
    same[1:] = (gram[order][1:] == gram[order][:-1]) & (left[order][1:] == left[order][:-1]) & (whole[order][1:] == whole[order][:-1]) & (check[order][1:] == check[order][:-1])
    copy = np.zeros(n, bool)
    copy[order] = same
    strings = size - length + 1
    # Then the strings of the others, where a gram has several.
    own = np.flatnonzero(~copy)
    begins = np.concatenate([[True], gram[own][1:] != gram[own][:-1]]) if len(own) else np.zeros(0, bool)
    group = np.cumsum(begins)
    own = own[np.bincount(group, minlength=1)[group] > 1] if len(own) else own
    entry = np.repeat(own, strings[own])
    inside = np.arange(len(entry)) - np.repeat(np.cumsum(strings[own]) - strings[own], strings[own])
    at = offset[:-1][entry] + inside
    h, c = _hashes(data, at, at + length)
    order = np.lexsort((inside, rank[entry], c, h))
    again = np.zeros(len(entry), bool)
    again[1:] = (h[order][1:] == h[order][:-1]) & (c[order][1:] == c[order][:-1])
    order = order[again]
    order = order[~indexed[entry[order]]]
    owner, begin, count = spans.runs(entry[order], inside[order])
    lost = np.flatnonzero(copy & ~indexed)
    owner, begin, count = np.concatenate([owner, lost]), np.concatenate([begin, np.zeros(len(lost), np.int64)]), np.concatenate([count, strings[lost]])
    made = row[owner], (place[owner] + begin).astype(np.int32), count.astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([a, b])) for a, b in zip(made, sure, strict=True)], ["row", "place", "n"])


def _hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of stretches that begin in ascending order, a step of the bytes at a time."""
    made = np.empty((2, len(begin)), np.uint64)
    for low in range(0, len(data), _STEP):
        a, b = np.searchsorted(begin, [low, low + _STEP])
        if b > a:
            part = data[low:end[a:b].max()]
            for seed in (0, 1):
                made[seed, a:b] = Rolling(part, seed).between(begin[a:b] - low, end[a:b] - low)
    return made[0], made[1]


def _as_text(column) -> pa.Array:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return pa.LargeStringArray.from_buffers(len(column), *(column.cast(pa.large_binary()).buffers()[i] for i in (1, 2)))


class SuffixIndex:
    """Levels of sorted entries; each has a power of two of batches, and no two are of one size for long."""

    def __init__(self, spark: SparkSession, length: int = LENGTH) -> None:
        self.spark, self.length = spark, length
        self.levels: list[tuple[int, str]] = []

    def _write(self, entries: DataFrame) -> str:
        path = workspace(self.spark, "suffix-level")
        with shuffles_dropped(self.spark):
            entries.select("gram", "suffix", "before", "id", "row", "place", "n").repartition("gram").sortWithinPartitions("gram", "suffix").write.parquet(path)
        return path

    def _merge_equal(self) -> None:
        """Merge the two last levels while they are of one size."""
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (batches, one), (_, two) = self.levels[-2:]
            merged = self._write(self.spark.read.parquet(one).unionByName(self.spark.read.parquet(two)).where("n = 0"))
            self.levels[-2:] = [(2 * batches, merged)]
            for path in (one, two):
                discard(self.spark, path)

    def add(self, entries: DataFrame) -> DataFrame:
        """Removed runs (row, place, n) of a batch whose documents come after all that the index has; written."""
        self._merge_equal()
        level = self._write(entries)
        batch = self.spark.read.parquet(level)
        both = batch.withColumn("indexed", F.lit(False))
        for _, path in self.levels:
            both = both.unionByName(self.spark.read.schema(batch.schema).parquet(path).where("n = 0").withColumn("indexed", F.lit(True)))
        ship_package(self.spark)
        length = self.length
        sorted_rows = both.repartition("gram").sortWithinPartitions("gram", "suffix")
        with shuffles_dropped(self.spark):
            removed = settle(sorted_rows.mapInArrow(spans.by_group(lambda table: _scan(table, length), "gram", _ENTRIES), "row bigint, place int, n int"), "removed")
        self.levels.append((1, level))
        return removed

    def close(self) -> None:
        for _, path in self.levels:
            discard(self.spark, path)
        self.levels = []


def gram_sketch(rows: DataFrame, length: int = LENGTH, gram: int = GRAM, bits: int | None = None) -> Broadcast:
    """Bits that tell which grams of anchors may repeat, as many as the repeated ones need if ``bits`` does not say."""
    spark = rows.sparkSession
    with shuffles_dropped(spark):
        found = settle(sketch.repeated(rows.select("text"), "text", lambda batch: Anchors(batch.column("text"), length, gram).grams, _STEP), "grams")
    return sketch.members(found, "hash", sketch.bits_for(found.count()) if bits is None else bits)


def entries(rows: DataFrame, shared: Broadcast, kind: str, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    return arrow_map(rows, lambda batch: _entries(batch, length, gram, shared.value),
                     f"gram bigint, suffix binary, before binary, id {kind}, row bigint, place int, n int", limit=_STEP)


def _known(batch: pa.RecordBatch, hit: np.ndarray) -> dict:
    """The number of bytes, and the digest of texts that lose nothing."""
    data = [(t or "").encode() for t in batch.column("text").to_pylist()]
    return {"n_bytes": pa.array([len(d) for d in data], pa.int64()),
            "kept_sha256": pa.array([None if h else hashlib.sha256(d).hexdigest() for h, d in zip(hit.tolist(), data, strict=True)], pa.string())}


def _cut(batch: pa.RecordBatch, length: int) -> pa.RecordBatch:
    removed, parts, digests = [], [], []
    for text, digest, gone in zip(batch.column("text").to_pylist(), batch.column("kept_sha256").to_pylist(), batch.column("removed").to_pylist(), strict=True):
        if text is None or not gone:
            removed.append(0)
            parts.append(0)
            digests.append(digest or hashlib.sha256((text or "").encode()).hexdigest())
            continue
        data = np.frombuffer(text.encode(), np.uint8)
        drop = spans.covered(np.array([g["place"] for g in gone]), np.array([g["n"] for g in gone]), length, len(data))
        removed.append(int(drop.sum()))
        parts.append(int(drop[0]) + int((drop[1:] & ~drop[:-1]).sum()))
        digests.append(hashlib.sha256(data[~drop].tobytes()).hexdigest())
    return pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n_bytes"), pa.array(removed, pa.int64()), pa.array(parts, pa.int64()), pa.array(digests, pa.string())],
                                      ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeated_strings(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, batches: int = BATCHES, key: str = "doc_id", text: str = "text",
                            bits: int | None = None) -> DataFrame:
    """One row per row of ``docs``: key, n_bytes, n_removed, n_spans, kept_sha256.

    The first of equal strings is the one with the smallest key (NULL first), of rows with
    one key the one read first, and within a text the earliest. NULL and empty texts have
    no bytes; texts of any length are read whole. An empty input gives no rows. Extra
    columns are not read. ``docs`` is read several times and must be a stored table,
    whose rows come in the same order each time. Keys must be whole numbers; batches are
    ranges of them with about equally many rows.
    """
    kind, spark = dict(docs.dtypes)[key], docs.sparkSession
    rows = spans.numbered(docs, key, text)
    shared = gram_sketch(rows, length, gram, bits)
    cuts = docs.select(F.percentile_approx(key, [i / batches for i in range(1, batches)], 10_000).alias("cuts")).first()["cuts"] if batches > 1 else []
    cuts = sorted(set(cuts or []))
    index, removed = SuffixIndex(spark, length), None
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        inside = F.lit(True) if low is None else F.col("id") > low
        if high is not None:
            inside &= F.col("id") <= high
        if low is None:
            inside |= F.col("id").isNull()
        part = index.add(entries(rows.where(inside), shared, kind, length, gram))
        removed = part if removed is None else removed.unionByName(part)
    index.close()
    done = spans.finish(rows, removed, _known, "n_bytes bigint, kept_sha256 string", lambda batch: _cut(batch, length),
                        f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    return done.withColumnRenamed("id", key)


def op4_suffix(docs: DataFrame) -> DataFrame:
    return remove_repeated_strings(docs)
