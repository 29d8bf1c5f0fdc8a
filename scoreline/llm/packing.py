"""Shortest-pack-first packing over the histogram of lengths.

Every document is tokenised once, ended with the end id and cut into full pieces
and one remainder; the pieces keep a checksum, not their ids. Packing needs the
histogram of piece lengths only: lengths are placed longest first, each into the
packs that are shortest at that moment, as counts per packing pattern. Pieces of
one length are interchangeable, so that a piece's rank among its equals tells its
sequence and offset: ranks are numbered in parallel buckets and looked up in the
table of patterns.
"""

from __future__ import annotations

import heapq
import os
import re
import zlib
from array import array
from collections import defaultdict
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, give_back, settle

SEQUENCE = 4096
END_ID = 2
VOCABULARY = "word_bpe_49k.json"
#: Bytes of words, and as many of parts of words, whose ids a worker remembers. Half of it is the memory in use; when that is full it becomes
#: the one of before, from which what occurs again is taken over, so that frequent words are never forgotten.
REMEMBERED = 24 << 20
#: What an entry takes beside its letters and ids.
_ENTRY_BYTES = 200
#: Bytes of text tokenised at a time.
_STEP = 1 << 20
#: Parallel buckets in which the pieces of one length are numbered, for each partition of a shuffle.
BUCKETS_PER_PARTITION = 2


# How the vocabulary cuts a lower-case word, here for ASCII and the accented letters of Latin-1, whose
# normal form is themselves; other words, and special tokens within a text, take the tokenizer's whole way.
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
_PLAIN = re.compile("[!-~À-ÿ]*")
_SPECIAL = "<|"


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it prints, else the next one from 256."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in prints else next(others)) for b in range(256)]


class Words:
    """The ids of words as bytes of 16-bit numbers, each distinct part tokenised once while it is remembered."""

    def __init__(self, file: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.words_before: dict[str, bytes] = {}
        self.parts_before: dict[str, bytes] = {}
        self.room = {"words": REMEMBERED // 2, "parts": REMEMBERED // 2}

    def part(self, part: str) -> bytes:
        found = self.parts.get(part)
        if found is None:
            found = self.parts_before.get(part)
            if found is None:
                spelled = part if part.isascii() else "".join([self.letters[b] for b in part.encode()])
                found = array("H", [t.id for t in self.model.tokenize(spelled)]).tobytes()
            self.parts[part] = found
            self.room["parts"] -= _ENTRY_BYTES + 2 * len(part) + len(found)
        return found

    def word(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():
            return self.part(word.lower())
        if _SPECIAL in word or not _PLAIN.fullmatch(word):
            return array("H", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        return b"".join([self.part(p) for p in _PARTS.findall(word.lower())])

    def ids(self, words: list[str]) -> list[bytes]:
        if self.room["words"] < 0:
            self.words, self.words_before, self.room["words"] = {}, self.words, REMEMBERED // 2
        if self.room["parts"] < 0:
            self.parts, self.parts_before, self.room["parts"] = {}, self.parts, REMEMBERED // 2
        known, before, made, taken = self.words, self.words_before, [], 0
        for w in words:
            found = known.get(w)
            if found is None:
                found = before.get(w)
                if found is None:
                    found = self.word(w)
                known[w] = found
                taken += _ENTRY_BYTES + 2 * len(w) + len(found)
            made.append(found)
        self.room["words"] -= taken
        return made


@cache
def _words(file: str) -> Words:
    give_back()  # a worker's first step here may follow other work
    return Words(file)


def text_ids(texts: pa.Array, file: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts on end, and where each begins.

    The vocabulary never joins across blanks, so each distinct word is tokenised once.
    """
    words = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
    flat = words.flatten().dictionary_encode()
    distinct = _words(file).ids(flat.dictionary.to_numpy(zero_copy_only=False).tolist())
    if not distinct:
        return np.zeros(0, np.uint16), np.zeros(len(texts) + 1, np.int64)
    ids, sizes = np.frombuffer(b"".join(distinct), np.uint16), np.fromiter(map(len, distinct), np.int64, len(distinct)) // 2
    starts, code = np.cumsum(sizes) - sizes, flat.indices.to_numpy()
    size = sizes[code]
    ends = np.concatenate([[0], np.cumsum(size)])
    made = ids[np.arange(ends[-1]) + np.repeat(starts[code] - ends[:-1], size)]
    offsets = np.asarray(words.offsets, dtype=np.int64)
    return made, ends[offsets - offsets[0]]


def _pieces(batch: pa.RecordBatch, file: str, key: str, text: str, end_id: int, most: int) -> dict:
    ids, bounds = text_ids(batch.column(text), file)
    row, start, length, crc, total = [], [], [], [], []
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        own = np.append(ids[a:b].astype("<u4"), np.uint32(end_id))
        for cut in range(0, len(own), most):
            piece = own[cut:cut + most]
            row.append(i)
            start.append(cut)
            length.append(len(piece))
            crc.append(zlib.crc32(piece.tobytes()))
            total.append(len(own))
    return {"id": batch.column(key).take(pa.array(row, pa.int64())), "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int32()),
            "ids_crc32": pa.array(crc, pa.int64()), "doc_tokens": pa.array(total, pa.int64())}


def pack_histogram(counts: dict[int, int], most: int = SEQUENCE) -> list[tuple[int, tuple]]:
    """Packing patterns as (packs, items); items is a linked list (earlier items, length, times).

    ``counts`` has the pieces of each length from 1 to ``most``.
    """
    open_packs: dict[int, list[tuple[int, tuple]]] = defaultdict(list)  # by free space
    spaces: list[int] = []

    def put(space: int, packs: int, items: tuple) -> None:
        if packs:
            if not open_packs[space]:
                heapq.heappush(spaces, -space)
            open_packs[space].append((packs, items))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if spaces and -spaces[0] >= length:
                space = -spaces[0]
                packs, items = open_packs[space].pop()
                if not open_packs[space]:
                    heapq.heappop(spaces)
                used = min(left, packs)
                put(space, packs - used, items)
                put(space - length, used, (items[0], length, items[2] + 1) if items[1] == length else (items, length, 1))
                left -= used
            else:
                times = most // length
                put(most - times * length, left // times, ((), length, times))
                if left % times:
                    put(most - left % times * length, 1, ((), length, left % times))
                left = 0
    return [pack for packs in open_packs.values() for pack in packs]


def placements(patterns: list[tuple[int, tuple]]) -> tuple[np.ndarray, ...]:
    """Sorted first keys (length and rank), and for the ranks from there: first sequence, offset, pieces a sequence.

    There is one entry for each distinct length of a pattern: at most a few million
    whatever the number of documents, as a sequence has fewer than 91 distinct lengths.
    """
    entries, next_rank, first = [], defaultdict(int), 0
    for packs, items in sorted(patterns, key=lambda p: (-p[0], repr(p[1])[:200])):
        own = []
        while items:
            own.append(items[1:])
            items = items[0]
        offset = 0
        for length, times in reversed(own):
            entries.append((length << 44 | next_rank[length], first, offset, times, length))
            next_rank[length] += packs * times
            offset += length * times
        first += packs
    table = np.array(sorted(entries), dtype=np.int64).reshape(-1, 5)
    return tuple(table[:, i].copy() for i in range(4))


def _place(batch: pa.RecordBatch, table: tuple[np.ndarray, ...]) -> dict:
    length, rank = batch.column("length").to_numpy().astype(np.int64), batch.column("rank").to_numpy()
    key = length << 44 | rank
    at = np.searchsorted(table[0], key, side="right") - 1
    inside = key - table[0][at]
    times = table[3][at]
    return {n: batch.column(n) for n in ("id", "start", "ids_crc32", "doc_tokens")} | {
        "length": pa.array(length), "sequence_id": pa.array(table[1][at] + inside // times),
        "offset": pa.array(table[2][at] + inside % times * length)}


def pack(docs: DataFrame, file: str, most: int = SEQUENCE, end_id: int = END_ID, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``file`` is a vocabulary that every executor reaches at the same path, with fewer
    than 65,536 ids that never join across blanks. A NULL or empty text is the end id
    alone; a text of any length is cut into pieces of ``most`` ids and a rest. Repeated
    rows are packed each. An empty input gives no rows. Extra columns are not read.
    Only the histogram (at most ``most`` rows) reaches the driver.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)[key]
    made = arrow_map(docs.select(key, text), lambda batch: _pieces(batch, file, key, text, end_id, most),
                     f"id {kind}, start bigint, length int, ids_crc32 bigint, doc_tokens bigint", text, _STEP)
    buckets = BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    pieces = settle(made.withColumn("row", F.monotonically_increasing_id()).withColumn(
        "bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("int")), "pieces")
    groups = settle(pieces.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    counts = {r["length"]: r["n"] for r in groups.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = spark.sparkContext.broadcast(placements(pack_histogram(counts, most)))
    # A length has at most ``buckets`` rows here.
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = groups.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    local = pieces.withColumn("local", F.row_number().over(Window.partitionBy("length", "bucket").orderBy("row")))
    ranked = local.join(offsets, ["length", "bucket"]).withColumn("rank", (F.col("local") - 1 + F.col("before")).cast("bigint"))
    placed = arrow_map(ranked.select("id", "start", "length", "ids_crc32", "doc_tokens", "rank"), lambda batch: _place(batch, table.value),
                       f"id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint", None)
    return placed.withColumnRenamed("id", key)


def op9_packing(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return pack(docs, public_tokenizers.path(VOCABULARY))
