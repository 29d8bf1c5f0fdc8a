"""A count-min sketch that tells which hashes may occur more than once.

Every task sketches what it reads: two rows of counters, of which only the touched
ones are written, as gaps between sorted cells. The sketches are merged segment by
segment, counters stop at two, and one bit per cell remains: whether its count
may be two or more. A hash all of whose cells have the bit may be repeated; no
repeated hash lacks it. The bits have a fixed size whatever the input; with more
hashes than cells more unrepeated ones pass, and none is lost. ``repeated`` and
``members`` together do the same with cells that follow the number of repeated hashes.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from ..session import ship_package
from .common import STEP_BYTES, slices
from .rolling import mix

#: Cells of a row as a power of two: two rows of bits are 128 MB, which bounds what is broadcast.
CELL_BITS = 29
ROWS = 2
_SEGMENT_BITS = 20
#: Bits of a hash by which ``repeated`` tells hashes apart, and of those the first, which deal them out.
_PREFIX_BITS = 40
_PREFIX_SEGMENT_BITS = 12
#: The most cells of a row, as a power of two, that follow a number of members: two rows are 256 MB.
MOST_BITS = 30
#: Hashes that a task sketches before it writes; more make the gaps smaller.
_FLUSH = 3_000_000


def _cells(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(32 * row)) & np.uint64((1 << bits) - 1)


class Repeats:
    """The merged bits; ``test`` says which hashes may be repeated."""

    def __init__(self, bits: int) -> None:
        self.bits, self.rows = bits, np.zeros((ROWS, (1 << bits) // 8), np.uint8)

    def __getstate__(self) -> dict:
        # Most bits are clear: what is broadcast, and kept on disk by every executor, is a small part of them.
        return {"bits": self.bits, "rows": [zlib.compress(row, 1) for row in self.rows]}

    def __setstate__(self, state: dict) -> None:
        self.bits, self.rows = state["bits"], np.zeros((ROWS, (1 << state["bits"]) // 8), np.uint8)
        for row, data in zip(self.rows, state["rows"], strict=True):
            row[:] = np.frombuffer(zlib.decompress(data), np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        for row in range(ROWS):
            cell = _cells(hashes, row, self.bits)
            np.bitwise_or.at(self.rows[row], (cell >> np.uint64(3)).astype(np.int64), np.uint8(1) << (cell & np.uint64(7)).astype(np.uint8))

    def test(self, hashes: np.ndarray) -> np.ndarray:
        passed = np.ones(len(hashes), bool)
        for row in range(ROWS):
            cell = _cells(hashes, row, self.bits)
            passed &= (self.rows[row][(cell >> np.uint64(3)).astype(np.int64)] >> (cell & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return passed


def prefixes(hashes: np.ndarray) -> np.ndarray:
    """The first ``_PREFIX_BITS`` bits of hashes, mixed anew: chosen hashes, like the least of some, are not spread evenly."""
    return mix(hashes) >> np.uint64(64 - _PREFIX_BITS)


def repeated(df: DataFrame, text: str, hashes: Callable[[pa.RecordBatch], np.ndarray], step: int = STEP_BYTES) -> DataFrame:
    """The prefixes that more than one hash of all rows of ``df`` has, as ``hash``.

    Some three bytes of every hash are shuffled, and a task holds one of ``2 ** _PREFIX_SEGMENT_BITS`` parts at a time, so
    that neither depends on a number of cells. Different hashes share a prefix by chance once in ``2 ** _PREFIX_BITS``.
    """
    rest = _PREFIX_BITS - _PREFIX_SEGMENT_BITS

    def packed(held: list[np.ndarray]) -> pa.RecordBatch:
        found = np.sort(prefixes(np.concatenate(held)))
        # Two of a kind say as much as more.
        keep = np.ones(len(found), bool)
        keep[2:] = found[2:] != found[:-2]
        found = found[keep].astype(np.int64)
        segments, begin = np.unique(found >> rest, return_index=True)
        parts = [np.diff(part & ((1 << rest) - 1), prepend=0).astype("<u4") for part in np.split(found, begin[1:])]
        # Byte by byte, as the high ones of gaps are mostly clear and go when the shuffle is compressed.
        gaps = [part.view(np.uint8).reshape(-1, 4).T.tobytes() for part in parts]
        return pa.RecordBatch.from_arrays([pa.array(segments, pa.int32()), pa.array(gaps, pa.binary())], ["segment", "gaps"])

    def touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for piece in slices(batch, text, step):
                held.append(hashes(piece))
                n += len(held[-1])
                if n >= _FLUSH:
                    yield packed(held)
                    held, n = [], 0
        if n:
            yield packed(held)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def done() -> pa.RecordBatch:
            found = np.sort(np.concatenate(held))
            return pa.RecordBatch.from_arrays([pa.array((at << rest) + np.unique(found[1:][found[1:] == found[:-1]]), pa.int64())], ["hash"])

        for batch in batches:
            for segment, gaps in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if segment != at:
                    if at is not None:
                        yield done()
                    at, held = segment, []
                held.append(np.cumsum(np.ascontiguousarray(np.frombuffer(gaps, np.uint8).reshape(4, -1).T).view("<u4")[:, 0], dtype=np.int64))
        if at is not None:
            yield done()

    ship_package(df.sparkSession)
    return df.mapInArrow(touched, "segment int, gaps binary").repartition("segment").sortWithinPartitions("segment").mapInArrow(merge, "hash bigint")


def bits_for(numbers: int) -> int:
    """Cells, as a power of two, that ``members`` needs for so many numbers: others pass in 6 of 100 cases at most."""
    return min(max(16, (4 * max(numbers, 1) - 1).bit_length()), MOST_BITS)


def members(df: DataFrame, column: str, bits: int = 26) -> Broadcast:
    """Bits that tell which numbers may be among those of a column: two rows of ``2 ** bits`` whatever the input."""
    spark = df.sparkSession
    ship_package(spark)
    size = 1 << min(18, bits) >> 3

    def packed(segment: int, some: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([segment], pa.int32()), pa.array([zlib.compress(some.tobytes(), 1)], pa.binary())], ["segment", "cells"])

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = Repeats(bits)
        for batch in batches:
            bitmap.add(mix(batch.column(0).to_numpy().view(np.uint64)))
        for row in range(ROWS):
            for i, some in enumerate(bitmap.rows[row].reshape(-1, size)):
                if some.any():
                    yield packed(row << 16 | i, some)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, merged = None, np.zeros(size, np.uint8)
        for batch in batches:
            for segment, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if segment != at:
                    if at is not None:
                        yield packed(at, merged)
                    at, merged = segment, np.zeros(size, np.uint8)
                merged |= np.frombuffer(zlib.decompress(data), np.uint8)
        if at is not None:
            yield packed(at, merged)

    made = df.select(column).mapInArrow(own, "segment int, cells binary").repartition("segment").sortWithinPartitions("segment").mapInArrow(merge, "segment int, cells binary")
    return spark.sparkContext.broadcast(_gathered(made, bits))


def _gathered(segments: DataFrame, bits: int) -> Repeats:
    bitmap = Repeats(bits)
    for r in segments.toLocalIterator():
        row, segment = r["segment"] >> 16, r["segment"] & 0xFFFF
        some = np.frombuffer(zlib.decompress(bytes(r["cells"])), np.uint8)
        bitmap.rows[row][segment * len(some):(segment + 1) * len(some)] = some
    return bitmap


def pack_gaps(cells: np.ndarray) -> bytes:
    """Sorted numbers as bytes: 255 means go on, anything less ends a gap."""
    gaps = np.diff(cells, prepend=0)
    more = gaps // 255
    made = np.full(int((more + 1).sum()), 255, np.uint8)
    made[np.cumsum(more + 1) - 1] = gaps % 255
    return made.tobytes()


def unpack_gaps(data: bytes) -> np.ndarray:
    gaps = np.frombuffer(data, np.uint8)
    return np.cumsum(gaps, dtype=np.int64)[gaps != 255]


def _sketch(hashes: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    width = min(_SEGMENT_BITS, bits)
    for row in range(ROWS):
        cells = np.sort(_cells(hashes, row, bits)).astype(np.int64)
        # Two of a kind say as much as more.
        keep = np.ones(len(cells), bool)
        keep[2:] = cells[2:] != cells[:-2]
        cells = cells[keep]
        cuts = np.searchsorted(cells, np.arange((1 << bits >> width) + 1) << width)
        parts = [(i, pack_gaps(cells[a:b] - (i << width))) for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)) if b > a]
        yield pa.RecordBatch.from_arrays([pa.array([row << 16 | i for i, _ in parts], pa.int32()), pa.array([p for _, p in parts], pa.binary())], ["segment", "cells"])


def repeats(df: DataFrame, text: str, hashes: Callable[[pa.RecordBatch], np.ndarray], bits: int = CELL_BITS, step: int = STEP_BYTES) -> Broadcast:
    """Sketch all hashes of all rows of ``df`` and broadcast the bits."""
    spark = df.sparkSession
    ship_package(spark)

    def touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for piece in slices(batch, text, step):
                held.append(hashes(piece))
                n += len(held[-1])
                if n >= _FLUSH:
                    yield from _sketch(np.concatenate(held), bits)
                    held, n = [], 0
        if n:
            yield from _sketch(np.concatenate(held), bits)

    width = min(_SEGMENT_BITS, bits)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, counts = None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([zlib.compress(np.packbits(counts >= 2, bitorder="little").tobytes(), 1)], pa.binary())], ["segment", "cells"])

        for batch in batches:
            for segment, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if segment != at:
                    if at is not None:
                        yield done()
                    at, counts = segment, np.zeros(1 << width, np.uint8)
                cells = unpack_gaps(data)
                # At most two of a kind: one goes to the first half, the other to the second.
                again = np.zeros(len(cells), bool)
                again[1:] = cells[1:] == cells[:-1]
                counts[cells[~again]] += 1
                counts[cells[again]] += 1
                np.minimum(counts, 2, out=counts)
        if at is not None:
            yield done()

    made = df.mapInArrow(touched, "segment int, cells binary").repartition("segment").sortWithinPartitions("segment").mapInArrow(merge, "segment int, cells binary")
    return spark.sparkContext.broadcast(_gathered(made, bits))
