"""Helpers that several operators of this package share."""

from __future__ import annotations

import ctypes
import gc
import inspect
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from ..storage import settle, workspace

__all__ = ["arrow_map", "ascii_lower", "discard", "documents", "give_back", "named_rows", "settle", "shuffles_dropped", "slices", "text_bytes", "unused", "workspace"]

#: Bytes of text that one step inside a task works on; a longer text is a step of its own.
STEP_BYTES = 4 << 20
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def documents(spark: SparkSession, folder: str, table: str = "documents") -> DataFrame:
    """A whole stored table."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; ``lower`` alone would change other letters too."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, upper, lower))


def slices(batch: pa.RecordBatch, column: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch whose texts together stay near ``limit`` bytes."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // limit
    starts = np.flatnonzero(np.diff(part, prepend=-1))
    for begin, end in zip(starts, [*starts[1:], len(part)], strict=True):
        yield batch.slice(int(begin), int(end - begin))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts on end, and where each begins (one entry more than texts); NULL is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def arrow_map(df: DataFrame, work: Callable[[pa.RecordBatch], dict | None], schema: str, text: str | None = "text",
              limit: int = STEP_BYTES) -> DataFrame:
    """``mapInArrow`` with a function from a bounded batch to columns by name."""
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, text, limit) if text else [batch]:
                if piece.num_rows:
                    made = work(piece)
                    for part in made if inspect.isgenerator(made) else [made]:
                        if part is not None:
                            yield pa.RecordBatch.from_arrays([pa.array(part[n]) if not isinstance(part[n], pa.Array) else part[n] for n in names], names)

    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return memory that earlier tasks of a Python worker freed to the system: a worker lives on, and its pools keep what they had."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library keeps its own ways
        pass


def unused(df: DataFrame, name: str) -> str:
    """``name``, or with underlines before it, such that ``df`` has no column of that name in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def named_rows(docs: DataFrame, name: str) -> DataFrame:
    """``docs``, read from stored files, with a name of every row: its file and place, however the files are split."""
    place = docs.metadataColumn("_metadata")
    return docs.withColumn(name, F.concat_ws(":", place["row_index"].cast("string"), place["file_path"]))


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What the writes inside shuffle is deleted as each ends, not when the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table below the shared folder that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
