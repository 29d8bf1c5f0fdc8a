"""Removal of repeated stretches: from flagged places to texts without them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from . import sketch
from .common import arrow_map
from .rolling import mix


def numbered(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, row, text): every row with a number of its own that is the same each time a stored table is read."""
    return docs.select(F.col(key).alias("id"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("text"))


def runs(owner: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Consecutive places of one owner as (owner, first place, how many)."""
    order = np.lexsort((place, owner))
    owner, place = owner[order], place[order]
    if not len(owner):
        return owner, place, place
    begin = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (place[1:] != place[:-1] + 1)]))
    return owner[begin], place[begin], np.diff(np.append(begin, len(owner)))


def covered(begin: np.ndarray, count: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of ``n`` places the stretches of ``width`` cover that start at ``count`` places from each ``begin``."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, begin, 1)
    np.add.at(change, np.minimum(begin + count - 1 + width, n), -1)
    return np.cumsum(change[:n]) > 0


def by_group(process: Callable[[pa.Table], pa.RecordBatch], group: str, least: int = 50_000):
    """A function for ``mapInArrow`` over rows sorted by ``group``: ``process`` gets whole groups, many at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows < least or batch.column(group)[0].as_py() == batch.column(group)[-1].as_py() and rows < 20 * least:
                continue
            table = pa.Table.from_batches(held)
            key = table[group].to_numpy()
            last = int(np.flatnonzero(key == key[-1])[0])
            if last:
                yield process(table.slice(0, last))
            held, rows = table.slice(last).to_batches(), table.num_rows - last
        if rows:
            yield process(pa.Table.from_batches(held))

    return run


def finish(rows: DataFrame, removed: DataFrame, known: Callable[[pa.RecordBatch, np.ndarray], dict], columns: str,
           work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Bring the removed places (row, place, n; a written table) of each row together with the row, and finish it.

    ``known`` gets rows and which of them may lose something, and returns id, row, ``columns``
    (final for rows that lose nothing), and the text of the others only: no more texts than
    those are shuffled. Bits of a fixed size tell the rows apart.
    """
    shared = sketch.members(removed, "row")

    def split(batch: pa.RecordBatch) -> dict:
        hit = shared.value.test(mix(batch.column("row").to_numpy().view(np.uint64)))
        texts = [t if h else None for h, t in zip(hit.tolist(), batch.column("text").to_pylist(), strict=True)]
        return {"id": batch.column("id"), "row": batch.column("row"), "text": pa.array(texts, pa.string())} | known(batch, hit)

    kind = dict(rows.dtypes)["id"]
    rows = arrow_map(rows, split, f"id {kind}, row bigint, text string, {columns}")
    gathered = removed.groupBy("row").agg(F.collect_list(F.struct("place", "n")).alias("removed")).withColumnRenamed("row", "_row")
    joined = rows.join(gathered, F.col("row") == F.col("_row"), "left").drop("_row")
    ship_package(rows.sparkSession)
    return joined.mapInArrow(lambda batches: (work(b) for b in batches if b.num_rows), schema)
