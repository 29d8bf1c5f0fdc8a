"""Keep a table of current rows from arriving files.

Every micro-batch is reduced to the rows that can still matter and stored as a segment of
a table of snapshots (``sources.snapshots``): a replayed batch is not stored twice, segments of
equal size merge, and the number of segments stays logarithmic in the batches. No batch rewrites all that is stored.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.order import keep_one
from ..sources.snapshots import ARRIVAL, Snapshots
from .state import last_rows, state_store


def read_arriving(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1000) -> DataFrame:
    """A stream of the Parquet files that arrive in a folder, many to a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def run_to_log(stream: DataFrame, log: str, checkpoint: str, reduce: Callable[[DataFrame], DataFrame], merge: Callable[[DataFrame], DataFrame],
               mode: str = "append", timeout: int | None = None) -> None:
    """Process everything that has arrived, then stop; without a limit in seconds it takes as long as it takes.

    ``reduce`` gets a batch, ``merge`` the rows of several with their ``ARRIVAL``. A checkpoint that was lost is another
    source: what it reads again is stored again, as the later arrival.
    """
    spark, schema = stream.sparkSession, stream.schema
    stored = Snapshots(spark, log)

    def write(batch: DataFrame, number: int) -> None:
        query = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        stored.append(reduce(batch), (query, number))
        stored.compact(schema, merge)

    running = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start()
    if timeout is None:
        running.awaitTermination()
    elif not running.awaitTermination(timeout):
        running.stop()
        raise TimeoutError(f"the stream did not finish within {timeout} seconds")


def stream_upsert_latest(stream: DataFrame, log: str, checkpoint: str, keys: Sequence[str],
                         order: Sequence[str], timeout: int | None = None) -> DataFrame:
    """The newest row per key, by ``order`` and then by arrival."""
    def newest(rows: DataFrame) -> DataFrame:
        return keep_one(rows, keys, [*order, ARRIVAL], keep="last")

    run_to_log(stream, log, checkpoint, lambda batch: keep_one(batch, keys, order, keep="last"), newest, timeout=timeout)
    return newest(Snapshots(stream.sparkSession, log).read(stream.schema)).drop(ARRIVAL)


def stream_rolling_last_n(stream: DataFrame, log: str, checkpoint: str, keys: Sequence[str],
                          order: Sequence[str], value: str, n: int = 3, timeout: int | None = None) -> DataFrame:
    """The mean of the last ``n`` values per key, and how many there were.

    The last rows of a key are state of the stream; a batch stores only the keys whose mean it may have changed.
    """
    def newest(rows: DataFrame) -> DataFrame:
        return keep_one(rows, keys, [ARRIVAL], keep="last")

    means = last_rows(stream, keys, order, value, n)
    with state_store(stream.sparkSession):
        run_to_log(means, log, checkpoint, lambda batch: batch, newest, "update", timeout)
    found = newest(Snapshots(stream.sparkSession, log).read(means.schema))
    return found.select(*keys, F.col("mean").alias(f"{value}_avg"), "games")


def compact(current: DataFrame, log: str) -> None:
    """Start a new log that holds the current rows as its first segment."""
    Snapshots(current.sparkSession, log).replace(current)
