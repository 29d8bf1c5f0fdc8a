"""The last rows of each key as state of a stream."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Orders that are missing come first.
_EARLIEST = -(1 << 63)
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: State is kept by this store: on disk, with a log of changes in the checkpoint.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Fixed value: a checkpoint holds its state by these buckets.
BUCKETS = 2048


def _number(name: str, kind: T.DataType):
    """A column of the order as a whole number that sorts alike."""
    column = F.col(name)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        column = F.unix_micros(column.cast("timestamp"))
    elif isinstance(kind, T.DateType):
        column = F.unix_date(column)
    elif not isinstance(kind, T.IntegralType):
        raise ValueError(f"{name}: a stream's order needs whole numbers, dates or timestamps")
    return F.coalesce(column.cast("bigint"), F.lit(_EARLIEST))


def _keep_last(n: int, order: Sequence[str]):
    """Keeps the last ``n`` rows of each key of a bucket and tells the mean of their values whenever they change.

    A row is its order, whether its value is known, and the value. Of rows of equal order the later arrival is the later row.
    State is an array per column with the rows of all keys of the bucket.
    """
    size, columns = len(order), ["key", *order, "known", "value"]

    def update(_, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, arrived, changed = {}, {}, {}
        for key, *row in zip(*state.get, strict=True) if state.exists else ():
            held.setdefault(key, []).append(tuple(row))
        for frame in frames:
            for key, *row in zip(*[frame[c].tolist() for c in columns], strict=True):
                arrived.setdefault(key, []).append(tuple(row))
        for key, rows in arrived.items():
            before = held.get(key, [])
            kept = sorted(before + rows, key=lambda r: r[:size])[-n:]
            if kept != before:
                held[key] = kept
                changed[key] = [r[-1] for r in kept if r[-2]]
        if changed:
            state.update(tuple(map(list, zip(*[(key, *row) for key, rows in held.items() for row in rows], strict=True))))
            yield pd.DataFrame({"key": list(changed), "mean": [sum(v) / len(v) if v else None for v in changed.values()],
                                "games": [len(v) for v in changed.values()]})

    return update


def last_rows(stream: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, n: int) -> DataFrame:
    """A stream of keys, mean and games: a row for each key whose last ``n`` rows changed in a batch.

    State goes by buckets of keys, as a call of Python for each key takes thousands of times what its rows do; a batch reads and writes the
    buckets of its keys, some hundred rows each at a hundred thousand keys. Before the shuffle every Arrow batch is cut to the last ``n`` rows per key, so that a key with most of
    the rows sends few. Keys are whole numbers, texts or booleans; NULL is a key too: state goes by their JSON, which is never NULL.
    """
    kinds = {f.name: f.dataType for f in stream.schema.fields}
    names = [f"order_{i}" for i in range(len(order))]
    rows = stream.select(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}).alias("key"), *[_number(o, kinds[o]).alias(a) for a, o in zip(names, order, strict=True)], F.col(value).isNotNull().alias("known"),
                         F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias("value"))

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ordered = frame.sort_values(names, kind="stable")
            yield ordered[ordered.groupby("key", sort=False).cumcount(ascending=False) < n]

    made = T.StructType([T.StructField("key", T.StringType()), T.StructField("mean", T.DoubleType()), T.StructField("games", T.LongType())])
    held = T.StructType([T.StructField(c, T.ArrayType(rows.schema[c].dataType)) for c in ("key", *names, "known", "value")])
    bucket = F.pmod(F.xxhash64("key"), F.lit(BUCKETS))
    means = rows.mapInPandas(cut, rows.schema).withColumn("bucket", bucket).groupBy("bucket").applyInPandasWithState(
        _keep_last(n, names), made, held, "update", GroupStateTimeout.NoTimeout)
    return means.select(F.from_json("key", T.StructType([T.StructField(k, kinds[k]) for k in keys])).alias("key"), "mean", "games").select("key.*", "mean", "games")


class state_store:
    """The session's state store within a block."""

    def __init__(self, spark) -> None:
        self.spark = spark

    def __enter__(self) -> None:
        self.before = self.spark.conf.get(_PROVIDER, None)
        self.spark.conf.set(_PROVIDER, STATE_STORE)

    def __exit__(self, *_) -> None:
        if self.before is None:
            self.spark.conf.unset(_PROVIDER)
        else:
            self.spark.conf.set(_PROVIDER, self.before)
