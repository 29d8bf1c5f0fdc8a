"""Streams of arriving files."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..storage import workspace
from ..streaming import changes
from .registry import query


def _arriving_events(t):
    """All events, landed in time order in as many files as a shuffle has partitions, read as a stream of a few batches."""
    path = workspace(t.spark, "arriving")
    events = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    files = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    events.repartitionByRange(files, "ts").write.parquet(path)
    return changes.read_arriving(t.spark, path, events.schema, files_per_batch=max(1, files // 4))


@query("stream_upsert_latest", """
SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def stream_upsert_latest(t):
    newest = changes.stream_upsert_latest(
        _arriving_events(t), workspace(t.spark, "log"), workspace(t.spark, "progress"), ["user_id"], ["ts", "event_id"])
    return newest.drop("ts")


@query("stream_rolling_last_n", """
SELECT user_id, round(avg(value), 6) + 0.0 AS value_avg, CAST(count(*) AS BIGINT) AS games FROM (
  SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 3) e
GROUP BY user_id""")
def stream_rolling_last_n(t):
    means = changes.stream_rolling_last_n(
        _arriving_events(t), workspace(t.spark, "log"), workspace(t.spark, "progress"), ["user_id"], ["ts", "event_id"],
        "value", 3)
    return means.withColumn("value_avg", F.round("value_avg", 6))
