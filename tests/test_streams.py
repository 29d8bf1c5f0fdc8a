"""Streams: late files, replays and growing tables."""

import random
from datetime import datetime

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from scoreline.operators.order import latest_n
from scoreline.sources import snapshots
from scoreline.sources.snapshots import Snapshots
from scoreline.streaming import changes, state

SCHEMA = "id int, ts timestamp, v double"


def at(minute):
    return datetime(2024, 1, 1, 0, minute)


@pytest.fixture
def places(tmp_path):
    return str(tmp_path / "in"), str(tmp_path / "log"), str(tmp_path / "progress")


def land(frame, rows, path):
    frame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def upsert(spark, frame, places):
    arriving, log, progress = places
    stream = changes.read_arriving(spark, arriving, frame([], SCHEMA).schema)
    return rows_of(changes.stream_upsert_latest(stream, log, progress, ["id"], ["ts"]))


def test_upsert_takes_the_newest_even_if_it_came_first(spark, frame, places):
    land(frame, [(1, at(5), 5.0), (2, at(1), 1.0)], places[0])
    land(frame, [(1, at(3), 3.0)], places[0])
    assert upsert(spark, frame, places) == [(1, at(5), 5.0), (2, at(1), 1.0)]


def test_later_runs_continue(spark, frame, places):
    land(frame, [(1, at(1), 1.0)], places[0])
    assert upsert(spark, frame, places) == [(1, at(1), 1.0)]
    land(frame, [(1, at(2), 2.0), (3, at(1), 9.0)], places[0])
    assert upsert(spark, frame, places) == [(1, at(2), 2.0), (3, at(1), 9.0)]


def test_later_arrival_wins_a_tie(spark, frame, places):
    land(frame, [(1, at(1), 1.0)], places[0])
    upsert(spark, frame, places)
    land(frame, [(1, at(1), 2.0)], places[0])
    assert upsert(spark, frame, places) == [(1, at(1), 2.0)]


def test_a_replayed_batch_replaces_its_folder(spark, frame, places):
    arriving, log, progress = places
    land(frame, [(1, at(1), 1.0), (1, at(2), 3.0)], arriving)
    stream = changes.read_arriving(spark, arriving, frame([], SCHEMA).schema)
    first = rows_of(changes.stream_rolling_last_n(stream, log, progress, ["id"], ["ts"], "v", 2))
    again = rows_of(changes.stream_rolling_last_n(stream, log, progress + "-lost", ["id"], ["ts"], "v", 2))
    assert first == again == [(1, 2.0, 2)]


def test_rolling_mean_over_batches(spark, frame, places):
    arriving, log, progress = places
    for minute in (1, 4, 2, 3):
        land(frame, [(1, at(minute), float(minute)), (2 + minute, at(0), 7.0)], arriving)
    stream = changes.read_arriving(spark, arriving, frame([], SCHEMA).schema)
    found = rows_of(changes.stream_rolling_last_n(stream, log, progress, ["id"], ["ts"], "v", 3))
    assert found[0] == (1, 3.0, 3) and len(found) == 5


def test_compacted_log_reads_the_same(spark, frame, places):
    arriving, log, progress = places
    land(frame, [(1, at(1), 1.0), (2, at(1), 4.0)], arriving)
    stream = changes.read_arriving(spark, arriving, frame([], SCHEMA).schema)
    current = changes.stream_upsert_latest(stream, log, progress, ["id"], ["ts"])
    changes.compact(current, log + "-next")
    land(frame, [(2, at(1), 5.0)], arriving)
    continued = changes.stream_upsert_latest(
        changes.read_arriving(spark, arriving, stream.schema), log + "-next", progress, ["id"], ["ts"])
    assert rows_of(continued) == [(1, at(1), 1.0), (2, at(1), 5.0)]


def test_nothing_arrived_gives_no_rows(spark, frame, places, tmp_path):
    (tmp_path / "in").mkdir()
    assert upsert(spark, frame, places) == []


def test_state_gives_the_batch_result_after_any_cut(spark, frame, places):
    arriving, log, progress = places
    rng = random.Random(7)
    rows = [(rng.choice([None, 1, 2, 3]), None if i % 17 == 0 else datetime(2024, 1, 1, i % 24, (7 * i) % 60, i % 60), None if rng.random() < 0.2 else float(rng.randint(0, 99))) for i in range(240)]
    rows = list({(r[0], r[1]): r for r in rows}.values())
    schema = frame([], SCHEMA).schema
    cuts = [0, 1, 5, 60, 61, 150, len(rows)]
    for run in (range(3), range(3, 6)):  # a second run continues from state and log
        for i in run:
            land(frame, rows[cuts[i]:cuts[i + 1]], arriving)
        found = changes.stream_rolling_last_n(changes.read_arriving(spark, arriving, schema, 1), log, progress, ["id"], ["ts"], "v", 3)
    wanted = latest_n(frame(rows, SCHEMA), ["id"], ["ts"], 3).groupBy("id").agg(F.avg("v"), F.count("v"))
    assert rows_of(found) == rows_of(wanted) and len(rows_of(found)) == 4


def test_unchanged_keys_are_not_stored_again(spark, frame, places):
    arriving, log, progress = places
    schema = frame([], SCHEMA).schema
    land(frame, [(i, at(5), 1.0) for i in range(20)], arriving)
    changes.stream_rolling_last_n(changes.read_arriving(spark, arriving, schema), log, progress, ["id"], ["ts"], "v", 1)
    land(frame, [(3, at(1), 9.0), (4, at(6), 9.0)], arriving)
    means = changes.stream_rolling_last_n(changes.read_arriving(spark, arriving, schema), log, progress, ["id"], ["ts"], "v", 1)
    assert {r["id"]: r["v_avg"] for r in means.collect()} == {**{i: 1.0 for i in range(20)}, 4: 9.0}
    last = Snapshots(spark, log).manifest()["segments"][-1]["name"]
    assert rows_of(spark.read.parquet(f"{log}/{last}").select("id")) == [(4,)]


def test_state_is_updated_by_buckets_and_not_key_by_key(spark, frame, places, monkeypatch):
    arriving, log, progress = places
    schema = frame([], SCHEMA).schema
    monkeypatch.setattr(state, "BUCKETS", 2)
    for minute in (5, 3, 7):
        land(frame, [(i, at(minute), float(i + minute)) for i in range(300)], arriving)
    means = changes.stream_rolling_last_n(changes.read_arriving(spark, arriving, schema, 1), log, progress, ["id"], ["ts"], "v", 2)
    assert sorted(rows_of(means)) == [(i, i + 6.0, 2) for i in range(300)]
    plan = state.last_rows(changes.read_arriving(spark, arriving, schema), ["id"], ["ts"], "v", 2)._jdf.queryExecution().analyzed().toString()
    assert "bucket" in plan and "TransformWithState" not in plan


def test_a_stream_order_needs_whole_numbers(spark, frame, places):
    (lambda p: land(frame, [(1, at(1), 1.0)], p))(places[0])
    stream = changes.read_arriving(spark, places[0], frame([], SCHEMA).schema)
    with pytest.raises(ValueError, match="order"):
        changes.stream_rolling_last_n(stream, places[1], places[2], ["id"], ["v"], "v")


ROWS = "k int, v int"


def numbers(table, frame):
    return rows_of(table.read(frame([], ROWS).schema).select("k", "v"))


def test_segments_stay_logarithmic_and_files_few(spark, frame, tmp_path):
    table, schema = Snapshots(spark, str(tmp_path / "t")), frame([], ROWS).schema
    for i in range(40):
        assert table.append(frame([(i % 7, i)], ROWS).coalesce(1), ("s", i))
        table.compact(schema, lambda rows: changes.keep_one(rows, ["k"], [snapshots.ARRIVAL], keep="last"))
        assert len(table.manifest()["segments"]) <= 9
    assert [s["tier"] for s in table.manifest()["segments"]] == [2, 2, 1, 1]
    newest = changes.keep_one(table.read(schema), ["k"], [snapshots.ARRIVAL], keep="last")
    assert rows_of(newest.select("k", "v")) == [(k, max(i for i in range(40) if i % 7 == k)) for k in range(7)]
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("segment-")]) <= 4 + 8
    assert len([p for p in (tmp_path / "t" / "_manifest").iterdir() if p.name.isdigit()]) <= snapshots.GRACE + 1


def test_a_replayed_batch_is_stored_once(spark, frame, tmp_path):
    table = Snapshots(spark, str(tmp_path / "t"))
    assert table.append(frame([(1, 1)], ROWS), ("s", 0)) and not table.append(frame([(1, 1)], ROWS), ("s", 0))
    assert table.append(frame([(2, 2)], ROWS), ("other", 0)) and numbers(table, frame) == [(1, 1), (2, 2)]


@pytest.mark.parametrize("step", ["_write", "_publish"])
@pytest.mark.parametrize("change", ["append", "replace", "compact"])
def test_a_reader_sees_old_or_new_when_a_writer_dies(spark, frame, tmp_path, monkeypatch, step, change):
    table, schema = Snapshots(spark, str(tmp_path / "t")), frame([], ROWS).schema
    for i in range(snapshots.FAN):
        table.append(frame([(i, i)], ROWS), ("s", i))
    before = numbers(table, frame)
    real = getattr(Snapshots, step)

    def dies(self, given):
        if step == "_write":
            real(self, given)  # the rows are there, the manifest is not
        raise OSError("lost")

    act = {"append": lambda: table.append(frame([(9, 9)], ROWS), ("s", 9)), "replace": lambda: table.replace(frame([(9, 9)], ROWS), ("s", 9)),
           "compact": lambda: table.compact(schema)}[change]
    monkeypatch.setattr(Snapshots, step, dies)
    with pytest.raises(OSError):
        act()
    assert numbers(table, frame) == before
    opened = table.read(schema)
    monkeypatch.setattr(Snapshots, step, real)
    act()  # the retry of the same batch
    assert numbers(table, frame) == {"append": sorted([*before, (9, 9)]), "replace": [(9, 9)], "compact": before}[change]
    assert rows_of(opened.select("k", "v")) == before  # a reader of the snapshot before still reads it
    named = {s["name"] for s in table.manifest()["segments"]} | {n for _, n in table.manifest()["retired"]}
    assert {p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("segment-")} == named


def test_a_table_may_be_replaced_by_what_is_read_from_it(spark, frame, tmp_path):
    table = Snapshots(spark, str(tmp_path / "t"))
    assert numbers(table, frame) == []
    table.append(frame([(1, 1), (2, 2)], ROWS))
    table.replace(table.read(frame([], ROWS).schema).where("k = 2").drop(snapshots.ARRIVAL))
    assert numbers(table, frame) == [(2, 2)]
