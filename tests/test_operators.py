"""Operators against brute force on small frames, and their traps."""

import random
from collections import Counter

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from scoreline.operators import aggregate as A
from scoreline.operators import changes, filters, order, sample, stats
from scoreline.operators import joins as J
from scoreline.operators.columns import keep_first_of_equal_names, rename_positions, swap_sides


def skewed_scores(n=400, seed=3):
    """One score holds a third of the rows."""
    rng = random.Random(seed)
    return [(i, 5.0 if i % 3 == 0 else float(rng.randint(-20, 20)) / 2) for i in range(n)]


def average_places(scores):
    return {s: sum(1 for x in scores if x > s) + (scores.count(s) + 1) / 2 for s in set(scores)}


def test_average_rank_matches_brute_force(frame):
    rows = skewed_scores()
    expected = average_places([s for _, s in rows])
    df = frame([*rows, (9999, None)], "id int, score double")
    exact = {r["id"]: r["place"] for r in order.average_rank(df, "score", "place", truncate=False).collect()}
    cut = {r["id"]: r["place"] for r in order.average_rank(df, "score", "place").collect()}
    assert len(exact) == len(rows) + 1
    assert exact.pop(9999) is None and cut.pop(9999) is None
    assert all(exact[i] == expected[s] and cut[i] == int(expected[s]) for i, s in rows)


def test_running_totals(frame):
    values = sorted({round(random.Random(1).uniform(-9, 9) * k, 3) for k in range(1, 200)})
    df = frame([(v, i) for i, v in enumerate(values)], "v double, n int").repartition(5)
    found = {r["v"]: r["n_before"] for r in order.running_totals(df, "v", ["n"]).collect()}
    assert found == {v: sum(range(i)) for i, v in enumerate(values)}


def test_category_codes(frame):
    df = frame([("b",), ("a",), (None,), ("c",), ("a",)], "c string")
    assert rows_of(order.category_codes(df, "c", "code")) == [("a", 0), ("a", 0), ("b", 1), ("c", 2), (None, -1)]


def test_hash_positions_number_each_label_without_gaps(frame):
    rows = [(i, "hot" if i % 3 else "cold") for i in range(500)] + [(1000, None)]
    placed = order.hash_positions(frame(rows, "id int, label string"), 42, ["id"], "place", keys=["label"]).collect()
    assert len(placed) == 501
    for label in ("hot", "cold", None):
        places = sorted(r["place"] for r in placed if r["label"] == label)
        assert places == list(range(1, len(places) + 1))


def test_keep_one_and_latest(frame):
    df = frame([(1, 1, "a"), (1, 2, "b"), (2, 5, "c"), (None, 1, "d"), (None, 2, "e")], "k int, t int, v string")
    assert rows_of(order.keep_one(df, ["k"], ["t"])) == [(1, 1, "a"), (2, 5, "c"), (None, 1, "d")]
    assert rows_of(order.keep_one(df, ["k"], ["t"], keep="last")) == [(1, 2, "b"), (2, 5, "c"), (None, 2, "e")]
    assert order.latest_n(df, ["k"], ["t"], 2).count() == 5
    with pytest.raises(ValueError):
        order.keep_one(df, ["k"], ["t"], keep="any")


@pytest.mark.parametrize("n", [0, 1, 137, 400])
def test_sample_is_exact_and_independent_of_partitions(frame, n):
    df = frame(skewed_scores(), "id int, score double")
    one = rows_of(sample.sample_n(df.repartition(1), n, 42, ["id"]))
    many = rows_of(sample.sample_n(df.repartition(6), n, 42, ["id"]))
    assert len(one) == n and one == many


def test_sample_refines_large_buckets(frame, monkeypatch):
    monkeypatch.setattr(sample, "_SMALL_BUCKET", 0)
    df = frame(skewed_scores(), "id int, score double")
    assert sample.sample_n(df, 123, 42, ["id"]).count() == 123


def test_sample_larger_than_table(frame):
    with pytest.raises(ValueError):
        sample.sample_n(frame([(1,)], "id int"), 2, 42, ["id"])


def test_swapped_rows_exchange_sides(frame):
    df = frame([(i, i, i + 100, 1.0, 2.0) for i in range(10)],
               "match_id int, team_1_id int, team_2_id int, mw_team1 double, mw_team2 double")
    both = sample.add_swapped(df, 0.5, 42, ["match_id"])
    mirrored = both.where("swapped = 1")
    assert both.count() == 15 and mirrored.count() == 5
    assert mirrored.where("team_1_id = match_id + 100 AND team_2_id = match_id AND mw_team1 = 2.0").count() == 5
    assert rows_of(swap_sides(swap_sides(df))) == rows_of(df)


def test_noise_touches_listed_columns_only(frame):
    df = frame([(i, 1.0, 1.0) for i in range(400)], "id int, a double, b double")
    noisy = sample.add_noisy(df, ["a"], 0.25, 0.08, 42, ["id"]).where("noisy = 1")
    count, sd = noisy.agg(F.count("*"), F.stddev("a")).first()
    assert count == 100 and 0.05 < sd < 0.11
    assert noisy.where("b <> 1.0 OR a = 1.0").count() == 0


def test_mode_tie_takes_the_smallest(frame):
    df = frame([(1, "b"), (1, "a"), (1, None), (1, None), (2, "c"), (2, "c"), (2, "a"), (3, None)], "k int, v string")
    assert rows_of(A.mode_by_key(df, ["k"], "v", "m")) == [(1, "a"), (2, "c"), (3, None)]


def test_mode_and_means(frame):
    df = frame([(1, 0, 2.0), (1, 1, 4.0), (1, 1, None)], "k int, c int, x double")
    assert rows_of(A.mode_and_means(df, ["k"], "c", "mode", {"x": "mean"})) == [(1, 1, 3.0)]


def test_record_and_sides(frame):
    df = frame([(1, 2, 1), (2, 1, 1), (1, 2, 2)], "team_1_id int, team_2_id int, winner_id int")
    sides = A.sides_to_rows(df, [{"team": "team_1_id"}, {"team": "team_2_id"}], keep=["winner_id"])
    record = A.team_record(sides, ["team"], F.col("winner_id") == F.col("team"), "w", "l", "rate")
    assert rows_of(record) == [(1, 2, 1, pytest.approx(2 / 3)), (2, 1, 2, pytest.approx(1 / 3))]


def test_group_values_keeps_every_value(frame):
    df = frame(skewed_scores(), "id int, score double").withColumn("g", F.lit("hot"))
    found = {r["score"]: r["n"] for r in A.group_values(df, ["g"], "score").collect()}
    assert found == Counter(s for _, s in skewed_scores())


def test_upserts_agree(frame):
    stored = frame([(1, "old"), (2, "old")], "id int, v string")
    arriving = frame([(2, "new"), (3, "new")], "id int, v string")
    expected = [(1, "old"), (2, "new"), (3, "new")]
    assert rows_of(changes.upsert_latest(stored, arriving, ["id"], ["v"])) == expected
    assert rows_of(changes.upsert_delete_append(stored, arriving, "id")) == expected
    assert rows_of(changes.upsert_latest(None, arriving, ["id"], ["v"])) == [(2, "new"), (3, "new")]
    assert changes.upsert_delete_append(None, arriving, "id") is arriving


def test_lookup_takes_the_last_and_leaves_absent_null(frame):
    games = frame([("A",), ("B",), ("Z",)], "team string")
    names = frame([("A", 1), ("A", 9), ("B", 2)], "name string, id int")
    assert rows_of(J.map_lookup(games, "team", names, "name", "id", "team_id", ["id"])) == [("A", 9), ("B", 2), ("Z", None)]


def test_fallback(frame):
    df = frame([("a",), ("b",), ("c",)], "tag string")
    current, everyone = frame([("a", 1), ("b", None)], "tag string, team int"), frame([("b", 2), ("a", 7)], "tag string, team int")
    found = J.lookup_with_fallback(df, [(current, "tag", "tag", "team"), (everyone, "tag", "tag", "team")], "team_id")
    assert rows_of(found) == [("a", 1), ("b", 2), ("c", None)]


def test_positional_names_and_equal_names(frame):
    df = frame([(1, 2, 3)], "a int, b int, c int")
    assert rename_positions(df, first=["x"], last=["z"]).columns == ["x", "b", "z"]
    twice = df.select("a", F.col("b").alias("a"), "c")
    assert rows_of(keep_first_of_equal_names(twice)) == [(1, 3)]


def test_sentinels(frame):
    df = frame([("1",), ("nan",), ("None",), (None,)], "v string")
    assert rows_of(filters.keep_not_sentinel(df, "v")) == [("1",)]
    assert filters.null_sentinels(df, ["v"]).where("v IS NULL").count() == 3


def test_scaling_of_a_constant_is_zero(frame):
    df = frame([(1.0, 7.0), (3.0, 7.0)], "a double, b double")
    assert rows_of(stats.fit_minmax(df, ["a", "b"]).apply(df)) == [(0.0, 0.0), (1.0, 0.0)]
    assert rows_of(stats.fit_standard(df, ["a", "b"]).apply(df)) == [(-1.0, 0.0), (1.0, 0.0)]


def test_correlation_uses_complete_pairs_and_guards_constants(frame):
    df = frame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, None, 5.0), (4.0, 7.0, 5.0)], "a double, b double, c double")
    found = {(r[0], r[1]): r[2] for r in stats.correlation_rows(df, ["a", "b", "c"]).collect()}
    assert found[("a", "b")] == found[("b", "a")] == pytest.approx(0.99717646, abs=1e-6)
    assert found[("a", "c")] is None and found[("c", "c")] is None and found[("a", "a")] == pytest.approx(1.0)
    assert stats.low_correlation_features(df, ["a", "c"], "b") == []
    assert stats.zero_variance_features(df, ["a", "c"]) == ["c"]


@pytest.mark.parametrize("f, df1, df2, p", [
    # Table values of the F distribution at 5 % and 1 %.
    (4.965, 1, 10, 0.05), (3.885, 2, 12, 0.05), (2.711, 5, 20, 0.05), (8.285, 2, 9, 0.009), (1.0, 7, 7, 0.5)])
def test_f_tail(f, df1, df2, p):
    assert stats.f_distribution_tail(f, df1, df2) == pytest.approx(p, abs=3e-4)


def test_anova(frame):
    rows = [("a", v) for v in (6.0, 8.0, 4.0, 5.0, 3.0, 4.0)] + [("b", v) for v in (8.0, 12.0, 9.0, 11.0, 6.0, 8.0)] \
        + [("c", v) for v in (13.0, 9.0, 11.0, 8.0, 7.0, 12.0)] + [("c", None)]
    f, between, within, p = stats.anova_oneway(frame(rows, "g string, v double"), "g", "v").first()
    assert (round(f, 1), between, within) == (9.3, 2, 15) and p == pytest.approx(0.0024, abs=2e-4)


def test_anova_without_inner_freedom(frame):
    row = stats.anova_oneway(frame([("a", 1.0), ("b", 2.0)], "g string, v double"), "g", "v").first()
    assert row["f_statistic"] is None and row["p_value"] is None


def test_ols_simple(frame):
    df = frame([(float(i), 2.0 * i + 1.0) for i in range(5)] + [(9.0, None)], "x double, y double")
    slope, intercept, r2 = stats.ols_simple(df, "y", "x").first()
    assert (slope, intercept, r2) == (pytest.approx(2.0), pytest.approx(1.0), pytest.approx(1.0))


def test_weighted_score(frame):
    df = frame([("s", 2.0, 3.0), ("t", 2.0, 3.0)], "role string, a double, b double")
    weights = frame([("s", 0.5, 1.0), ("t", 1.0, 0.0)], "role string, a double, b double")
    assert {r["role"]: r["score"] for r in stats.weighted_score(df, "role", weights, ["a", "b"], "score").collect()} == {
        "s": 4.0, "t": 2.0}


@pytest.mark.parametrize(("first", "second"), [(50, 50), (50, 7), (3, 40), (0, 4), (0, 0)])
def test_side_by_side_under_any_split(spark, tmp_path, first, second):
    def store(name, n, files):
        path = str(tmp_path / name)
        spark.range(n).select(F.col("id").alias(name), F.lit("x" * 100).alias(f"{name}_text")).repartitionByRange(files, name).sortWithinPartitions(name).write.parquet(path)
        return spark.read.parquet(path).select(name)

    left, right = store("a", first, 4), store("b", second, 3)
    wanted = sorted(((i if i < first else None, i if i < second else None) for i in range(max(first, second))), key=repr)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128MB", "200"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            assert sorted((tuple(r) for r in J.side_by_side(left, right).collect()), key=repr) == wanted
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_side_by_side_needs_different_columns(small, spark):
    with pytest.raises(ValueError, match="r_name"):
        J.side_by_side(spark.read.parquet(f"{small}/region.parquet"), spark.read.parquet(f"{small}/region.parquet"))
