"""Flows on hand-made frames, and the physical plans."""

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from scoreline.models import boosting, search
from scoreline.catalog.registry import QUERIES, Tables, oracles
from scoreline.operators import joins, order, sample
from scoreline.models import train
from scoreline.plans import features, seasons, teams, winner
from scoreline.storage import settle

ROWS_ONLY = sorted(set(QUERIES) - set(oracles()))


def plan_of(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture
def teams_table(frame):
    return frame([(1, 2024, 3.0), (2, 2024, 1.0), (3, 2024, 2.0)], "team_id int, season int, mw double")


@pytest.fixture
def played(frame):
    return frame([(10, 2024, 1, 2, 3.0, 1.0, 1), (11, 2024, 2, 1, 0.0, 3.0, 1), (12, 2024, 1, 3, 1.0, 3.0, 3),
                  (13, 2023, 1, 2, 3.0, 0.0, 1), (14, 2024, 1, 2, 1.0, 1.0, None)],
                 "match_id int, season int, team_1_id int, team_2_id int, team_1_score double, team_2_score double, winner_id int")


def test_match_features(played, teams_table):
    table, scaling = features.match_features(played, teams_table, ["mw"], swap_share=0.0)
    assert rows_of(table.select("match_id", "label", "mw_diff")) == [(10, 0, 1.0), (11, 1, 0.0), (12, 1, 0.75)]
    assert scaling.shift == {"mw_diff": -2.0} and scaling.scale == {"mw_diff": 4.0}


def test_matches_are_counted_before_teams_join(frame, teams_table):
    """A row per season, pair of teams, label and part, whatever the number of matches; fits and scaling are those of all matches."""
    kinds = [(2024, 1, 2, 1), (2024, 2, 1, 1), (2024, 1, 3, 3), (2024, 3, 2, None), (2023, 1, 2, 1), (None, 1, 2, 2), (2024, 1, 2, 2)]
    matches = frame([(i, *kinds[i % 7][:3], 1.0, 0.0, kinds[i % 7][3]) for i in range(700)],
                    "match_id int, season int, team_1_id int, team_2_id int, team_1_score double, team_2_score double, winner_id int")
    table, scaling = features.match_features(matches, teams_table, ["mw"], swap_share=0.0, test_percent=20)
    counted, same = features.pairing_features(matches, teams_table, ["mw"], 20, train.COPIES)
    keys = ["year", "label", "is_test", "mw_diff"]
    assert counted.count() == 8 and scaling == same
    assert rows_of(counted.groupBy(*keys).agg(F.sum("copies"))) == rows_of(table.groupBy(*keys).count())
    merged = [train.merged_input(rows, ["mw_diff"], ["label"]).select("label", "features", "copies", "copies_weight") for rows in (table, counted)]
    assert rows_of(merged[0]) == rows_of(merged[1]) and merged[1].agg(F.sum("copies")).first()[0] == 400


def test_mirrored_matches_flip_the_label(played, teams_table):
    table, _ = features.match_features(played, teams_table, ["mw"], swap_share=1.0)
    both = {(r["match_id"], r["swapped"]): r for r in table.collect()}
    assert len(both) == 6
    for match in (10, 11, 12):
        a, b = both[(match, 0)], both[(match, 1)]
        assert a["label"] + b["label"] == 1 and a["mw_diff"] + b["mw_diff"] == pytest.approx(1.0)
        assert (a["team_1_score"], a["team_2_score"]) == (b["team_2_score"], b["team_1_score"])


def test_noisy_rows_are_added(played, teams_table):
    table, _ = features.match_features(played, teams_table, ["mw"], swap_share=1.0, noise_share=0.5)
    assert table.count() == 9 and table.where("noisy = 1").count() == 3


def test_coming_games_without_averages_are_null(frame, played, teams_table):
    _, scaling = features.match_features(played, teams_table, ["mw"], swap_share=0.0)
    names = frame([("A", 1), ("B", 2), ("B", 9)], "name string, id int")
    games = frame([(1, "A", "A", 2024), (2, "A", "B", 2024), (3, "A", "Z", 2024)], "game_id int, team_1_name string, team_2_name string, season int")
    assert rows_of(features.coming_features(games, names, teams_table, ["mw"], scaling)) == [
        (1, 2024, 1, 1, 0.5), (2, 2024, 1, 9, None), (3, 2024, 1, None, None)]


def test_roster_standings_fallback(frame):
    names = frame([(1, "A"), (2, "B")], "id int, name string")
    standings = frame([("A", 3, "75.00%"), ("B", 1, "25%")], "team string, mw int, mw_pct string")
    current = frame([("x", 1)], "tag string, team_id int")
    everyone = frame([("x", 2), ("y", 2)], "tag string, team_id int")
    statistics = frame([("x", 9.0), ("y", 8.0), ("z", 7.0)], "tag string, kills double")
    found = teams.roster_standings(standings, names, current, everyone, statistics, ["mw_pct"])
    assert rows_of(found.select("tag", "team_id", "name", "mw_pct")) == [("x", 1, "A", 0.75), ("y", 2, "B", 0.25)]


def test_team_comparison(frame):
    roster = frame([(1, "A", "Slayer"), (1, "A", "Slayer"), (2, "B", "Slayer"), (2, "B", "Slayer"), (3, "C", "Support")],
                   "team_id int, name string, role string")
    record = frame([(1, 0.5), (2, 0.7), (3, 0.1)], "team_id int, mw_pct double")
    found = teams.team_comparison(roster, record, ["team_id"], "role", {"Slayer": "slayer", "Support": "support"},
                                  {"name": "team_name"}, "mw_pct")
    rows = {r["team_id"]: r for r in found.collect()}
    assert rows[1]["role_composition"] == "2-0" and rows[1]["composition_win_rate"] == pytest.approx(0.6)
    assert rows[3]["composition_win_rate"] == pytest.approx(0.1) and rows[3]["team_name"] == "C"


def test_latest_rows_are_pruned_before_the_shuffle(spark, small):
    t = Tables(spark, small)
    plan = plan_of(order.latest_n(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], 3))
    assert "row_number(), 3, Partial" in plan
    assert "row_number(), 1, Partial" in plan_of(order.keep_one(t.orders, ["o_custkey"], ["o_orderkey"]))


def test_sampling_is_a_filter(spark, small):
    plan = plan_of(sample.sample_n(Tables(spark, small).orders, 100, 42, ["o_orderkey"]))
    assert "Exchange" not in plan and "Sort" not in plan


@pytest.mark.parametrize("name", ["flow_match_features", "join_role_playing", "flow_role_matchup", "win_rank_average_desc",
                                  "ml_stratified_folds", "eval_roc_auc", "flt_or_either_side", "stat_minmax_scale"])
def test_no_cross_join(name, spark, small):
    df = QUERIES[name](spark, small)
    df.collect()
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_small_settled_tables_are_broadcast_by_size(spark, small):
    plan = plan_of(QUERIES["join_role_playing"](spark, small))
    assert plan.count("BroadcastHashJoin") >= 2


def test_large_sides_are_joined_by_shuffle(spark, small):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES["join_role_playing"](spark, small)
        assert "SortMergeJoin" in plan_of(df)
        shuffled = rows_of(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert shuffled == rows_of(QUERIES["join_role_playing"](spark, small))


@pytest.fixture
def short_fits(monkeypatch):
    """Fewer rounds and trees of the searches and boosted fits, whose full sizes take minutes."""
    for grid, sizes in ((search.BOOSTED_SETTINGS, {"rounds": [8]}), (search.VOTE_SETTINGS, {"trees": [2, 4, 8], "rounds": [2, 4, 8]})):
        for name, values in sizes.items():
            monkeypatch.setitem(grid, name, values)
    go_on = boosting.Fit.go_on
    monkeypatch.setattr(boosting.Fit, "go_on", lambda self, rounds, patience=None: go_on(self, min(rounds, 4), patience))


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_queries_give_rows(name, spark, small, short_fits):
    df = QUERIES[name](spark, small)
    assert df.count() > 0
    for column, kind in df.dtypes:
        if "prob" in column and kind == "double":
            assert df.where(f"{column} < 0 OR {column} > 1").count() == 0


@pytest.mark.parametrize("name", ["flow_match_features", "ml_stratified_folds", "win_rank_average_desc", "sample_n_seeded"])
def test_same_rows_for_any_number_of_partitions(name, spark, small):
    found = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for number in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", number)
        found.append(rows_of(QUERIES[name](spark, small)))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]


def test_rolling_form_divides_by_the_real_number_of_matches(frame):
    sides = frame([(1, 10, 1), (1, 11, 2), (1, 12, 3), (1, 13, 4), (2, 10, 1)], "team_id int, match_id int, played_at int")
    lines = frame([(10, 7, 100.0, 1), (11, 7, 3.0, 1), (12, 7, 4.0, 2), (13, 8, 1.0, 3), (13, 9, 5.0, 0)],
                  "match_id int, player_id int, r double, r_games int")
    found = rows_of(seasons.rolling_form(sides, lines, ["r"]))
    assert found == [(1, 0.888), (2, 100.0)]


def test_copies_of_a_match_stay_on_one_side(frame):
    rows = [(m, c, float(m % 7), m % 2) for m in range(200) for c in range(3)]
    table = frame(rows, "match_id int, copy int, x double, label int")
    _, scored = winner.train_and_hold(table, ["x"], train.forest(trees=2, depth=2), "label", ["match_id"], 20)
    sides = scored.groupBy("match_id").agg(F.count_distinct("is_test").alias("n")).where("n > 1").count()
    assert sides == 0 and 0 < scored.where("is_test = 1").count() < 600
    report = {r["class"]: r for r in winner.held_out_report(scored, "label").collect()}
    assert set(report) == {"0", "1", "macro avg", "weighted avg"}
    assert {r["part"] for r in winner.accuracy_by_part(scored, "label").collect()} == {"training", "held out"}


def test_a_hot_key_is_split_by_the_join(spark, frame):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        # One team plays in most of the matches; the matches come from several files.
        matches = settle(spark.range(400000).select(
            F.col("id").alias("match_id"), F.lit(2024).alias("season"),
            F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 1000).cast("int").alias("team_1_id"),
            (F.col("id") % 977).cast("int").alias("team_2_id")).repartition(16))
        dimension = spark.range(1000).select(F.col("id").cast("int").alias("team_id"), F.lit(2024).alias("season"),
                                             F.col("id").cast("double").alias("mw"))
        joined = joins.role_playing_join(matches, dimension, ["team_id", "season"], {"team1": ["team_1_id", "season"]}, ["mw"])
        assert joined.where("mw_team1 = team_1_id").count() == 400000
        joined.write.format("noop").mode("overwrite").save()
        counted = joined.groupBy().agg(F.sum(F.hash("match_id", "mw_team1")))
        counted.collect()
        assert "skew=true" in plan_of(counted)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_matches_and_players_come_from_one_read_of_the_lines(spark, small):
    """The same rows as by a read each; lines of unknown parts count for the match, not for the player."""
    t = Tables(spark, small)
    t.__dict__["part"] = t.part.where("p_partkey % 7 <> 0")
    t.__dict__["customer"] = t.customer.where("c_custkey % 11 <> 0")
    assert rows_of(t.played_matches) == rows_of(t.matches)
    assert rows_of(t.played_seasons) == rows_of(t.player_seasons)
