"""Whole tables: match features, rosters, comparisons, matchups and chart rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import map_values
from ..models.train import ols
from ..operators.aggregate import mean_by_keys, mode_and_means, sides_to_rows
from ..operators.order import category_codes
from ..operators.sample import add_noisy, add_swapped
from ..operators.stats import anova_oneway
from ..plans import charts, features, seasons, teams
from ..storage import settle
from . import views
from .registry import query
from .statistics import ols_sql, role_weights, rounded_ols

# The per-map rates, the metrics of a team and the roles of a lineup.
RATES = {"kills_pm": ("kills", "maps"), "deaths_pm": ("deaths", "maps"), "objective_pm": ("objective", "maps")}
RECORD = ["mw", "ml", "mw_pct"]
METRICS = [*RECORD, *RATES]
LINEUP_ROLES = {"Objective Player": "objective_player", "Slayer": "slayer", "Support": "support"}
SEGMENT_ROLES = {"AUTOMOBILE": "Slayer", "BUILDING": "Slayer", "FURNITURE": "Support", "HOUSEHOLD": "Support",
                 "MACHINERY": "Objective Player"}

views.add_view("fx_team", """
  SELECT s.team_id, s.season, CAST(mw AS DOUBLE) AS mw, CAST(ml AS DOUBLE) AS ml, mw_pct, kills_pm, deaths_pm, objective_pm
  FROM fx_team_season s LEFT JOIN (
    SELECT team_id, season, avg(kills / nullif(maps, 0)) AS kills_pm, avg(deaths / nullif(maps, 0)) AS deaths_pm,
           avg(objective / nullif(maps, 0)) AS objective_pm FROM fx_player_season GROUP BY team_id, season) p
  ON p.team_id = s.team_id AND p.season = s.season""")
views.add_view("fx_pair", """
  SELECT match_id, m.season, team_1_id, team_2_id, team_1_score, team_2_score, winner_id, """ + ", ".join(
    f"a.{m} AS {m}_team1, b.{m} AS {m}_team2" for m in METRICS) + """
  FROM fx_match m JOIN fx_team a ON a.team_id = team_1_id AND a.season = m.season
                  JOIN fx_team b ON b.team_id = team_2_id AND b.season = m.season
  WHERE winner_id IS NOT NULL""")
views.add_view("fx_swapped", """
  SELECT match_id, season, team_1_id, team_2_id, team_1_score, team_2_score, winner_id, 0 AS swapped, """ + ", ".join(
    f"{m}_team1, {m}_team2" for m in METRICS) + """ FROM fx_pair
  UNION ALL
  SELECT match_id, season, team_2_id, team_1_id, team_2_score, team_1_score, winner_id, 1, """ + ", ".join(
    f"{m}_team2, {m}_team1" for m in METRICS) + """ FROM (SELECT * FROM fx_pair
    QUALIFY row_number() OVER (ORDER BY md5('42|' || CAST(match_id AS VARCHAR))) <= floor(0.5 * count(*) OVER ())) s""")
views.add_view("fx_diff", """
  SELECT match_id, season, swapped, team_1_score, team_2_score,
         CASE WHEN winner_id = team_2_id THEN 1 ELSE 0 END AS label, """ + ", ".join(
    f"{m}_team1 - {m}_team2 AS {m}_diff" for m in METRICS) + " FROM fx_swapped")
views.add_view("fx_lineup", """
  SELECT player_id, tag, team_id, player_id // 100 AS squad, season, kills, deaths, objective,
         CASE WHEN role IN ('AUTOMOBILE', 'BUILDING') THEN 'Slayer'
              WHEN role IN ('FURNITURE', 'HOUSEHOLD') THEN 'Support' ELSE 'Objective Player' END AS role
  FROM fx_player_season""")
_ROLE_COUNTS = ", ".join(f"CAST(sum(CASE WHEN role = '{r}' THEN 1 ELSE 0 END) AS BIGINT) AS {c}" for r, c in LINEUP_ROLES.items())
views.add_view("fx_comparison", f"""
  SELECT c.team_id, c.squad, c.season, n_name AS team_name, objective_player, slayer, support, mw_pct AS match_win_percent,
         objective_player || '-' || slayer || '-' || support AS role_composition
  FROM (SELECT team_id, squad, season, {_ROLE_COUNTS} FROM fx_lineup GROUP BY team_id, squad, season) c
  JOIN fx_team_season s ON s.team_id = c.team_id AND s.season = c.season JOIN nation ON n_nationkey = c.team_id""")
views.add_view("fx_team_roles", f"""
  SELECT c.team_id, c.season, objective_player, slayer, support, mw_pct AS match_win_percent
  FROM (SELECT team_id, season, {_ROLE_COUNTS} FROM fx_lineup GROUP BY team_id, season) c
  JOIN fx_team_season s ON s.team_id = c.team_id AND s.season = c.season""")
views.add_view("fx_ranked", """
  SELECT team_id, season, avg(CAST(floor(r + (ties - 1) / 2.0) AS BIGINT)) AS avg_team_rank FROM (
    SELECT team_id, season, rank() OVER (ORDER BY weighted_score DESC) AS r,
           count(*) OVER (PARTITION BY weighted_score) AS ties FROM fx_scored) x GROUP BY team_id, season""")

_DIFFS = features.difference_names(METRICS)


def _rounded(df, names, digits=6):
    return df.withColumns({n: F.round(n, digits) for n in names})


def team_features(t):
    """The written table of team metrics per season."""
    return settle(features.team_table(t.played_seasons, views.team_seasons(t.played_matches), ["team_id", "season"], RATES, RECORD), "teams")


def training_features(t, swap_share=0.5, noise_share=0.0, test_percent=None):
    return features.match_features(t.played_matches, team_features(t), METRICS, swap_share, noise_share, test_percent=test_percent)


@query("flow_match_features", """
SELECT match_id, season AS year, swapped, team_1_score, team_2_score, label, """ + ", ".join(
    f"round(({d} - min({d}) OVER ()) / nullif(max({d}) OVER () - min({d}) OVER (), 0), 6) + 0.0 AS {d}" for d in _DIFFS)
    + " FROM fx_diff")
def flow_match_features(t):
    table, _ = training_features(t)
    return _rounded(table, _DIFFS)


def noise_sql(scale, key_text):
    """The SQL of ``hash_gaussian`` with seed 42; ``key_text`` continues the text that is hashed."""
    digest = f"md5('42|{key_text})"
    u1 = f"((CAST(('0x' || substr({digest}, 1, 12)) AS BIGINT) + 0.5::DOUBLE) / 281474976710656.0::DOUBLE)"
    u2 = f"((CAST(('0x' || substr({digest}, 13, 12)) AS BIGINT) + 0.5::DOUBLE) / 281474976710656.0::DOUBLE)"
    return f"{scale}::DOUBLE * sqrt(-2.0::DOUBLE * ln({u1})) * cos(2.0::DOUBLE * pi() * {u2})"


def _noise_sql(column, scale, key="CAST(match_id AS VARCHAR)"):
    return noise_sql(scale, f"' || {key} || '|{column}'")


_SWAPPED_KEY = "CAST(match_id AS VARCHAR) || '|' || CAST(swapped AS VARCHAR)"

views.add_view("fx_noisy_diff", """
  SELECT match_id, season, swapped, 0 AS noisy, label, """ + ", ".join(_DIFFS) + """ FROM fx_diff
  UNION ALL
  SELECT match_id, season, swapped, 1, CASE WHEN winner_id = team_2_id THEN 1 ELSE 0 END, """ + ", ".join(
    f"({m}_team1 + {_noise_sql(m + '_team1', 0.08, _SWAPPED_KEY)}) - "
    f"({m}_team2 + {_noise_sql(m + '_team2', 0.08, _SWAPPED_KEY)})" for m in METRICS) + f"""
  FROM (SELECT * FROM fx_swapped QUALIFY row_number() OVER (ORDER BY md5('42|' || {_SWAPPED_KEY}))
        <= floor(0.25 * count(*) OVER ())) s""")


# A wide table: four measures of eight columns of a team's lines, beside the record, 35 metrics in all.
_LINE_COLUMNS = {"quantity": "l_quantity", "price": "l_extendedprice", "discount": "l_discount", "tax": "l_tax", "line": "l_linenumber",
                 "size": "p_size", "retail": "p_retailprice", "total": "o_totalprice"}
_MEASURES = {"mean": F.avg, "low": F.min, "high": F.max, "spread": F.stddev_pop}
_SQL_MEASURES = {"mean": "avg", "low": "min", "high": "max", "spread": "stddev_pop"}
WIDE = [*RECORD, *[f"{c}_{m}" for c in _LINE_COLUMNS for m in _MEASURES]]
_WIDE_DIFFS = features.difference_names(WIDE)
views.add_view("fx_wide", """
  SELECT s.team_id, s.season, CAST(mw AS DOUBLE) AS mw, CAST(ml AS DOUBLE) AS ml, mw_pct, """ + ", ".join(
    f"{c}_{m}" for c in _LINE_COLUMNS for m in _MEASURES) + """
  FROM fx_team_season s LEFT JOIN (
    SELECT c_nationkey AS team_id, CAST(year(o_orderdate) AS INT) AS season, """ + ", ".join(
    f"{f}(CAST({e} AS DOUBLE)) AS {c}_{m}" for c, e in _LINE_COLUMNS.items() for m, f in _SQL_MEASURES.items()) + """
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN part ON p_partkey = l_partkey
    GROUP BY c_nationkey, CAST(year(o_orderdate) AS INT)) p ON p.team_id = s.team_id AND p.season = s.season""")
views.add_view("fx_wide_pair", """
  SELECT match_id, m.season, CASE WHEN winner_id = team_2_id THEN 1 ELSE 0 END AS label,
         CASE WHEN winner_id = team_1_id THEN 1 ELSE 0 END AS swapped_label, """ + ", ".join(f"a.{m} - b.{m} AS {m}_diff" for m in WIDE) + """
  FROM fx_match m JOIN fx_wide a ON a.team_id = team_1_id AND a.season = m.season
                  JOIN fx_wide b ON b.team_id = team_2_id AND b.season = m.season
  WHERE winner_id IS NOT NULL""")
views.add_view("fx_wide_diff", """
  SELECT match_id, season, 0 AS swapped, label, """ + ", ".join(_WIDE_DIFFS) + """ FROM fx_wide_pair
  UNION ALL
  SELECT match_id, season, 1, swapped_label, """ + ", ".join(f"-{d}" for d in _WIDE_DIFFS) + """ FROM (SELECT * FROM fx_wide_pair
    QUALIFY row_number() OVER (ORDER BY md5('42|' || CAST(match_id AS VARCHAR))) <= floor(0.5 * count(*) OVER ())) s""")


@query("flow_wide_features", """
SELECT match_id, CAST(dense_rank() OVER (ORDER BY season) - 1 AS BIGINT) AS season_code, swapped, label, """ + ", ".join(
    f"round(coalesce(({d} - min({d}) OVER ()) / nullif(max({d}) OVER () - min({d}) OVER (), 0), 0), 6) + 0.0 AS {d}" for d in _WIDE_DIFFS)
    + " FROM fx_wide_diff")
def flow_wide_features(t):
    """The training table with 35 metrics and the season as a category."""
    matches = t.settled_matches
    lines = t.lineitem.join(t.part.select("p_partkey", "p_size", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey")).join(
        t.orders.select("o_orderkey", "o_custkey", "o_totalprice", F.year("o_orderdate").alias("season")), F.col("l_orderkey") == F.col("o_orderkey")).join(
        t.customer.select("c_custkey", F.col("c_nationkey").alias("team_id")), F.col("o_custkey") == F.col("c_custkey"))
    wide = lines.groupBy("team_id", "season").agg(*[
        f(F.col(e).cast("double")).alias(f"{c}_{m}") for c, e in _LINE_COLUMNS.items() for m, f in _MEASURES.items()])
    record = views.team_seasons(matches).select("team_id", "season", *[F.col(m).cast("double").alias(m) for m in RECORD])
    teams_table = settle(record.join(wide, ["team_id", "season"], "left"), "wide")
    table, _ = features.match_features(matches, teams_table, WIDE)
    coded = category_codes(table, "year", "season_code").drop("year", "team_1_score", "team_2_score")
    return _rounded(coded, _WIDE_DIFFS)


@query("flow_match_features_noisy", "SELECT match_id, season AS year, swapped, noisy, label, " + ", ".join(
    f"round(({d} - min({d}) OVER ()) / nullif(max({d}) OVER () - min({d}) OVER (), 0), 6) + 0.0 AS {d}" for d in _DIFFS)
    + " FROM fx_noisy_diff")
def flow_match_features_noisy(t):
    table, _ = training_features(t, noise_share=0.25)
    return _rounded(table.drop("team_1_score", "team_2_score"), _DIFFS)


@query("aug_team_swap", """
SELECT match_id, swapped, team_1_id, team_2_id, team_1_score, team_2_score, winner_id, mw_team1, mw_team2 FROM fx_swapped""")
def aug_team_swap(t):
    paired = features.paired_matches(
        t.played_matches.where(F.col("winner_id").isNotNull()), team_features(t), METRICS,
        ["match_id", "team_1_id", "team_2_id", "team_1_score", "team_2_score", "winner_id", "season"],
        {"team1": ["team_1_id", "season"], "team2": ["team_2_id", "season"]}, ["team_id", "season"])
    return add_swapped(paired, 0.5, 42, ["match_id"]).select(
        "match_id", "swapped", "team_1_id", "team_2_id", "team_1_score", "team_2_score", "winner_id", "mw_team1", "mw_team2")


@query("aug_gaussian_noise", f"""
SELECT match_id, 0 AS noisy, team_1_score, team_2_score FROM fx_match
UNION ALL
SELECT match_id, 1, round(team_1_score + {_noise_sql('team_1_score', 0.08)}, 6) + 0.0,
       round(team_2_score + {_noise_sql('team_2_score', 0.08)}, 6) + 0.0
FROM (SELECT * FROM fx_match QUALIFY row_number() OVER (ORDER BY md5('42|' || CAST(match_id AS VARCHAR)))
      <= floor(0.25 * count(*) OVER ())) s""")
def aug_gaussian_noise(t):
    names = ["team_1_score", "team_2_score"]
    noisy = add_noisy(t.settled_matches.select("match_id", *names), names, 0.25, 0.08, 42, ["match_id"])
    return _rounded(noisy, names)


@query("flow_roster_standings", """
SELECT p.player_id, p.tag, c.c_nationkey AS team_id, n_name AS name, p.kills, s.mw, s.ml,
       round(floor(s.mw_pct * 100) / 100, 6) + 0.0 AS mw_pct
FROM fx_player_season p JOIN customer c ON c.c_name = p.tag JOIN nation ON n_nationkey = c.c_nationkey
LEFT JOIN fx_team_season s ON s.team_id = c.c_nationkey AND s.season = 2001 WHERE p.season = 2001""")
def flow_roster_standings(t):
    names = t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    record = t.team_seasons.where(F.col("season") == 2001)
    standings = record.join(names, F.col("team_id") == F.col("id")).select(
        F.col("name").alias("team"), "mw", "ml",
        F.concat(F.floor(F.col("mw_pct") * 100).cast("string"), F.lit("%")).alias("mw_pct"))
    everyone = t.customer.select(F.col("c_name").alias("tag"), F.col("c_nationkey").alias("team_id"))
    # Players in debt are off the current roster; their team comes from the list of all players.
    current = t.customer.where(F.col("c_acctbal") >= 0).select(
        F.col("c_name").alias("tag"), F.col("c_nationkey").alias("team_id"))
    statistics = t.player_seasons.where(F.col("season") == 2001).select("player_id", "tag", "kills")
    rows = teams.roster_standings(standings, names, current, everyone, statistics, ["mw_pct"])
    return _rounded(rows, ["mw_pct"])


SQUAD = ["team_id", "squad", "season"]


def lineups(t):
    """All players of a team and season with the role's name.

    A nation has too many players for its composition to recur, so the players with numbers in
    the same hundred are a squad, of some four players at any size of the tables.
    """
    return t.player_seasons.withColumns({
        "squad": F.floor(F.col("player_id") / 100), "role": map_values(F.col("role"), SEGMENT_ROLES)})


def comparison(t, build=teams.team_comparison, keys=SQUAD, players=None, record=None):
    players = lineups(t) if players is None else players
    named = players.join(t.nation.select(F.col("n_nationkey").alias("team_id"), F.col("n_name").alias("name")), "team_id")
    record = (t.team_seasons if record is None else record).withColumnRenamed("mw_pct", "match_win_percent")
    return build(named, record, keys, "role", LINEUP_ROLES, {"name": "team_name"}, "match_win_percent")


@query("flow_team_comparison", """
SELECT team_id, squad, season, team_name, objective_player, slayer, support, role_composition,
       round(match_win_percent, 6) + 0.0 AS match_win_percent,
       round(avg(match_win_percent) OVER (PARTITION BY role_composition), 6) + 0.0 AS composition_win_rate
FROM fx_comparison""")
def flow_team_comparison(t):
    return _rounded(comparison(t), ["match_win_percent", "composition_win_rate"])


@query("flow_composition_anova", """
SELECT round((ssb / (k - 1)) / (ssw / (n - k)), 4) + 0.0 AS f_statistic,
       CAST(k - 1 AS BIGINT) AS df_between, CAST(n - k AS BIGINT) AS df_within
FROM (SELECT sum(gn) AS n, count(*) AS k, sum(gn * (gm - total) * (gm - total)) AS ssb, sum(gn * gv) AS ssw
      FROM (SELECT role_composition, count(*) AS gn, avg(match_win_percent) AS gm, var_pop(match_win_percent) AS gv
            FROM fx_comparison GROUP BY role_composition) g,
           (SELECT avg(match_win_percent) AS total FROM fx_comparison) a) s""")
def flow_composition_anova(t):
    rows = comparison(t, teams.team_rows)
    return _rounded(anova_oneway(rows, "role_composition", "match_win_percent").drop("p_value"), ["f_statistic"], 4)


@query("flow_composition_ols", ols_sql("fx_comparison", "match_win_percent", "slayer", "support"))
def flow_composition_ols(t):
    return rounded_ols(ols(settle(comparison(t, teams.team_rows)), "match_win_percent", ["slayer", "support"]))


@query("flow_role_matchup", """
SELECT match_id, CAST(winner_id AS DOUBLE) AS winner_id,
       CAST(a.objective_player - b.objective_player AS DOUBLE) AS objective_player_diff,
       CAST(a.slayer - b.slayer AS DOUBLE) AS slayer_diff, CAST(a.support - b.support AS DOUBLE) AS support_diff,
       round(a.match_win_percent - b.match_win_percent, 6) + 0.0 AS win_rate_diff,
       round(ra.avg_team_rank - rb.avg_team_rank, 6) + 0.0 AS team_rank_diff, team_1_score - team_2_score AS maps_won_diff
FROM fx_match m JOIN fx_team_roles a ON a.team_id = team_1_id AND a.season = m.season
JOIN fx_team_roles b ON b.team_id = team_2_id AND b.season = m.season
JOIN fx_ranked ra ON ra.team_id = team_1_id AND ra.season = m.season
JOIN fx_ranked rb ON rb.team_id = team_2_id AND rb.season = m.season
WHERE m.status = 'F' AND winner_id IS NOT NULL""")
def flow_role_matchup(t):
    seasons_of_players = settle(t.player_seasons, "players")
    players = seasons_of_players.select("team_id", "season", "role", "kills", "deaths", "objective")
    ranked = teams.player_ranks(players, "role", role_weights(t), ["kills", "deaths", "objective"], normalized=False)
    ranks = mean_by_keys(ranked, ["team_id", "season"], {"rank": "avg_team_rank"})
    played = t.settled_matches
    lineup = seasons_of_players.withColumn("role", map_values(F.col("role"), SEGMENT_ROLES))
    rows = comparison(t, teams.team_rows, ["team_id", "season"], lineup, views.team_seasons(played))
    table = settle(rows.join(ranks, ["team_id", "season"], "left"), "teams_with_ranks")
    matches = played.where(F.col("status") == "F").select(
        "match_id", "season", "team_1_id", "team_2_id", "team_1_score", "team_2_score", "winner_id")
    rows = teams.role_matchup(matches, table, ["team_id", "season"], list(LINEUP_ROLES.values()), "match_win_percent",
                              "avg_team_rank")
    return _rounded(rows, ["win_rate_diff", "team_rank_diff"])


_AVERAGES_SQL = """
SELECT player_id, avg(kills / nullif(maps, 0)) AS average_kills, avg(objective / nullif(maps, 0)) AS average_objective_time,
       min(role) AS role FROM fx_player_season GROUP BY player_id"""


def _player_averages(t):
    rates = features.per_map_rates(t.player_seasons, {"k": ("kills", "maps"), "o": ("objective", "maps")}, ["player_id", "role"])
    return mode_and_means(rates, ["player_id"], "role", "role", {"k": "average_kills", "o": "average_objective_time"})


@query("plot_role_scatter", f"""
SELECT player_id, c_name AS label, round(average_kills, 6) + 0.0 AS x, round(average_objective_time, 6) + 0.0 AS y, role
FROM ({_AVERAGES_SQL}) p JOIN customer ON c_custkey = player_id""")
def plot_role_scatter(t):
    players = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("tag"))
    rows = charts.scatter_rows(_player_averages(t), players, "average_kills", "average_objective_time", "role")
    return _rounded(rows, ["x", "y"])


@query("plot_axis_limits", f"""
SELECT round(min(average_kills) - 0.01, 6) + 0.0 AS x_min, round(max(average_kills) + 0.01, 6) + 0.0 AS x_max,
       round(min(average_objective_time) - 0.01, 6) + 0.0 AS y_min, round(max(average_objective_time) + 0.01, 6) + 0.0 AS y_max
FROM ({_AVERAGES_SQL}) p""")
def plot_axis_limits(t):
    limits = charts.axis_limits(_player_averages(t), "average_kills", "average_objective_time")
    return _rounded(limits, limits.columns)


@query("plot_composition_bars", """
SELECT role_composition, round(avg(match_win_percent), 6) + 0.0 AS win_rate FROM fx_comparison GROUP BY role_composition""")
def plot_composition_bars(t):
    return _rounded(charts.composition_bars(comparison(t, teams.team_rows), "match_win_percent"), ["win_rate"])


@query("flow_season_tables", """
SELECT replace(c_name, '#', ' ') AS "Overall_Player", CAST(c_nationkey AS VARCHAR) AS "Overall_KD",
       c_mktsegment AS "S_D_Role", CAST(2000 + c_custkey // 50 % 2 AS VARCHAR) AS year,
       CAST(CASE WHEN c_acctbal >= 0 THEN c_custkey END AS DOUBLE) AS id FROM customer""")
def flow_season_tables(t):
    # Pages of fifty players each, with a header of two levels and non-breaking blanks in the names.
    row = ("concat('<tr><td>', replace(r.c_name, '#', '&nbsp;'), '</td><td>', r.c_nationkey, '</td><td>', "
           "r.c_mktsegment, '</td></tr>')")
    packed = t.customer.groupBy(F.floor(F.col("c_custkey") / 50).alias("page")).agg(
        F.collect_list(F.struct("c_name", "c_nationkey", "c_mktsegment")).alias("rows"))
    pages = packed.select(
        F.concat(F.lit("https://stats.example/"), (F.col("page") % 2 + 2000).cast("string"), F.lit("_Season/"),
                 F.col("page").cast("string")).alias("url"),
        F.concat(F.lit("<table><tr><td>menu</td></tr></table><table><tr><th colspan='2'>Overall</th><th>S&amp;D</th></tr>"
                       "<tr><th>Player</th><th>K/D</th><th>Role</th></tr>"),
                 F.expr(f"array_join(transform(rows, r -> {row}), '')"), F.lit("</table>")).alias("html"))
    ids = t.customer.where(F.col("c_acctbal") >= 0).select(
        F.replace("c_name", F.lit("#"), F.lit(" ")).alias("tag"), F.col("c_custkey").cast("double").alias("id"))
    return seasons.season_tables(settle(pages, "pages"), "url", "html", 1, ids, "tag")


_RATINGS = {"rating": "l_quantity", "share": "l_discount", "burden": "l_tax"}


@query("flow_rolling_form", """
WITH sides AS (
  SELECT team_1_id AS team_id, match_id, played_at FROM fx_match UNION ALL SELECT team_2_id, match_id, played_at FROM fx_match),
last AS (
  SELECT team_id, match_id FROM sides
  QUALIFY row_number() OVER (PARTITION BY team_id ORDER BY played_at DESC, match_id DESC) <= 3),
players AS (SELECT team_id, l_suppkey, """ + ", ".join(
    f"sum({c})::DOUBLE / count(*) AS {r}" for r, c in _RATINGS.items()) + """
            FROM last JOIN lineitem ON l_orderkey = match_id GROUP BY team_id, l_suppkey),
teams AS (SELECT team_id, """ + ", ".join(f"sum({r}) AS {r}" for r in _RATINGS) + """ FROM players GROUP BY team_id),
played AS (SELECT team_id, count(*) AS matches FROM last GROUP BY team_id)
SELECT t.team_id, """ + ", ".join(f"floor(round({r} / matches, 9) * 1000) / 1000 AS {r}_avg" for r in _RATINGS) + """
FROM teams t JOIN played p ON p.team_id = t.team_id""")
def flow_rolling_form(t):
    """The form of both teams of a match over three ratings."""
    sides = sides_to_rows(t.matches, [{"team_id": "team_1_id"}, {"team_id": "team_2_id"}], keep=["match_id", "played_at"])
    lines = t.lineitem.select(F.col("l_orderkey").alias("match_id"), F.col("l_suppkey").alias("player_id"),
                              *[F.col(c).alias(r) for r, c in _RATINGS.items()], *[F.lit(1).alias(f"{r}_games") for r in _RATINGS])
    return seasons.rolling_form(sides, lines, list(_RATINGS))
