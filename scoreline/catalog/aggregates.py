"""Grouped summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregate as A
from . import views
from .registry import query

# The roles that are counted per team, and their column names.
ROLES = {"AUTOMOBILE": "automobile", "BUILDING": "building", "FURNITURE": "furniture",
         "HOUSEHOLD": "household", "MACHINERY": "machinery"}

views.add_view("fx_composition", """
  SELECT team_id, min(name) AS team_name,
         CAST(sum(CASE WHEN role = 'AUTOMOBILE' THEN 1 ELSE 0 END) AS BIGINT) AS automobile,
         CAST(sum(CASE WHEN role = 'BUILDING' THEN 1 ELSE 0 END) AS BIGINT) AS building,
         CAST(sum(CASE WHEN role = 'FURNITURE' THEN 1 ELSE 0 END) AS BIGINT) AS furniture,
         CAST(sum(CASE WHEN role = 'HOUSEHOLD' THEN 1 ELSE 0 END) AS BIGINT) AS household,
         CAST(sum(CASE WHEN role = 'MACHINERY' THEN 1 ELSE 0 END) AS BIGINT) AS machinery
  FROM fx_roster GROUP BY team_id""")


@query("agg_mean_by_keys", """
SELECT team_id, season, round(avg(kills), 6) + 0.0 AS kills, round(avg(deaths), 6) + 0.0 AS deaths,
       round(avg(objective), 6) + 0.0 AS objective, round(avg(maps), 6) + 0.0 AS maps
FROM fx_player_season GROUP BY team_id, season""")
def agg_mean_by_keys(t):
    metrics = ["kills", "deaths", "objective", "maps"]
    means = A.mean_by_keys(t.player_seasons, ["team_id", "season"], metrics)
    return means.withColumns({m: F.round(m, 6) for m in metrics})


@query("agg_mean_single", """
SELECT team_id, round(avg(acctbal), 4) + 0.0 AS mean_balance FROM fx_roster GROUP BY team_id""")
def agg_mean_single(t):
    means = A.mean_by_keys(t.roster, ["team_id"], {"acctbal": "mean_balance"})
    return means.withColumn("mean_balance", F.round("mean_balance", 4))


@query("agg_first_by_key", """
SELECT team_id, min(name) AS team_name, CAST(count(*) AS BIGINT) AS players FROM fx_roster GROUP BY team_id""")
def agg_first_by_key(t):
    sizes = t.roster.groupBy("team_id", "name").agg(F.count(F.lit(1)).alias("players"))
    return A.constant_by_key(sizes, ["team_id"], {"name": "team_name", "players": "players"})


@query("agg_mode", """
SELECT o_custkey, o_orderpriority AS priority FROM (
  SELECT o_custkey, o_orderpriority, row_number() OVER (
    PARTITION BY o_custkey ORDER BY count(*) DESC, o_orderpriority) AS rn
  FROM orders GROUP BY o_custkey, o_orderpriority) x WHERE rn = 1""")
def agg_mode(t):
    return A.mode_by_key(t.orders, ["o_custkey"], "o_orderpriority", "priority")


@query("agg_named_mixed", """
SELECT p.player_id, assigned_role, average_kills, average_death, average_objective_time FROM (
  SELECT player_id, round(avg(kills), 6) + 0.0 AS average_kills, round(avg(deaths), 6) + 0.0 AS average_death,
         round(avg(objective), 6) + 0.0 AS average_objective_time FROM fx_player_season GROUP BY player_id) p
JOIN (SELECT player_id, CAST(maps AS INT) AS assigned_role, row_number() OVER (
        PARTITION BY player_id ORDER BY count(*) DESC, maps) AS rn
      FROM fx_player_season GROUP BY player_id, maps) m ON m.player_id = p.player_id AND rn = 1""")
def agg_named_mixed(t):
    rows = t.player_seasons.withColumn("maps", F.col("maps").cast("int"))
    means = {"kills": "average_kills", "deaths": "average_death", "objective": "average_objective_time"}
    mixed = A.mode_and_means(rows, ["player_id"], "maps", "assigned_role", means)
    return mixed.withColumns({r: F.round(r, 6) for r in means.values()})


@query("agg_count_pivot", """
SELECT team_id, automobile, building, furniture, household, machinery FROM fx_composition""")
def agg_count_pivot(t):
    return A.count_pivot(t.roster, ["team_id"], "role", ROLES)


@query("agg_column_sums", """
SELECT round(sum(kills) / 3.0, 4) + 0.0 AS kills, round(sum(deaths) / 3.0, 4) + 0.0 AS deaths FROM fx_player_season""")
def agg_column_sums(t):
    sums = A.column_sums(t.player_seasons, ["kills", "deaths"], 3)
    return sums.withColumns({c: F.round(c, 4) for c in sums.columns})


@query("agg_min_max", """
SELECT 'kills' AS column_name, min(kills) AS min, max(kills) AS max FROM fx_player_season
UNION ALL SELECT 'maps', min(maps), max(maps) FROM fx_player_season""")
def agg_min_max(t):
    return A.min_max_rows(t.player_seasons, ["kills", "maps"])


@query("agg_group_values", """
SELECT role, kills, CAST(count(*) AS BIGINT) AS n FROM fx_player_season GROUP BY role, kills""")
def agg_group_values(t):
    return A.group_values(t.player_seasons, ["role"], "kills")


@query("agg_count_distinct", "SELECT CAST(count(DISTINCT winner_id) AS BIGINT) AS classes FROM fx_match")
def agg_count_distinct(t):
    return A.count_distinct(t.matches, "winner_id", "classes")


@query("agg_win_probability", """
SELECT team_1_id, season, round(avg(CASE WHEN winner_id = team_1_id THEN 1.0 ELSE 0.0 END), 6) + 0.0 AS team_1_win_prob
FROM fx_match WHERE winner_id IS NOT NULL GROUP BY team_1_id, season""")
def agg_win_probability(t):
    decided = t.matches.where(F.col("winner_id").isNotNull())
    shares = A.share_by_key(decided, ["team_1_id", "season"], F.col("winner_id") == F.col("team_1_id"), "team_1_win_prob")
    return shares.withColumn("team_1_win_prob", F.round("team_1_win_prob", 6))


@query("agg_team_record", "SELECT team_id, season, mw, ml, round(mw_pct, 6) + 0.0 AS mw_pct FROM fx_team_season")
def agg_team_record(t):
    return t.team_seasons.withColumn("mw_pct", F.round("mw_pct", 6))


