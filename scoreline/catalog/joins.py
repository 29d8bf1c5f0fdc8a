"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins as J
from ..operators.columns import cast_columns
from ..storage import settle
from . import views
from .registry import query

_RECORD = ["mw", "ml", "mw_pct"]


@query("join_inner_sql", """
SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def join_inner_sql(t):
    return J.join_on(t.customer, t.nation, {"c_nationkey": "n_nationkey"}).select("c_custkey", "c_name", "n_name")


@query("join_inner_merge", """
SELECT p.team_id, player_id, tag, kills, mw_pct, p.season
FROM fx_player_season p JOIN fx_team_season s ON p.team_id = s.team_id AND p.season = s.season""")
def join_inner_merge(t):
    return J.join_on(t.player_seasons, settle(t.team_seasons), ["team_id", "season"]).select(
        "team_id", "player_id", "tag", "kills", "mw_pct", "season")


@query("join_left", """
SELECT o_orderkey, o_custkey, quantity, CAST(lines AS DOUBLE) AS lines
FROM orders LEFT JOIN fx_lines ON l_orderkey = o_orderkey""")
def join_left(t):
    return J.join_on(t.orders, t.line_totals, {"o_orderkey": "l_orderkey"}, "left").select(
        "o_orderkey", "o_custkey", "quantity", F.col("lines").cast("double").alias("lines"))


@query("join_right", """
SELECT CAST(l_orderkey AS DOUBLE) AS l_orderkey, quantity, o_orderkey, o_totalprice
FROM fx_lines RIGHT JOIN orders ON l_orderkey = o_orderkey""")
def join_right(t):
    return J.join_on(t.line_totals, t.orders, {"l_orderkey": "o_orderkey"}, "right").select(
        F.col("l_orderkey").cast("double").alias("l_orderkey"), "quantity", "o_orderkey", "o_totalprice")


@query("join_composite_key", """
SELECT match_id, m.season, m.team_1_id, mw, ml FROM fx_match m
JOIN fx_team_season s ON m.team_1_id = s.team_id AND m.season = s.season""")
def join_composite_key(t):
    matches = t.settled_matches
    record = settle(views.team_seasons(matches).withColumnRenamed("season", "year"))
    return J.join_on(matches, record, {"team_1_id": "team_id", "season": "year"}).select(
        "match_id", "season", "team_1_id", "mw", "ml")


@query("join_role_playing", """
SELECT match_id, m.season, a.mw AS mw_team1, a.ml AS ml_team1, a.mw_pct AS mw_pct_team1,
       b.mw AS mw_team2, b.ml AS ml_team2, b.mw_pct AS mw_pct_team2
FROM fx_match m JOIN fx_team_season a ON a.team_id = team_1_id AND a.season = m.season
                JOIN fx_team_season b ON b.team_id = team_2_id AND b.season = m.season""")
def join_role_playing(t):
    matches = t.settled_matches
    return J.role_playing_join(
        matches.select("match_id", "season", "team_1_id", "team_2_id"), settle(views.team_seasons(matches)),
        ["team_id", "season"], {"team1": ["team_1_id", "season"], "team2": ["team_2_id", "season"]}, _RECORD,
    ).drop("team_1_id", "team_2_id")


@query("join_role_playing_left", """
SELECT match_id, m.season,
       CAST(a.mw AS DOUBLE) AS mw_team1, CAST(a.ml AS DOUBLE) AS ml_team1, a.mw_pct AS mw_pct_team1,
       CAST(b.mw AS DOUBLE) AS mw_team2, CAST(b.ml AS DOUBLE) AS ml_team2, b.mw_pct AS mw_pct_team2
FROM fx_match m LEFT JOIN fx_team_season a ON a.team_id = team_1_id AND a.season = m.season - 1
                LEFT JOIN fx_team_season b ON b.team_id = team_2_id AND b.season = m.season - 1
WHERE m.status = 'O'""")
def join_role_playing_left(t):
    # Coming games know the record of the season before; the first season has none.
    matches = t.settled_matches
    coming = matches.where(F.col("status") == "O").select(
        "match_id", "season", "team_1_id", "team_2_id", (F.col("season") - 1).alias("before"))
    record = cast_columns(views.team_seasons(matches), {"mw": "double", "ml": "double"})
    return J.role_playing_join(
        coming, settle(record), ["team_id", "season"],
        {"team1": ["team_1_id", "before"], "team2": ["team_2_id", "before"]}, _RECORD, "left",
    ).drop("team_1_id", "team_2_id", "before")


@query("join_map_lookup", """
SELECT o_orderkey, CAST(l_suppkey AS DOUBLE) AS last_supplier FROM orders LEFT JOIN (
  SELECT l_orderkey, l_suppkey FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_suppkey DESC) = 1) d
ON l_orderkey = o_orderkey""")
def join_map_lookup(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_suppkey").cast("double").alias("l_suppkey"))
    return J.map_lookup(t.orders.select("o_orderkey"), "o_orderkey", lines, "l_orderkey", "l_suppkey",
                        "last_supplier", ["l_linenumber", "l_suppkey"])


@query("join_fallback_coalesce", """
SELECT o_orderkey, COALESCE(s_nationkey, c_nationkey) AS team_id
FROM orders LEFT JOIN fx_lines ON l_orderkey = o_orderkey LEFT JOIN supplier ON s_suppkey = first_supplier
LEFT JOIN customer ON c_custkey = o_custkey""")
def join_fallback_coalesce(t):
    keyed = t.orders.select("o_orderkey", "o_custkey").join(
        t.line_totals.select("l_orderkey", "first_supplier"), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return J.lookup_with_fallback(
        keyed, [(t.supplier, "first_supplier", "s_suppkey", "s_nationkey"),
                (t.customer, "o_custkey", "c_custkey", "c_nationkey")], "team_id").select("o_orderkey", "team_id")


@query("join_positional", """
SELECT g.game_id, mw AS mw_team1, b.quantity AS quantity_team2
FROM fx_coming g JOIN nation ON n_name = team_1_name
LEFT JOIN fx_team_season s ON s.team_id = n_nationkey AND s.season = g.season
JOIN fx_lines b ON b.l_orderkey = g.game_id""")
def join_positional(t):
    # Two halves of the same games, side by side on the key of the game.
    matches = t.settled_matches
    games = views.coming_games(matches, t.nation)
    named = games.join(t.nation.select("n_nationkey", "n_name"), F.col("team_1_name") == F.col("n_name"))
    record = settle(views.team_seasons(matches)).select(
        "team_id", F.col("season").alias("year"), F.col("mw").alias("mw_team1"))
    first = J.join_on(named, record, {"n_nationkey": "team_id", "season": "year"}, "left").select("game_id", "mw_team1")
    second = games.join(t.line_totals, F.col("game_id") == F.col("l_orderkey")).select(
        "game_id", F.col("quantity").alias("quantity_team2"))
    return J.join_on(first, second, ["game_id"])


@query("join_side_by_side", """
SELECT o_orderkey, o_totalprice, c_custkey, c_acctbal FROM (SELECT o_orderkey, o_totalprice, row_number() OVER () AS n FROM orders) o
FULL JOIN (SELECT c_custkey, c_acctbal, row_number() OVER () AS n FROM customer) c USING (n)""")
def join_side_by_side(t):
    """Two tables without a common key, row by row in the order of their files."""
    return J.side_by_side(t.orders.select("o_orderkey", "o_totalprice"), t.customer.select("c_custkey", "c_acctbal"))


@query("join_index", """
SELECT m.match_id, CAST(m.winner_id AS DOUBLE) AS winner_id, o_totalprice FROM fx_match m JOIN orders ON o_orderkey = m.match_id""")
def join_index(t):
    prices = t.orders.select(F.col("o_orderkey").alias("match_id"), "o_totalprice")
    return J.join_on(t.matches.select("match_id", F.col("winner_id").cast("double").alias("winner_id")), prices, ["match_id"])


@query("join_anti_delete", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def join_anti_delete(t):
    returned = t.lineitem.where(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    return J.delete_arriving(t.orders.select("o_orderkey", "o_custkey"), returned, "o_orderkey")
