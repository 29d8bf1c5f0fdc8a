"""Projections and column shaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import clean_name, snake_name
from ..operators import columns as C
from .registry import query


@query("proj_select", "SELECT c_custkey, c_mktsegment FROM customer")
def proj_select(t):
    return C.select_columns(t.customer, ["c_custkey", "c_mktsegment"])


@query("proj_rename",
       "SELECT o_orderkey AS match_id, o_custkey AS team_id, o_totalprice FROM orders")
def proj_rename(t):
    return C.rename(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"),
                    {"o_orderkey": "match_id", "o_custkey": "team_id", "not_there": "x"})


@query("proj_drop_lenient", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def proj_drop_lenient(t):
    return C.drop_lenient(t.orders, ["o_totalprice", "o_orderpriority", "o_orderdate", "not_there"])


@query("proj_rename_positional", """
SELECT s_suppkey AS rank, s_name AS player_name, s_nationkey, s_acctbal AS year FROM supplier""")
def proj_rename_positional(t):
    return C.rename_positions(t.supplier, first=["rank", "player_name"], last=["year"])


@query("proj_normalise_names", """
SELECT o_orderkey AS "S_DWin%", o_custkey AS "OverallKD", o_totalprice AS "s_d_win_pct",
       o_orderstatus AS "hp_diff" FROM orders""")
def proj_normalise_names(t):
    # Both naming rules over one table, each for half of its columns.
    def rule(name):
        return snake_name(name[5:]) if name.startswith("snake") else clean_name(name)

    return C.normalise_names(t.orders.select(
        F.col("o_orderkey").alias("S&D Win %"), F.col("o_custkey").alias("Overall K/D"),
        F.col("o_totalprice").alias("snakeS&D Win %"), F.col("o_orderstatus").alias("snakeHP +/-")), rule)


@query("proj_dedupe_columns", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def proj_dedupe_columns(t):
    doubled = t.orders.select("o_orderkey", "o_custkey", F.lit(-1).alias("o_orderkey"), "o_totalprice",
                              F.lit(-2).alias("o_custkey"))
    return C.keep_first_of_equal_names(doubled)


@query("proj_align_features",
       "SELECT match_id, team_2_score, team_1_score FROM fx_match")
def proj_align_features(t):
    return C.align_features(t.matches, ["team_2_score", "team_1_score"], keep=["match_id"])


@query("proj_numeric_columns", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def proj_numeric_columns(t):
    return C.select_numeric(t.orders)


@query("proj_constant", """
SELECT s_suppkey, CAST(2001 AS INT) AS year, '20010801' AS rundate FROM supplier""")
def proj_constant(t):
    return C.add_constants(t.supplier.select("s_suppkey"), {"year": 2001, "rundate": "20010801"})


@query("proj_swap_suffix", """
SELECT match_id, team_2_id AS team_1_id, team_1_id AS team_2_id, team_2_score AS team_1_score,
       team_1_score AS team_2_score, CAST(winner_id AS DOUBLE) AS winner_id FROM fx_match""")
def proj_swap_suffix(t):
    return C.swap_sides(t.matches.select(
        "match_id", "team_1_id", "team_2_id", "team_1_score", "team_2_score",
        F.col("winner_id").cast("double").alias("winner_id")))
