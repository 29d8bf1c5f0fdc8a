"""Ranks, latest rows, deduplication, upserts, sorts, samples and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import trunc_decimals
from ..operators import changes, order, sample
from ..operators.aggregate import sides_to_rows
from ..storage import settle
from .registry import query


@query("win_rank_average_desc", """
SELECT player_id, season, kills, CAST(floor(rank() OVER (ORDER BY kills DESC)
         + (count(*) OVER (PARTITION BY kills) - 1) / 2.0) AS BIGINT) AS rank FROM fx_player_season""")
def win_rank_average_desc(t):
    rows = settle(t.player_seasons.select("player_id", "season", "kills"), "players")
    return order.average_rank(rows, "kills", "rank")


_SIDES = [{"team_id": "team_1_id", "score": "team_1_score"}, {"team_id": "team_2_id", "score": "team_2_score"}]

_LATEST_SQL = """
SELECT team_id, match_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY team_id ORDER BY played_at DESC, match_id DESC) AS rn FROM (
    SELECT team_1_id AS team_id, match_id, played_at, team_1_score AS score FROM fx_match
    UNION ALL SELECT team_2_id, match_id, played_at, team_2_score FROM fx_match) s) r WHERE rn <= 3"""


def _latest_three(t):
    rows = sides_to_rows(t.matches, _SIDES, keep=["match_id", "played_at"])
    return order.latest_n(rows, ["team_id"], ["played_at", "match_id"], 3)


@query("win_latest_n_per_key", _LATEST_SQL)
def win_latest_n_per_key(t):
    return _latest_three(t).select("team_id", "match_id", "score")


@query("win_rolling_last_n_mean", f"""
SELECT team_id, trunc(avg(score) * 1000) / 1000 AS score_avg, CAST(count(*) AS BIGINT) AS games
FROM ({_LATEST_SQL}) l GROUP BY team_id""")
def win_rolling_last_n_mean(t):
    means = _latest_three(t).groupBy("team_id").agg(F.avg("score").alias("score_avg"), F.count("score").alias("games"))
    return means.withColumn("score_avg", trunc_decimals(F.col("score_avg"), 3))


_KEYED = """
SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INT) AS season, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderdate {0}, o_orderkey {0}) = 1"""


def _order_seasons(t):
    return t.orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("season"), "o_totalprice", "o_orderdate")


@query("dedupe_keep_first", _KEYED.format("ASC"))
def dedupe_keep_first(t):
    return order.keep_one(_order_seasons(t), ["o_custkey", "season"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("dedupe_keep_last", _KEYED.format("DESC"))
def dedupe_keep_last(t):
    return order.keep_one(_order_seasons(t), ["o_custkey", "season"], ["o_orderdate", "o_orderkey"],
                          keep="last").drop("o_orderdate")


# The stored table holds the orders up to 1999; those of 1999 and later arrive with a new status.
_UPSERT_SQL = """
SELECT o_orderkey, o_custkey, CASE WHEN year(o_orderdate) >= 1999 THEN 'new' ELSE o_orderstatus END AS o_orderstatus
FROM orders"""


def _stored_and_arriving(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", F.year("o_orderdate").alias("season"))
    stored = rows.where(F.col("season") <= 1999).drop("season")
    arriving = rows.where(F.col("season") >= 1999).drop("season").withColumn("o_orderstatus", F.lit("new"))
    return stored, arriving


@query("upsert_latest", _UPSERT_SQL)
def upsert_latest(t):
    return changes.upsert_latest(*_stored_and_arriving(t), ["o_orderkey"], ["o_orderstatus"])


@query("upsert_delete_append", _UPSERT_SQL)
def upsert_delete_append(t):
    return changes.upsert_delete_append(*_stored_and_arriving(t), "o_orderkey")


@query("sort_by", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def sort_by(t):
    return order.sort_rows(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"),
                           ["o_totalprice", "o_orderkey"], descending=["o_totalprice"])


@query("topk", """
SELECT player_id, sum(kills) AS kills FROM fx_player_season GROUP BY player_id
ORDER BY kills DESC, player_id LIMIT 10""")
def topk(t):
    totals = t.player_seasons.groupBy("player_id").agg(F.sum("kills").alias("kills"))
    return order.top_k(totals, ["kills", "player_id"], 10, descending=["kills"])


@query("sample_n_seeded", """
SELECT match_id, team_1_id, team_2_id FROM fx_match
QUALIFY row_number() OVER (ORDER BY md5('42|' || CAST(match_id AS VARCHAR))) <= floor(0.25 * count(*) OVER ())""")
def sample_n_seeded(t):
    return sample.sample_share(t.settled_matches.select("match_id", "team_1_id", "team_2_id"), 0.25, 42, ["match_id"])


@query("set_union_all", """
SELECT team_1_id AS team_id, match_id FROM fx_match UNION ALL SELECT team_2_id, match_id FROM fx_match""")
def set_union_all(t):
    matches = t.settled_matches
    return changes.union_all(matches.select(F.col("team_1_id").alias("team_id"), "match_id"),
                             matches.select("match_id", F.col("team_2_id").alias("team_id")))


@query("set_union_missing", """
SELECT c_custkey AS id, c_name AS tag, c_mktsegment AS role, CAST(NULL AS DOUBLE) AS balance FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""")
def set_union_missing(t):
    players = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("tag"),
                                F.col("c_mktsegment").alias("role"))
    teams = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("tag"),
                              F.col("s_acctbal").alias("balance"))
    return changes.union_filling(players, teams)
