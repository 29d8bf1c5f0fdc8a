"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numbers as N
from ..functions import text as X
from ..operators.aggregate import count_pivot
from ..operators.columns import cast_columns, on_text_columns
from ..operators.order import category_codes
from ..operators.sample import pairwise_difference
from .aggregates import ROLES
from .registry import query


@query("fn_str_prefix", "SELECT o_orderkey, substr(strftime(o_orderdate, '%Y-%m'), 1, 4) AS season FROM orders")
def fn_str_prefix(t):
    return t.orders.select("o_orderkey", X.prefix(F.date_format("o_orderdate", "yyyy-MM"), 4).alias("season"))


@query("fn_regex_year", """
SELECT page_id, nullif(regexp_extract(url, '[0-9]+', 0), '') AS digits,
       nullif(regexp_extract(url, '[0-9]{4}', 0), '') AS year FROM pages""")
def fn_regex_year(t):
    url = F.col("url")
    return t.pages.select("page_id", X.first_match(url, "[0-9]+").alias("digits"), X.first_match(url).alias("year"))


@query("fn_split_part", "SELECT page_id, split_part(split_part(url, '://', 2), '/', 1) AS host FROM pages")
def fn_split_part(t):
    return t.pages.select("page_id", X.between(F.col("url"), "://", "/").alias("host"))


@query("fn_replace_text", """
SELECT p_partkey, replace(p_name, ' ', '-') AS name, replace(p_brand, '#', ' ') AS brand FROM part""")
def fn_replace_text(t):
    return t.part.select("p_partkey", X.replace_text(F.col("p_name"), {" ": " ", " ": "-"}).alias("name"),
                         X.replace_text(F.col("p_brand"), {"#": " "}).alias("brand"))


@query("fn_strip_thousands", """
SELECT o_orderkey, CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS total,
       replace(o_orderpriority, '-', '') AS priority FROM orders""")
def fn_strip_thousands(t):
    text = t.orders.select("o_orderkey", F.format_number(F.floor("o_totalprice"), 0).alias("total"),
                           F.replace("o_orderpriority", F.lit("-"), F.lit(",")).alias("priority"))
    return on_text_columns(text, N.strip_thousands)


@query("fn_percent_to_ratio", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_discount, 6) + 0.0 AS share FROM lineitem""")
def fn_percent_to_ratio(t):
    text = F.concat(F.format_string("%.2f", F.col("l_discount") * 100), F.lit("%"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                             F.round(N.percent_to_ratio(text), 6).alias("share"))


@query("fn_cast_dict", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(c_nationkey AS DOUBLE) AS c_nationkey, c_name FROM customer""")
def fn_cast_dict(t):
    return cast_columns(t.customer.select("c_custkey", "c_nationkey", "c_name"),
                        {"c_custkey": "string", "c_nationkey": "double"})


@query("fn_coerce_numeric", """
SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS DOUBLE) END AS size FROM part""")
def fn_coerce_numeric(t):
    mixed = F.when(F.col("p_size") % 2 == 0, F.col("p_size").cast("string")).when(
        F.col("p_size") % 3 == 0, F.lit("nan")).otherwise(F.col("p_name"))
    return t.part.select("p_partkey", N.coerce_numeric(mixed).alias("size"))


@query("fn_trunc_decimals", """
SELECT o_orderkey, sign(x) * floor(abs(x) * 1000) / 1000 AS cut
FROM (SELECT o_orderkey, (o_totalprice - 250000) / 7 AS x FROM orders) o""")
def fn_trunc_decimals(t):
    return t.orders.select("o_orderkey", N.trunc_decimals((F.col("o_totalprice") - 250000) / 7, 3).alias("cut"))


@query("fn_date_format", "SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS rundate FROM orders")
def fn_date_format(t):
    return t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("rundate"))


@query("fn_concat_key", """
SELECT team_id, automobile || '-' || building || '-' || furniture || '-' || household || '-' || machinery
       AS role_composition FROM fx_composition""")
def fn_concat_key(t):
    counts = count_pivot(t.roster, ["team_id"], "role", ROLES)
    return counts.select("team_id", X.concat_key(*[F.col(c) for c in ROLES.values()]).alias("role_composition"))


# The names of the numbered roles.
ROLE_NAMES = {0: "Slayer", 1: "Support", 2: "Objective Player"}


@query("fn_map_values", """
SELECT c_custkey, CASE c_nationkey % 4 WHEN 0 THEN 'Slayer' WHEN 1 THEN 'Support' WHEN 2 THEN 'Objective Player' END
       AS role FROM customer""")
def fn_map_values(t):
    return t.customer.select("c_custkey", X.map_values(F.col("c_nationkey") % 4, ROLE_NAMES).alias("role"))


@query("fn_where_choose", """
SELECT match_id, CAST(CASE WHEN team_1_score > team_2_score THEN 0 ELSE 1 END AS INT) AS winner_pred FROM fx_match""")
def fn_where_choose(t):
    return t.matches.select("match_id", N.choose_greater(F.col("team_1_score"), F.col("team_2_score")).alias("winner_pred"))


@query("fn_label_from_equality", """
SELECT match_id, CAST(CASE WHEN winner_id = team_2_id THEN 1 ELSE 0 END AS INT) AS label FROM fx_match""")
def fn_label_from_equality(t):
    return t.matches.select("match_id", N.equality_label(F.col("winner_id"), F.col("team_2_id")).alias("label"))


@query("fn_per_map_rate", """
SELECT player_id, season, round(kills / nullif(maps, 0), 6) + 0.0 AS kills_pm,
       round(deaths / nullif(maps, 0), 6) + 0.0 AS deaths_pm, objective FROM fx_player_season""")
def fn_per_map_rate(t):
    maps = F.col("maps")
    return t.player_seasons.select(
        "player_id", "season", F.round(N.ratio(F.col("kills"), maps), 6).alias("kills_pm"),
        F.round(N.ratio(F.col("deaths"), maps), 6).alias("deaths_pm"), "objective")


@query("fn_sum_then_rate", """
SELECT player_id, season, round((kills + objective) / nullif(deaths - maps, 0), 6) + 0.0 AS rate FROM fx_player_season""")
def fn_sum_then_rate(t):
    rate = N.sum_then_rate([F.col("kills"), F.col("objective")], F.col("deaths") - F.col("maps"))
    return t.player_seasons.select("player_id", "season", F.round(rate, 6).alias("rate"))


@query("fn_pairwise_diff", "SELECT match_id, team_1_score - team_2_score AS score_diff FROM fx_match")
def fn_pairwise_diff(t):
    named = t.matches.withColumnsRenamed({"team_1_score": "score_team1", "team_2_score": "score_team2"})
    return pairwise_difference(named, ["score"], keep=["match_id"])


@query("fn_clip", """
SELECT o_orderkey, greatest(0.0::DOUBLE, least(1.0::DOUBLE, (o_totalprice - 100000) / 300000)) AS share FROM orders""")
def fn_clip(t):
    return t.orders.select("o_orderkey", N.clip((F.col("o_totalprice") - 100000) / 300000).alias("share"))


@query("fn_argmax", """
SELECT player_id, season, CAST(list_position([kills, objective, deaths * 20], greatest(kills, objective, deaths * 20)) - 1
       AS INT) AS best FROM fx_player_season""")
def fn_argmax(t):
    return t.player_seasons.select(
        "player_id", "season", N.argmax(F.col("kills"), F.col("objective"), F.col("deaths") * 20).alias("best"))


@query("fn_category_codes", """
SELECT o_orderkey, o_orderpriority, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS BIGINT) AS code,
       CAST(dense_rank() OVER (ORDER BY year(o_orderdate)) - 1 AS BIGINT) AS season_code FROM orders""")
def fn_category_codes(t):
    rows = t.orders.select("o_orderkey", "o_orderpriority", F.year("o_orderdate").alias("season"))
    coded = category_codes(category_codes(rows, "o_orderpriority", "code"), "season", "season_code")
    return coded.drop("season")


