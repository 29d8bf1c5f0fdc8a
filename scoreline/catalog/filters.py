"""Filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import filters as flt
from .registry import query

# A column with missing numbers is a double on both sides.
_MATCH = ["match_id", "team_1_id", "team_2_id", "CAST(winner_id AS DOUBLE) AS winner_id"]


@query("flt_not_null", """
SELECT match_id, team_1_id, team_2_id, CAST(winner_id AS DOUBLE) AS winner_id
FROM fx_match WHERE winner_id IS NOT NULL""")
def flt_not_null(t):
    return flt.keep_present(t.matches.selectExpr(*_MATCH), "winner_id")


@query("flt_is_null", """
SELECT match_id, team_1_id, team_2_id, CAST(winner_id AS DOUBLE) AS winner_id
FROM fx_match WHERE winner_id IS NULL""")
def flt_is_null(t):
    return flt.keep_missing(t.matches.selectExpr(*_MATCH), "winner_id")


@query("flt_sentinel", """
SELECT match_id, CAST(winner_id AS VARCHAR) AS winner_text, CAST(winner_id AS INT) AS winner_id FROM fx_match
WHERE winner_id IS NOT NULL""")
def flt_sentinel(t):
    landed = t.matches.select("match_id", F.coalesce(F.col("winner_id").cast("string"), F.lit("nan")).alias("winner_text"))
    kept = flt.keep_not_sentinel(landed, "winner_text")
    typed = flt.null_sentinels(kept.withColumn("winner_id", F.col("winner_text")), ["winner_id"])
    return typed.withColumn("winner_id", F.col("winner_id").cast("int"))


@query("flt_equals", """
SELECT match_id, team_1_id, team_2_id, CAST(winner_id AS DOUBLE) AS winner_id
FROM fx_match WHERE status = 'F' AND season = 2000""")
def flt_equals(t):
    return flt.keep_equal(t.matches, {"status": "F", "season": 2000}).selectExpr(*_MATCH)


@query("flt_or_either_side", """
SELECT match_id, team_1_id, team_2_id, CAST(winner_id AS DOUBLE) AS winner_id
FROM fx_match WHERE team_1_id = 7 OR team_2_id = 7""")
def flt_or_either_side(t):
    return flt.keep_either_side(t.matches.selectExpr(*_MATCH), ["team_1_id", "team_2_id"], 7)


@query("flt_not_regex", "SELECT c_custkey, c_name FROM customer WHERE NOT regexp_matches(c_name, '13|7$')")
def flt_not_regex(t):
    return flt.drop_matching(t.customer.select("c_custkey", "c_name"), "c_name", "13|7$")


@query("flt_in_keys", """
SELECT id, tag, team_id FROM fx_roster WHERE team_id IN (SELECT team_1_id FROM fx_match WHERE status = 'O' AND season = 2001)""")
def flt_in_keys(t):
    coming = t.matches.where((F.col("status") == "O") & (F.col("season") == 2001))
    return flt.keep_keys(t.roster.select("id", "tag", "team_id"), "team_id", coming, "team_1_id")


@query("flt_drop_any_null", """
SELECT o_orderkey, o_custkey, quantity FROM orders JOIN fx_lines ON l_orderkey = o_orderkey
WHERE quantity IS NOT NULL AND o_custkey IS NOT NULL""")
def flt_drop_any_null(t):
    joined = t.orders.join(t.line_totals, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return flt.drop_any_null(joined.select("o_orderkey", "o_custkey", "quantity"))


@query("flt_distinct", "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def flt_distinct(t):
    return flt.distinct_rows(t.customer, "c_nationkey", "c_mktsegment")


