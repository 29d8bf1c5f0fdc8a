"""Scaling, correlation, tests, regression, roles and ranks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import map_values
from ..models import train
from ..operators import stats as S
from ..operators.aggregate import mode_and_means
from ..plans import teams
from ..storage import settle
from . import views
from .registry import query
from .scalars import ROLE_NAMES

_METRICS = ["kills", "deaths", "objective", "maps"]

# The weight of each statistic by role.
ROLE_WEIGHTS = [
    ("AUTOMOBILE", 0.5, 0.25, 0.25),
    ("BUILDING", 0.25, 0.5, 0.25),
    ("FURNITURE", 0.25, 0.25, 0.5),
    ("HOUSEHOLD", 0.5, 0.125, 0.375),
    ("MACHINERY", 0.375, 0.125, 0.5),
]

views.add_view("fx_weights", "SELECT * FROM (VALUES " + ", ".join(
    f"('{r}', CAST({a} AS DOUBLE), CAST({b} AS DOUBLE), CAST({c} AS DOUBLE))" for r, a, b, c in ROLE_WEIGHTS)
    + ") AS w(role, w_kills, w_deaths, w_objective)")
views.add_view("fx_scored", """
  SELECT player_id, season, team_id, p.role,
         kills * w_kills + deaths * w_deaths + objective * w_objective AS weighted_score
  FROM fx_player_season p JOIN fx_weights w ON w.role = p.role""")


def _rounded(df, names, digits=6):
    return df.withColumns({n: F.round(n, digits) for n in names})


def _scaled_sql(column, over="()"):
    return (f"round(({column} - min({column}) OVER {over}) / "
            f"nullif(max({column}) OVER {over} - min({column}) OVER {over}, 0), 6) + 0.0 AS {column}")


@query("stat_minmax_scale", f"""
SELECT player_id, season, {', '.join(_scaled_sql(m) for m in _METRICS)}, CAST(0.0 AS DOUBLE) AS constant
FROM fx_player_season""")
def stat_minmax_scale(t):
    rows = settle(t.player_seasons.select("player_id", "season", *_METRICS, F.lit(7.0).alias("constant")))
    names = [*_METRICS, "constant"]
    return _rounded(S.fit_minmax(rows, names).apply(rows), names)


@query("stat_minmax_apply", """
SELECT player_id, round((kills - lo) / (hi - lo), 6) + 0.0 AS kills FROM fx_player_season,
  (SELECT min(kills) AS lo, max(kills) AS hi FROM fx_player_season WHERE season < 2001) b WHERE season = 2001""")
def stat_minmax_apply(t):
    rows = settle(t.player_seasons.select("player_id", "season", "kills"))
    fitted = S.fit_minmax(rows.where(F.col("season") < 2001), ["kills"])
    return _rounded(fitted.apply(rows.where(F.col("season") == 2001)).drop("season"), ["kills"])


@query("stat_standardise", """
SELECT player_id, season, round((kills - avg(kills) OVER ()) / stddev_pop(kills) OVER (), 6) + 0.0 AS kills,
       round((maps - avg(maps) OVER ()) / stddev_pop(maps) OVER (), 6) + 0.0 AS maps FROM fx_player_season""")
def stat_standardise(t):
    rows = settle(t.player_seasons.select("player_id", "season", "kills", "maps"))
    return _rounded(S.fit_standard(rows, ["kills", "maps"]).apply(rows), ["kills", "maps"])


@query("stat_unstandardise", "SELECT player_id, season, kills, maps FROM fx_player_season")
def stat_unstandardise(t):
    rows = settle(t.player_seasons.select("player_id", "season", "kills", "maps"))
    scaling = S.fit_standard(rows, ["kills", "maps"])
    return _rounded(scaling.invert(scaling.apply(rows)), ["kills", "maps"])


@query("stat_corr_matrix", "\nUNION ALL ".join(
    f"SELECT '{a}' AS column_1, '{b}' AS column_2, round(corr({a}, {b}), 6) + 0.0 AS correlation FROM fx_player_season"
    for a in _METRICS for b in _METRICS))
def stat_corr_matrix(t):
    return _rounded(S.correlation_rows(t.player_seasons, _METRICS), ["correlation"])


@query("stat_corr_with_target", "\nUNION ALL ".join(
    f"SELECT '{m}' AS feature, round(corr({m}, kills), 6) + 0.0 AS correlation FROM fx_player_season"
    for m in ("deaths", "objective", "maps")) + "\nUNION ALL SELECT 'constant', NULL")
def stat_corr_with_target(t):
    rows = t.player_seasons.withColumn("constant", F.lit(1.0))
    return _rounded(S.target_correlation_rows(rows, ["deaths", "objective", "maps", "constant"], "kills"), ["correlation"])


@query("stat_drop_low_corr", "SELECT player_id, season, kills, deaths, objective, maps FROM fx_player_season")
def stat_drop_low_corr(t):
    # The number of a team says nothing about kills.
    rows = settle(t.player_seasons.select("player_id", "season", "kills", "deaths", "objective", "maps", "team_id"))
    dropped = S.low_correlation_features(rows, ["deaths", "objective", "maps", "team_id"], "kills", 0.15)
    return rows.drop(*dropped)


@query("stat_drop_low_variance", "SELECT l_orderkey, l_quantity, l_discount, l_tax FROM lineitem")
def stat_drop_low_variance(t):
    features = ["l_quantity", "l_discount", "l_tax", "constant"]
    rows = t.lineitem.withColumn("constant", F.lit(1.0)).select("l_orderkey", *features)
    return rows.drop(*S.zero_variance_features(rows, features))


@query("stat_anova_oneway", """
SELECT round((ssb / (k - 1)) / (ssw / (n - k)), 6) + 0.0 AS f_statistic,
       CAST(k - 1 AS BIGINT) AS df_between, CAST(n - k AS BIGINT) AS df_within
FROM (SELECT sum(gn) AS n, count(*) AS k, sum(gn * (gm - total) * (gm - total)) AS ssb, sum(gn * gv) AS ssw
      FROM (SELECT role, count(*) AS gn, avg(kills) AS gm, var_pop(kills) AS gv FROM fx_player_season GROUP BY role) g,
           (SELECT avg(kills) AS total FROM fx_player_season) a) s""")
def stat_anova_oneway(t):
    return _rounded(S.anova_oneway(t.player_seasons, "role", "kills").drop("p_value"), ["f_statistic"])


@query("stat_anova_p_value")
def stat_anova_p_value(t):
    return S.anova_oneway(t.player_seasons, "role", "kills")


def ols_sql(view, y, x1, x2):
    """Least squares with two predictors in closed form."""
    return f"""
WITH s AS (SELECT count(*)::DOUBLE AS n, avg({x1}) AS m1, avg({x2}) AS m2, avg({y}) AS my,
    var_pop({x1}) * count(*) AS s11, var_pop({x2}) * count(*) AS s22, var_pop({y}) * count(*) AS syy,
    covar_pop({x1}, {x2}) * count(*) AS s12, covar_pop({x1}, {y}) * count(*) AS s1y,
    covar_pop({x2}, {y}) * count(*) AS s2y FROM {view}),
b AS (SELECT *, s11 * s22 - s12 * s12 AS det, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
             (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM s),
e AS (SELECT *, (syy - b1 * s1y - b2 * s2y) / (n - 3) AS v, (b1 * s1y + b2 * s2y) / syy AS r2 FROM b),
terms AS (
  SELECT '{x1}' AS term, b1 AS c, sqrt(v * s22 / det) AS se, r2 FROM e
  UNION ALL SELECT '{x2}', b2, sqrt(v * s11 / det), r2 FROM e
  UNION ALL SELECT 'const', my - b1 * m1 - b2 * m2,
                   sqrt(v * (1 / n + (m1 * m1 * s22 - 2 * m1 * m2 * s12 + m2 * m2 * s11) / det)), r2 FROM e)
SELECT term, round(c, 5) + 0.0 AS coefficient, round(se, 5) + 0.0 AS std_error, round(c / se, 3) + 0.0 AS t_value,
       round(r2, 6) + 0.0 AS r2 FROM terms"""


def rounded_ols(fit):
    return _rounded(_rounded(_rounded(fit.drop("p_value"), ["coefficient", "std_error"], 5), ["t_value"], 3), ["r2"])


@query("stat_ols", ols_sql("fx_player_season", "kills", "deaths", "objective"))
def stat_ols(t):
    return rounded_ols(train.ols(settle(t.player_seasons.select("kills", "deaths", "objective")), "kills", ["deaths", "objective"]))


@query("stat_ols_simple", """
SELECT round(regr_slope(kills, deaths), 6) + 0.0 AS slope, round(regr_intercept(kills, deaths), 6) + 0.0 AS intercept,
       round(regr_r2(kills, deaths), 6) + 0.0 AS r2 FROM fx_player_season""")
def stat_ols_simple(t):
    return _rounded(S.ols_simple(t.player_seasons, "kills", "deaths"), ["slope", "intercept", "r2"])


def _player_rates(t):
    rates = {f"{m}_pm": F.try_divide(m, "maps") for m in ("kills", "deaths", "objective")}
    return settle(t.player_seasons.withColumns(rates))


@query("stat_kmeans_roles")
def stat_kmeans_roles(t):
    rows, centres = train.kmeans_roles(_player_rates(t), ["kills_pm", "deaths_pm", "objective_pm"])
    centres = centres.withColumnsRenamed({c: f"centre_{c}" for c in ("kills_pm", "deaths_pm", "objective_pm")})
    return rows.join(centres, "role_cluster").select("player_id", "season", "role_cluster", "centre_kills_pm",
                                                     "centre_deaths_pm", "centre_objective_pm")


@query("stat_kmeans_facts", """
SELECT player_id, season, TRUE AS is_nearest, TRUE AS is_mean FROM fx_player_season WHERE maps <> 0""")
def stat_kmeans_facts(t):
    """What SQL can tell of clusters: every row with numbers is in one, its centre is the nearest in standard units and the mean of its members."""
    names = ["kills_pm", "deaths_pm", "objective_pm"]
    rates = _player_rates(t)
    rows, centres = train.kmeans_roles(rates, names)
    scaling, rows = S.fit_standard(rates, names), settle(rows)
    known = {r["role_cluster"]: r for r in centres.collect()}

    def distance(number):
        return sum(((F.col(n) - F.lit(known[number][n])) / F.lit(scaling.scale[n])) ** 2 for n in names)

    least = F.least(*[distance(n) for n in known])
    own = F.coalesce(*[F.when(F.col("role_cluster") == n, distance(n)) for n in known])
    means = rows.groupBy("role_cluster").agg(*[F.avg(n).alias(f"mean_{n}") for n in names])
    # The search ends when no centre moves by 1e-4.
    close = F.lit(True)
    for n in names:
        close &= F.abs(F.col(n) - F.col(f"mean_{n}")) < 1e-3 * scaling.scale[n]
    near = settle(centres.join(means, "role_cluster").select("role_cluster", close.alias("is_mean")))
    return rows.join(near, "role_cluster").select("player_id", "season", (own <= least * (1 + 1e-9)).alias("is_nearest"), "is_mean")


_MEANS = {"kills": "average_kills", "deaths": "average_death", "objective": "average_objective_time"}


@query("stat_role_assign", """
WITH marked AS (SELECT *, CASE WHEN kills >= 2 * objective THEN 0 WHEN kills >= objective THEN 1 ELSE 2 END AS c
                FROM fx_player_season)
SELECT a.player_id, CAST(c AS INT) AS assigned_role, average_kills, average_death, average_objective_time,
       CASE c WHEN 0 THEN 'Slayer' WHEN 1 THEN 'Support' ELSE 'Objective Player' END AS role
FROM (SELECT player_id, round(avg(kills), 6) + 0.0 AS average_kills, round(avg(deaths), 6) + 0.0 AS average_death,
             round(avg(objective), 6) + 0.0 AS average_objective_time FROM marked GROUP BY player_id) a
JOIN (SELECT player_id, c, row_number() OVER (PARTITION BY player_id ORDER BY count(*) DESC, c) AS rn
      FROM marked GROUP BY player_id, c) m ON m.player_id = a.player_id AND rn = 1""")
def stat_role_assign(t):
    kills, objective = F.col("kills"), F.col("objective")
    marked = t.player_seasons.withColumn("cluster", F.when(kills >= 2 * objective, 0).when(kills >= objective, 1).otherwise(2))
    return _rounded(_named_roles(marked, "cluster"), _MEANS.values())


def _named_roles(rows, cluster):
    players = mode_and_means(rows, ["player_id"], cluster, "assigned_role", _MEANS)
    return players.withColumn("role", map_values(F.col("assigned_role"), ROLE_NAMES))


@query("stat_role_assign_kmeans")
def stat_role_assign_kmeans(t):
    rows, _ = train.kmeans_roles(_player_rates(t), ["kills_pm", "deaths_pm", "objective_pm"])
    return _named_roles(rows, "role_cluster")


_SCORED = ["kills", "deaths", "objective"]


def role_weights(t):
    return t.spark.createDataFrame(ROLE_WEIGHTS, "role string, kills double, deaths double, objective double")


@query("stat_weighted_score", "SELECT player_id, season, role, weighted_score FROM fx_scored")
def stat_weighted_score(t):
    return S.weighted_score(t.player_seasons, "role", role_weights(t), _SCORED, "weighted_score").select(
        "player_id", "season", "role", "weighted_score")


@query("stat_player_rank", f"""
SELECT player_id, season, weighted_score,
       CAST(floor(rank() OVER (ORDER BY weighted_score DESC)
            + (count(*) OVER (PARTITION BY weighted_score) - 1) / 2.0) AS BIGINT) AS rank,
       {_scaled_sql('weighted_score').replace('AS weighted_score', 'AS normalized_score')}
FROM fx_scored""")
def stat_player_rank(t):
    ranked = teams.player_ranks(t.player_seasons, "role", role_weights(t), _SCORED)
    return _rounded(ranked.select("player_id", "season", "weighted_score", "rank", "normalized_score"), ["normalized_score"])


