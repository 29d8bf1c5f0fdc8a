"""Splits, models, evaluation and simulation.

The training table is the one of the flagship flow without mirrored rows; training rows
alone set the bounds of its scaling. Searches fit on ``search.FIT_ROWS`` labelled rows at most.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions.numbers import argmax, equality_label
from ..functions.seeded import hash_gaussian
from ..models import boosting, calibration, evaluate, search, simulate, split, train
from ..operators.joins import role_playing_join
from ..plans import features, teams, winner
from ..storage import settle
from . import views
from .flows import METRICS, flow_role_matchup, noise_sql, team_features, training_features
from .registry import query

_DIFFS = features.difference_names(METRICS)
_LABELLED = """
  SELECT match_id, season AS year, CAST(CASE WHEN winner_id = team_2_id THEN 1 ELSE 0 END AS INT) AS label
  FROM fx_match WHERE winner_id IS NOT NULL"""
views.add_view("fx_labelled", _LABELLED)


views.add_view("fx_raw_diff", """
  SELECT m.match_id, m.season, m.status, m.winner_id, """ + ", ".join(f"a.{m} - b.{m} AS {m}_diff" for m in METRICS) + """
  FROM fx_match m JOIN fx_team a ON a.team_id = team_1_id AND a.season = m.season
                  JOIN fx_team b ON b.team_id = team_2_id AND b.season = m.season""")


class Training:
    """Decided and coming matches as model inputs; ``counted`` takes a row per pairing for fits that read merged rows only."""

    def __init__(self, t, counted=False):
        self.matches = t.played_matches
        self.teams = team_features(t)
        self.nation = t.nation
        if counted:
            self.rows, self.scaling = features.pairing_features(self.matches, self.teams, METRICS, 20, train.COPIES)
        else:
            self.rows, self.scaling = features.match_features(self.matches, self.teams, METRICS, swap_share=0.0, test_percent=20)
        # No difference between the teams, in scaled units.
        self.neutral = {d: -self.scaling.shift[d] / self.scaling.scale[d] for d in _DIFFS if self.scaling.shift[d] is not None}

    def assembled(self, *keep, prepare=lambda rows: rows):
        """The input of fits; ``prepare`` adds the columns to keep."""
        return train.training_table(prepare(self.rows), _DIFFS, ["match_id"],
                                    ["match_id", "year", "label", "is_test", *keep], self.neutral)

    def merged(self, rows, weight=None):
        """The merged input of fits that take the number of their rows; the rows themselves are not written."""
        return train.merged_input(rows, _DIFFS, ["label"], self.neutral, weight)

    def model_input(self, rows):
        return train.model_input(rows, _DIFFS, self.neutral)

    def folded(self, folds):
        return self.assembled("fold", prepare=lambda rows: split.add_folds(rows, "label", folds, 42, ["match_id"]))

    def coming(self, last_season=False):
        games = views.coming_games(self.matches, self.nation)
        if last_season:
            games = games.where(F.col("season") == games.agg(F.max("season")).first()[0])
        names = self.nation.select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("id"))
        return settle(features.coming_features(games, names, self.teams, METRICS, self.scaling), "coming")

    def simulated(self, predict, prediction, **settings):
        """The votes of 15,000 draws for every coming game of the last season."""
        return simulate.by_pairing(
            self.coming(last_season=True), "game_id", ["team_1_id", "team_2_id", "season"], _DIFFS,
            lambda pairings, key: simulate.noise_ensemble(pairings, key, _DIFFS, lambda rows: predict(self.model_input(rows)), prediction, **settings))


def _labelled(t):
    decided = t.matches.where(F.col("winner_id").isNotNull())
    return settle(decided.select("match_id", F.col("season").alias("year"),
                                 equality_label(F.col("winner_id"), F.col("team_2_id")).alias("label")), "labelled")


@query("ml_train_test_split", """
SELECT match_id, label, CAST(CASE WHEN CAST(('0x' || substr(md5('42|' || CAST(match_id AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < 15
       THEN 1 ELSE 0 END AS INT) AS is_test FROM fx_labelled""")
def ml_train_test_split(t):
    return split.mark_test(_labelled(t), 15, 42, ["match_id"]).drop("year")


_PLACE = "row_number() OVER (PARTITION BY label ORDER BY md5('42|' || CAST(match_id AS VARCHAR)))"


@query("ml_split_stratified", f"""
SELECT match_id, label, CAST(CASE WHEN {_PLACE} <= floor(count(*) OVER (PARTITION BY label) * 0.2 + 0.5)
       THEN 1 ELSE 0 END AS INT) AS is_test FROM fx_labelled""")
def ml_split_stratified(t):
    return split.mark_test_stratified(_labelled(t), "label", 0.2, 42, ["match_id"]).drop("year")


@query("ml_stratified_folds", f"SELECT match_id, label, CAST(({_PLACE} - 1) % 5 AS INT) AS fold FROM fx_labelled")
def ml_stratified_folds(t):
    return split.add_folds(_labelled(t), "label", 5, 42, ["match_id"]).drop("year")


@query("ml_assemble", """
SELECT match_id, label, round(a.mw - b.mw, 9) + 0.0 AS first, round(a.objective_pm - b.objective_pm, 9) + 0.0 AS last,
       CAST(6 AS INT) AS size
FROM fx_labelled l JOIN fx_match m USING (match_id) JOIN fx_team a ON a.team_id = m.team_1_id AND a.season = m.season
JOIN fx_team b ON b.team_id = m.team_2_id AND b.season = m.season""")
def ml_assemble(t):
    work = Training(t)
    rows = train.assemble(work.scaling.invert(work.rows), _DIFFS).select(
        "match_id", "label", vector_to_array("features").alias("v"))
    return rows.select("match_id", "label", F.round(F.col("v")[0], 9).alias("first"),
                       F.round(F.element_at("v", -1), 9).alias("last"), F.size("v").alias("size"))


@query("ml_class_weights", """
SELECT match_id, label, round(count(*) OVER () / (2.0 * count(*) OVER (PARTITION BY label)), 6) + 0.0 AS weight
FROM fx_labelled""")
def ml_class_weights(t):
    return split.add_class_weights(_labelled(t), "label").drop("year").withColumn("weight", F.round("weight", 6))


def _parts(rows):
    return rows.where(F.col("is_test") == 0), rows.where(F.col("is_test") == 1)


def _weighted(work, *keep, prepare=lambda rows: rows):
    """The input of fits with balanced weights."""
    return work.assembled("weight", *keep, prepare=lambda rows: split.add_class_weights(prepare(rows), "label"))


_PREDICTED = ["match_id", "label", "prediction"]


@query("ml_rf_classifier")
def ml_rf_classifier(t):
    work = Training(t)
    fitted, held = _parts(split.add_class_weights(work.rows, "label"))
    model = train.fit_counted(train.forest(trees=50, depth=10), work.merged(fitted, "weight"), "weight")
    return model.transform(work.model_input(held)).select(*_PREDICTED, train.positive_probability().alias("probability"))


@query("ml_multiclass_winner")
def ml_multiclass_winner(t):
    work = Training(t)
    winners = work.matches.select("match_id", "winner_id")
    rows = work.assembled("winner_id", prepare=lambda rows: rows.join(winners, "match_id"))
    fitted, held = _parts(train.index_classes(rows, "winner_id", "winner"))
    return train.forest("winner", trees=50, depth=10).fit(fitted).transform(held).select("match_id", "winner", "prediction")


@query("ml_rf_regressor_multi")
def ml_rf_regressor_multi(t):
    return _regressed(Training(t))


def _regressed(work):
    fitted, held = _parts(work.assembled("team_1_score", "team_2_score"))
    for model in train.fit_regressors(fitted, ["team_1_score", "team_2_score"]).values():
        held = model.transform(held)
    return held.select("match_id", "team_1_score", "team_1_score_pred", "team_2_score", "team_2_score_pred")


_DECIDED = """fx_match m JOIN fx_team a ON a.team_id = team_1_id AND a.season = m.season JOIN fx_team b ON b.team_id = team_2_id AND b.season = m.season
  WHERE winner_id IS NOT NULL"""
_HELD = "CAST(('0x' || substr(md5('42|' || CAST(match_id AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < 20"


@query("ml_multiclass_facts", f"""
SELECT match_id, winner, TRUE AS is_class FROM (
  SELECT match_id, CAST(dense_rank() OVER (ORDER BY CAST(winner_id AS VARCHAR)) - 1 AS DOUBLE) AS winner FROM {_DECIDED}) w WHERE {_HELD}""")
def ml_multiclass_facts(t):
    """What SQL can tell of the winner as a class: the held-out matches, the number of their class, and that a class of training matches is predicted."""
    scored = settle(ml_multiclass_winner(t))
    classes = t.played_matches.where(F.col("winner_id").isNotNull()).select("winner_id").distinct().count()
    is_class = F.col("prediction").between(0, classes - 1) & (F.col("prediction") == F.floor("prediction"))
    return scored.select("match_id", "winner", is_class.alias("is_class"))


@query("ml_regression_facts", f"""
SELECT match_id, TRUE AS team_1_within, TRUE AS team_2_within FROM (SELECT match_id FROM {_DECIDED}) w WHERE {_HELD}""")
def ml_regression_facts(t):
    """A forest's means lie within the scores it was fitted on."""
    work = Training(t)
    rows = work.rows.where("is_test = 0")
    scores = ["team_1_score", "team_2_score"]
    limits = rows.agg(*[f(s).alias(f"{f.__name__}_{s}") for s in scores for f in (F.min, F.max)]).first()
    within = [F.col(f"{s}_pred").between(float(limits[f"min_{s}"]) - 1e-9, float(limits[f"max_{s}"]) + 1e-9).alias(f"{s[:6]}_within") for s in scores]
    return _regressed(work).select("match_id", *within)


@query("ml_weight_facts", "SELECT DISTINCT role, TRUE AS adds_up, TRUE AS is_share FROM fx_player_season")
def ml_weight_facts(t):
    """Every role has weights that are shares of one."""
    names = [F.col(n) for n in ("kills", "deaths", "objective")]
    return ml_importance_weights(t).select("role", (F.abs(sum(names[1:], names[0]) - 1) < 1e-9).alias("adds_up"), F.least(*names).between(0.0, 1.0).alias("is_share"))


@query("ml_feature_importance")
def ml_feature_importance(t):
    work = Training(t)
    fitted = work.merged(_parts(work.rows)[0])
    return train.importance_rows(fitted, train.fit_counted(train.forest(trees=100, depth=10), fitted), [*_DIFFS, train.MISSING])


@query("ml_importance_weights")
def ml_importance_weights(t):
    record = views.team_seasons(t.played_matches).select("team_id", "season", "mw", "mw_pct")
    rows = settle(t.played_seasons.join(record, ["team_id", "season"]), "roles")
    return train.importance_weights(rows, "role", ["kills", "deaths", "objective"], ["mw", "mw_pct"])


@query("ml_logistic")
def ml_logistic(t):
    fitted, held = _parts(Training(t).assembled())
    return train.logistic().fit(fitted).transform(held).select(
        *_PREDICTED, train.positive_probability().alias("probability"))


def _boosted(rows, settings, watched=None):
    """A fit on the training rows of a written table, with balanced weights."""
    bins = boosting.fit_bins(rows.where(F.col("is_test") == 0))
    taught = rows if watched else rows.where(F.col("is_test") == 0)
    return boosting.Fit(boosting.binned_rows(taught, bins, weight="weight", watched=watched, merge=True), bins, settings)


@query("ml_boosted_trees")
def ml_boosted_trees(t):
    """Leaf-wise boosting with sums of second derivatives, on a table of any size."""
    rows = _weighted(Training(t))
    model = _boosted(rows, boosting.Settings(leaves=31, depth=5, child_weight=0.1)).go_on(50)
    return model.predict(_parts(rows)[1]).select(*_PREDICTED, "probability")


@query("ml_early_stopping")
def ml_early_stopping(t):
    """500 rounds allowed; the fit stops when 50 rounds brought the held-out rows nothing, and keeps the trees of the best round."""
    rows = _weighted(Training(t))
    fit = _boosted(rows, boosting.Settings(leaves=15, depth=4, child_weight=0.1), watched="is_test")
    fit.go_on(500, patience=50)
    return fit.best().predict(_parts(rows)[1]).select(*_PREDICTED, F.lit(fit.best_round()).alias("rounds"))


_ROUND_ONE = boosting.Settings(leaves=4, step=0.1, child_weight=1.0, penalty=1.0)
views.add_view("fx_cell", """
  SELECT match_id, feature, label, CASE WHEN high > low THEN least(floor((value - low) / (high - low) * """ + str(boosting.CELLS) + """), """
               + str(boosting.CELLS - 1) + """) ELSE 0 END AS cell
  FROM (SELECT *, min(value) OVER (PARTITION BY feature) AS low, max(value) OVER (PARTITION BY feature) AS high
        FROM (""" + " UNION ALL ".join(
    f"SELECT match_id, {i} AS feature, CASE WHEN m.winner_id = m.team_2_id THEN 1 ELSE 0 END AS label, round({d}, 6) + 0.0 AS value "
    f"FROM fx_raw_diff d JOIN fx_match m USING (match_id) WHERE m.winner_id IS NOT NULL" for i, d in enumerate(_DIFFS)) + """) u) r""")
views.add_view("fx_bin", f"""
  SELECT match_id, feature, label, CAST(floor({boosting.BINS} * below / (SELECT count(DISTINCT match_id) FROM fx_cell)) AS BIGINT) AS bin
  FROM fx_cell JOIN (SELECT feature, cell, sum(n) OVER (PARTITION BY feature ORDER BY cell) - n AS below
                     FROM (SELECT feature, cell, count(*) AS n FROM fx_cell GROUP BY feature, cell) c) b USING (feature, cell)""")


def _round_one_sql():
    """The first tree in SQL: the leaf of the largest gain is split, three times."""
    unit, s = boosting.UNIT, _ROUND_ONE

    def strength(g, h):
        return f"(({g}) / {unit}.0) * (({g}) / {unit}.0) / (({h}) / {unit}.0 + {s.penalty})"

    steps = [f"""
sums AS (SELECT match_id, feature, bin, CAST(floor((p - label) * {unit} + 0.5) AS BIGINT) AS g, CAST(floor(p * (1 - p) * {unit} + 0.5) AS BIGINT) AS h
         FROM fx_bin, (SELECT avg(label) AS p FROM (SELECT DISTINCT match_id, label FROM fx_bin) d) a),
leaf0 AS (SELECT DISTINCT match_id, CAST(1 AS BIGINT) AS node FROM sums)"""]
    for i in range(s.leaves - 1):
        steps.append(f"""
cuts{i} AS (SELECT node, feature, bin, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(n) OVER w AS nl, sum(g) OVER v AS g, sum(h) OVER v AS h, sum(n) OVER v AS n
  FROM (SELECT node, feature, bin, sum(g) AS g, sum(h) AS h, count(*) AS n FROM sums JOIN leaf{i} USING (match_id) GROUP BY node, feature, bin) q
  WINDOW w AS (PARTITION BY node, feature ORDER BY bin), v AS (PARTITION BY node, feature)),
best{i} AS (SELECT node, feature, bin AS cut, {strength('gl', 'hl')} + {strength('g - gl', 'h - hl')} - {strength('g', 'h')} AS gain FROM cuts{i}
  WHERE nl >= {s.least_rows} AND n - nl >= {s.least_rows} AND hl >= {s.child_weight} * {unit} AND h - hl >= {s.child_weight} * {unit} AND bin < {boosting.BINS - 1}
  ORDER BY gain DESC, node, feature, cut LIMIT 1),
leaf{i + 1} AS (SELECT l.match_id, CASE WHEN l.node <> b.node THEN l.node WHEN s.bin <= b.cut THEN 2 * l.node ELSE 2 * l.node + 1 END AS node
  FROM leaf{i} l, best{i} b JOIN sums s ON s.feature = b.feature WHERE s.match_id = l.match_id)""")
    last = s.leaves - 1
    splits = " UNION ALL ".join(f"SELECT node, CAST(feature AS BIGINT) AS feature, CAST(cut AS BIGINT) AS cut, CAST(NULL AS DOUBLE) AS value FROM best{i}" for i in range(last))
    return ("WITH " + ",".join(steps) + f"""
{splits} UNION ALL
SELECT node, -1, 0, round(-{s.step} * (sum(g) / {unit}.0) / (sum(h) / {unit}.0 + {s.penalty}), 9) + 0.0
FROM leaf{last} JOIN sums USING (match_id) WHERE feature = 0 GROUP BY node""")


@query("ml_boosted_first_round", _round_one_sql())
def ml_boosted_first_round(t):
    """The splits of the first tree and the boosted value of each leaf, on all decided matches; node 1 is the root, its children 2 and 3, and so on."""
    work = Training(t)
    raw = _rounded(work.scaling.invert(work.rows), _DIFFS)
    rows = settle(train.assemble(raw, _DIFFS).select("match_id", "label", "features"), "raw")
    bins = boosting.fit_bins(rows)
    tree = boosting.Fit(boosting.binned_rows(rows, bins), bins, _ROUND_ONE).go_on(1).trees[0]
    return t.spark.createDataFrame(boosting.named_nodes(tree), "node bigint, feature bigint, cut bigint, value double").withColumn("value", F.round("value", 9))


def _members():
    return {"rf": train.forest(trees=50, depth=10), "gbt": train.boosted(rounds=50, depth=5), "lr": train.logistic()}


@query("ml_soft_vote")
def ml_soft_vote(t):
    work = Training(t)
    fitted, held = _parts(work.rows)
    return train.soft_vote(work.model_input(held), train.fit_members(work.merged(fitted), _members())).select(
        "match_id", "label", "p_rf", "p_gbt", "p_lr", "vote_prob", "vote")


@query("ml_held_out_rows", """
SELECT model, match_id, CAST(CASE WHEN winner_id = team_2_id THEN 1 ELSE 0 END AS INT) AS label, TRUE AS is_probability, TRUE AS is_mean
FROM fx_match m JOIN fx_team a ON a.team_id = team_1_id AND a.season = m.season JOIN fx_team b ON b.team_id = team_2_id AND b.season = m.season,
     (VALUES ('rf'), ('gbt'), ('lr')) AS v(model)
WHERE winner_id IS NOT NULL AND CAST(('0x' || substr(md5('42|' || CAST(match_id AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < 20""")
def ml_held_out_rows(t):
    """What SQL can tell of fitted models: every held-out match once per model, its label, probabilities, and their mean as the vote."""
    fitted, held = _parts(Training(t).assembled())
    members = {"rf": train.forest(trees=50, depth=10), "gbt": train.boosted(rounds=10), "lr": train.logistic()}
    scored = train.soft_vote(held, train.fit_members(fitted, members, parallelism=3))
    mean = F.abs(F.col("vote_prob") - (F.col("p_rf") + F.col("p_gbt") + F.col("p_lr")) / 3) < 1e-12
    cells = F.array(*[F.struct(F.lit(m).alias("model"), F.col(f"p_{m}").between(0.0, 1.0).alias("is_probability")) for m in members])
    return scored.select("match_id", "label", mean.alias("is_mean"), F.inline(cells))


@query("ml_soft_vote_mean", """
SELECT match_id, round((p_record + p_score) / 2, 6) + 0.0 AS vote_prob,
       CAST(CASE WHEN (p_record + p_score) / 2 > 0.5 THEN 1 ELSE 0 END AS INT) AS vote
FROM (SELECT match_id, 0.5 + score AS p_record, team_2_guess / (team_1_guess + team_2_guess) AS p_score FROM fx_rule) p""")
def ml_soft_vote_mean(t):
    guesses = F.col("team_1_guess") + F.col("team_2_guess")
    rows = _rule(t).select("match_id", (F.lit(0.5) + F.col("score")).alias("p_record"),
                           (F.col("team_2_guess") / guesses).alias("p_score"))
    return _rounded(train.average_vote(rows, ["p_record", "p_score"]).drop("p_record", "p_score"), ["vote_prob"])


def _sampled(work, folds, **extra):
    """The bounded sample of a search, with its folds."""
    rows = _weighted(work, "fold", prepare=lambda rows: split.add_folds(rows, "label", folds, 42, ["match_id"]))
    return search.sample(rows, boosting.fit_bins(rows.where(F.col("is_test") == 0)), weight="weight", **extra)


@query("ml_grid_search")
def ml_grid_search(t):
    """All 324 combinations over 3 folds."""
    return search.vote_search(t.spark, _sampled(Training(t), 3))


@query("ml_random_search")
def ml_random_search(t):
    """50 of 972 settings over 5 folds, 500 rounds allowed; held-out rows tell when to stop."""
    rows = _sampled(Training(t), 5, watched="is_test")
    return search.random_search(t.spark, rows, search.drawn_settings(search.BOOSTED_SETTINGS, 50)).drop("number")


@query("ml_cross_val_score")
def ml_cross_val_score(t):
    rows = Training(t).folded(5)
    return train.cross_val_scores(rows, train.forest(trees=50, depth=10), "fold")


class _Calibrated:
    """Forests of five folds of the training rows, and their calibrators."""

    def __init__(self, t):
        work = Training(t)
        rows = work.assembled("fold", prepare=lambda rows: split.add_folds(rows, "label", 5, 42, ["match_id"]))
        fitted, self.held = _parts(rows)
        self.models, scores = calibration.out_of_fold(fitted, train.forest(trees=100, depth=10), keep=["match_id"])
        self.targets = calibration.with_targets(scores)
        self.calibrators = calibration.fit_platt(self.targets)


@query("ml_calibration")
def ml_calibration(t):
    """Held-out matches by the forests of five folds, each calibrated on the rows that it had not seen."""
    work = _Calibrated(t)
    return calibration.apply(work.held, work.models, work.calibrators).select("match_id", "label", "calibrated_prob")


@query("ml_calibration_equations", f"""
SELECT CAST(fold AS INT) AS fold, count(*) AS rows, CAST(sum(label) AS BIGINT) AS positives, TRUE AS shift_holds, TRUE AS slope_holds
FROM (SELECT match_id, CAST(label AS BIGINT) AS label, ({_PLACE} - 1) % 5 AS fold FROM fx_labelled
      WHERE match_id IN (SELECT match_id FROM fx_raw_diff)) f
WHERE CAST(('0x' || substr(md5('42|' || CAST(match_id AS VARCHAR)), 1, 8)) AS BIGINT) % 100 >= 20
GROUP BY fold""")
def ml_calibration_equations(t):
    """Every training match is scored once, by its fold, and the equations of each fold's calibrator hold to 1e-6."""
    work = _Calibrated(t)
    left = calibration.equations(work.targets, work.calibrators).select("fold", *[(F.abs(f"rest_{n}") < 1e-6).alias(f"{n}_holds") for n in ("shift", "slope")])
    counts = work.targets.groupBy("fold").agg(F.count(F.lit(1)).alias("rows"), F.sum("label").cast("bigint").alias("positives"))
    return counts.join(left, "fold")


# A rule instead of a model: the side with the better record of the season before wins.
views.add_view("fx_rule", """
  SELECT match_id, team_1_id, team_2_id, m.season, CASE WHEN winner_id = team_2_id THEN 1 ELSE 0 END AS label, b.mw_pct - a.mw_pct AS score,
         CASE WHEN b.mw_pct > a.mw_pct THEN 1 ELSE 0 END AS prediction, team_1_score, team_2_score,
         CAST(a.mw AS DOUBLE) AS team_1_guess, CAST(b.mw AS DOUBLE) AS team_2_guess
  FROM fx_match m JOIN fx_team_season a ON a.team_id = team_1_id AND a.season = m.season - 1
                  JOIN fx_team_season b ON b.team_id = team_2_id AND b.season = m.season - 1
  WHERE winner_id IS NOT NULL""")


def _rule(t):
    matches = t.settled_matches
    decided = matches.where(F.col("winner_id").isNotNull()).withColumn("before", F.col("season") - 1)
    paired = role_playing_join(decided, settle(views.team_seasons(matches)), ["team_id", "season"],
                               {"team1": ["team_1_id", "before"], "team2": ["team_2_id", "before"]}, ["mw", "mw_pct"])
    score = F.col("mw_pct_team2") - F.col("mw_pct_team1")
    return paired.select(
        "match_id", "team_1_id", "team_2_id", "season", equality_label(F.col("winner_id"), F.col("team_2_id")).alias("label"), score.alias("score"),
        F.when(F.col("mw_pct_team2") > F.col("mw_pct_team1"), 1).otherwise(0).alias("prediction"),
        "team_1_score", "team_2_score", F.col("mw_team1").cast("double").alias("team_1_guess"),
        F.col("mw_team2").cast("double").alias("team_2_guess"))


def _rounded(df, names):
    return df.withColumns({n: F.round(n, 6) for n in names})


@query("eval_accuracy", """
SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) + 0.0 AS accuracy,
       CAST(count(*) AS BIGINT) AS rows FROM fx_rule""")
def eval_accuracy(t):
    return _rounded(evaluate.accuracy(_rule(t), "label", "prediction"), ["accuracy"])


@query("eval_class_report", """
WITH classes AS (
  SELECT c AS class, coalesce(sum(CASE WHEN label = c AND prediction = c THEN 1 ELSE 0 END)::DOUBLE
           / nullif(sum(CASE WHEN prediction = c THEN 1 ELSE 0 END), 0), 0) AS p,
         coalesce(sum(CASE WHEN label = c AND prediction = c THEN 1 ELSE 0 END)::DOUBLE
           / nullif(sum(CASE WHEN label = c THEN 1 ELSE 0 END), 0), 0) AS r,
         sum(CASE WHEN label = c THEN 1 ELSE 0 END) AS s
  FROM fx_rule, (VALUES (0), (1)) AS v(c) GROUP BY c),
measured AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f FROM classes)
SELECT CAST(class AS VARCHAR) AS class, round(p, 6) + 0.0 AS precision, round(r, 6) + 0.0 AS recall,
       round(f, 6) + 0.0 AS f1, CAST(s AS BIGINT) AS support FROM measured
UNION ALL SELECT 'macro avg', round(avg(p), 6) + 0.0, round(avg(r), 6) + 0.0, round(avg(f), 6) + 0.0, CAST(sum(s) AS BIGINT)
FROM measured
UNION ALL SELECT 'weighted avg', round(sum(p * s) / sum(s), 6) + 0.0, round(sum(r * s) / sum(s), 6) + 0.0,
       round(sum(f * s) / sum(s), 6) + 0.0, CAST(sum(s) AS BIGINT) FROM measured""")
def eval_class_report(t):
    return _rounded(evaluate.class_report(_rule(t), "label", "prediction"), ["precision", "recall", "f1"])


@query("eval_mse", """
SELECT 'team_1_score' AS target, round(avg(pow(team_1_score - team_1_guess, 2)), 4) + 0.0 AS mse FROM fx_rule
UNION ALL SELECT 'team_2_score', round(avg(pow(team_2_score - team_2_guess, 2)), 4) + 0.0 FROM fx_rule""")
def eval_mse(t):
    errors = evaluate.mean_squared_errors(_rule(t), {"team_1_score": "team_1_guess", "team_2_score": "team_2_guess"})
    return errors.withColumn("mse", F.round("mse", 4))


@query("eval_roc_auc", """
SELECT round(sum(CASE WHEN label = 1 THEN place ELSE 0 END)::DOUBLE / any_value(pos) / any_value(neg)
       - (any_value(pos) + 1)::DOUBLE / (2 * any_value(neg)), 6) + 0.0 AS roc_auc
FROM (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS place,
             sum(label) OVER () AS pos, sum(1 - label) OVER () AS neg FROM fx_rule) r""")
def eval_roc_auc(t):
    return _rounded(evaluate.roc_auc(_rule(t), "label", "score"), ["roc_auc"])


@query("eval_vote_argmax", """
SELECT match_id, CAST(CASE WHEN team_1_guess >= team_2_guess THEN 0 ELSE 1 END AS INT) AS vote FROM fx_rule""")
def eval_vote_argmax(t):
    return _rule(t).select("match_id", argmax(F.col("team_1_guess"), F.col("team_2_guess")).alias("vote"))


_TRAINED = ("winner_id IS NOT NULL AND "
            "CAST(('0x' || substr(md5('42|' || CAST(match_id AS VARCHAR)), 1, 8)) AS BIGINT) % 100 >= 20")


@query("pred_upcoming_features", "SELECT match_id AS game_id, season, " + ", ".join(
    f"round(({d} - (SELECT min({d}) FROM fx_raw_diff WHERE {_TRAINED})) / "
    f"(SELECT max({d}) - min({d}) FROM fx_raw_diff WHERE {_TRAINED}), 6) + 0.0 AS {d}" for d in _DIFFS)
    + " FROM fx_raw_diff WHERE status = 'O'")
def pred_upcoming_features(t):
    return _rounded(Training(t).coming().drop("team_1_id", "team_2_id"), _DIFFS)


@query("pred_score_upcoming")
def pred_score_upcoming(t):
    work = Training(t, counted=True)
    model = train.fit_counted(train.forest(trees=50, depth=10), work.merged(work.rows))
    return model.transform(work.model_input(work.coming())).select("game_id", "season", train.positive_probability().alias("team_2_win_prob"),
                                         F.col("prediction").cast("int").alias("winner_pred"))


@query("pred_noise_ensemble")
def pred_noise_ensemble(t):
    work = Training(t, counted=True)
    model = train.fit_counted(train.forest(trees=50, depth=10), work.merged(work.rows))
    return work.simulated(model.transform, "prediction")


@query("pred_noise_vote")
def pred_noise_vote(t):
    work = Training(t, counted=True)
    models = train.fit_members(work.merged(work.rows), _members())
    return work.simulated(lambda rows: train.soft_vote(rows, models), "vote", scale=0.01, limits=(0.0, 1.0))


_PAIRING = "concat_ws('-', team_1_id, team_2_id, season)"
_DRAW_KEY = "score|' || pairing || '|' || CAST(draw AS VARCHAR)"


@query("pred_noise_rule", f"""
WITH games AS (SELECT match_id, score, {_PAIRING} AS pairing FROM fx_rule WHERE season = (SELECT max(season) FROM fx_rule)),
votes AS (
  SELECT pairing, round(avg(1.0::DOUBLE - prediction), 6) + 0.0 AS team_1_win_prob,
         round(avg(prediction::DOUBLE), 6) + 0.0 AS team_2_win_prob, CAST(count(*) AS BIGINT) AS draws,
         CAST(CASE WHEN avg(1.0::DOUBLE - prediction) > avg(prediction::DOUBLE) THEN 0 ELSE 1 END AS INT) AS winner_pred
  FROM (SELECT pairing, CASE WHEN score + {noise_sql(0.05, _DRAW_KEY)} > 0 THEN 1 ELSE 0 END AS prediction
        FROM (SELECT DISTINCT pairing, score FROM games) p, (SELECT unnest(range(0, 15000)) AS draw) d) s GROUP BY pairing)
SELECT match_id, team_1_win_prob, team_2_win_prob, draws, winner_pred FROM games JOIN votes USING (pairing)""")
def pred_noise_rule(t):
    # The rule instead of a model, and noise that SQL can repeat.
    def predict(rows):
        return rows.withColumn("prediction", F.when(F.col("score") > 0, 1).otherwise(0))

    games = settle(_rule(t).select("match_id", "score", "team_1_id", "team_2_id", "season"), "rule")
    last = games.agg(F.max("season")).first()[0]
    votes = simulate.by_pairing(
        games.where(F.col("season") == last), "match_id", ["team_1_id", "team_2_id", "season"], ["score"],
        lambda pairings, key: simulate.noise_ensemble(pairings, key, ["score"], predict, "prediction", scale=0.05, gaussian=hash_gaussian))
    return _rounded(votes, ["team_1_win_prob", "team_2_win_prob"])


@query("flow_winner_report")
def flow_winner_report(t):
    table, _ = training_features(t, swap_share=0.5, noise_share=0.25, test_percent=15)
    _, scored = winner.train_and_hold(table, _DIFFS, train.boosted(rounds=50, depth=5), "label", ["match_id"], 15)
    return winner.held_out_report(scored, "label", copies=["swapped", "noisy"])


@query("flow_winner_search")
def flow_winner_search(t):
    """Search (50 settings, 5 folds, 500 rounds with patience), refit and the report on held-out originals."""
    table, _ = training_features(t, swap_share=0.5, noise_share=0.25, test_percent=15)
    _, scored, _ = winner.search_and_hold(settle(table), _DIFFS, "label", ["match_id"])
    return winner.held_out_report(scored, "label", copies=["swapped", "noisy"])


@query("pred_best_vote")
def pred_best_vote(t):
    """The best of 324 voting combinations, fitted on all rows of the search, in the simulation of the coming games."""
    work = Training(t)
    rows = _sampled(work, 3)
    vote = search.fit_vote(t.spark, rows, search.vote_search(t.spark, rows).first().asDict())
    return work.simulated(vote.predict, "vote", scale=0.01, limits=(0.0, 1.0))


@query("flow_fitted_ranks")
def flow_fitted_ranks(t):
    """Players scored by weights fitted per role, and ranked."""
    record = views.team_seasons(t.played_matches).select("team_id", "season", "mw", "mw_pct")
    rows = settle(t.played_seasons.join(record, ["team_id", "season"]), "roles")
    names = ["kills", "deaths", "objective"]
    weights = train.importance_weights(rows, "role", names, ["mw", "mw_pct"], trees=50)
    ranked = teams.player_ranks(rows.select("player_id", "season", "role", *names), "role", weights, names)
    return ranked.select("player_id", "season", "role", "weighted_score", "rank", "normalized_score")


@query("flow_role_model")
def flow_role_model(t):
    rows = train.index_classes(flow_role_matchup(t), "winner_id", "winner")
    names = ["slayer_diff", "support_diff", "objective_player_diff", "win_rate_diff", "team_rank_diff"]
    _, scored = winner.train_and_hold(settle(rows), names, train.forest("winner", trees=50, depth=10), "winner", ["match_id"], 20)
    return winner.accuracy_by_part(scored, "winner")
