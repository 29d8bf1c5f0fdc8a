"""Leaf-wise trees, boosting on tables and in tasks, searches, calibration."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scoreline.models import boosting, calibration, search, split, train
from scoreline.models.boosting import Settings
from scoreline.storage import settle


@pytest.fixture(scope="module")
def table(spark):
    """Three features; the first two decide the label nine times in ten, the third is constant."""
    rng = random.Random(5)
    rows = []
    for i in range(900):
        a, b = rng.random(), rng.random() ** 2
        label = int((a > 0.5) ^ (b > 0.3)) if rng.random() < 0.9 else rng.randint(0, 1)
        rows.append((i, a, b, 7.0, label, 1.0 + i % 3))
    df = spark.createDataFrame(rows, "match_id long, a double, b double, c double, label int, weight double").repartition(5)
    folded = split.add_folds(split.mark_test(df, 25, 42, ["match_id"]), "label", 3, 42, ["match_id"])
    return settle(train.assemble(folded, ["a", "b", "c"]))


@pytest.fixture(scope="module")
def bins(table):
    return boosting.fit_bins(table)


@pytest.fixture(scope="module")
def binned(table, bins):
    return boosting.binned_rows(table, bins, weight="weight", watched="is_test")


def local(table, bins, **extra):
    return search.sample(table, bins, weight="weight", watched="is_test", **extra)


def same(one, two):
    return len(one) == len(two) and all(np.array_equal(getattr(a, n), getattr(b, n)) for a, b in zip(one, two, strict=True) for n in ("feature", "cut", "left", "right", "value"))


def test_bins_hold_like_shares_and_keep_order(table, bins):
    values = np.array([r[0].toArray() for r in table.select("features").collect()])
    found = bins.apply(values)
    assert found.max() < boosting.BINS and (found[:, 2] == 0).all()
    for f in (0, 1):
        order = np.argsort(values[:, f])
        assert (np.diff(found[order, f].astype(int)) >= 0).all()
        assert np.bincount(found[:, f]).max() <= 3 * len(values) / boosting.BINS
    outside = bins.apply(np.array([[-5.0, 99.0, 0.0]]))
    assert outside.tolist() == [[0, found[:, 1].max(), 0]]


def plain_tree(settings, binned, first, second):
    """Best-first growth from scratch: the leaf of the largest gain, among all, is split next."""
    leaves, splits = {1: np.arange(len(first))}, []

    def strength(rows):
        weight = second[rows].sum() / boosting.UNIT + settings.penalty
        return (first[rows].sum() / boosting.UNIT) ** 2 / weight if weight > 0 else 0.0

    while len(leaves) < settings.leaves:
        best = None
        for name, rows in sorted(leaves.items()):
            if settings.depth >= 0 and name.bit_length() - 1 >= settings.depth:
                continue
            for f in range(binned.shape[1]):
                for cut in range(boosting.BINS - 1):
                    goes = binned[rows, f] <= cut
                    parts = rows[goes], rows[~goes]
                    if any(len(p) < max(settings.least_rows, 1) or second[p].sum() < settings.child_weight * boosting.UNIT for p in parts):
                        continue
                    gain = strength(parts[0]) + strength(parts[1]) - strength(rows)
                    if gain > max(settings.gain, 1e-12) and (best is None or gain > best[0] + 1e-12):
                        best = (gain, name, f, cut, *parts)
        if best is None:
            break
        _, name, f, cut, left, right = best
        del leaves[name]
        leaves[2 * name], leaves[2 * name + 1] = left, right
        splits.append((name, f, cut))
    return splits, leaves


def named_splits(tree):
    made, stack = [], [(0, 1)]
    while stack:
        node, name = stack.pop()
        if tree.feature[node] >= 0:
            made.append((name, int(tree.feature[node]), int(tree.cut[node])))
            stack += [(tree.left[node], 2 * name), (tree.right[node], 2 * name + 1)]
    return sorted(made)


@pytest.mark.parametrize("settings", [Settings(leaves=6), Settings(leaves=9, depth=3, least_rows=5, penalty=1.0), Settings(leaves=5, child_weight=20.0), Settings(leaves=20, gain=4.0)])
def test_tree_is_that_of_plain_best_first_growth(table, bins, settings):
    own = local(table, bins)
    part = np.flatnonzero(own.fold >= 0)
    binned, label, weight = own.binned[part], own.label[part], own.weight[part]
    first, second = boosting.derivatives(np.full(len(part), boosting.start_margin(label, weight)), label, weight)
    rows = boosting.LocalRows(binned, first, second, np.arange(len(part)))
    tree = boosting.grow(settings, rows.sums, boosting.drawn_columns(settings, 3, 0), boosting.newton_value(settings))
    splits, leaves = plain_tree(settings, binned, first, second)
    assert named_splits(tree) == sorted(splits)
    wanted = {name: -settings.step * first[r].sum() / (second[r].sum() + settings.penalty * boosting.UNIT) for name, r in leaves.items()}
    for name, r in leaves.items():
        assert tree.values(binned[r]) == pytest.approx(np.full(len(r), wanted[name]))


def test_table_and_task_grow_the_same_trees(table, bins, binned):
    settings = Settings(leaves=8, rows=0.7, columns=0.7, child_weight=0.1)
    fit = boosting.Fit(binned, bins, settings)
    model = fit.go_on(3)
    own = local(table, bins)
    part = own.fold >= 0
    start, trees = boosting.boost_rows(Settings(**{**settings.__dict__, "rounds": 3}), own.binned[part], own.label[part], own.weight[part], own.row[part])
    assert model.start == pytest.approx(start, abs=1e-12) and same(model.trees, trees)
    scored = model.predict(table)
    assert scored.where("probability < 0 OR probability > 1 OR (probability > 0.5) <> (prediction = 1)").count() == 0
    assert scored.where("prediction = label").count() > 0.75 * 900


def test_a_fit_goes_on_where_it_stopped(binned, bins, monkeypatch):
    monkeypatch.setattr(boosting, "KEEP", 2)
    once = boosting.Fit(binned, bins, Settings(leaves=4)).go_on(5)
    fit = boosting.Fit(binned.repartition(3), bins, Settings(leaves=4))
    fit.go_on(2)
    before = list(fit.model.trees)
    assert same(fit.go_on(3).trees, once.trees) and all(a is b for a, b in zip(before, fit.model.trees))


def test_patience_stops_and_fits_nothing_twice(table, binned, bins, monkeypatch):
    grown = []
    grow = boosting.grow
    monkeypatch.setattr(boosting, "grow", lambda *a: grown.append(1) or grow(*a))
    fit = boosting.Fit(binned, bins, Settings(leaves=15, step=0.5))
    fit.go_on(60, patience=4)
    model = fit.best()
    assert len(grown) == fit.best_round() + 4 < 60 and len(model.trees) == fit.best_round()
    held = model.predict(table.where("is_test = 1"))
    loss = held.agg(F.avg(-F.ln(F.when(F.col("label") == 1, F.col("probability")).otherwise(1 - F.col("probability"))))).first()[0]
    assert loss == pytest.approx(min(fit.watched), abs=1e-5)
    own = local(table, bins)
    part, seen = own.fold >= 0, own.fold < 0
    _, trees = boosting.boost_rows(Settings(leaves=15, step=0.5, rounds=60), own.binned[part], own.label[part], own.weight[part], own.row[part],
                                   (own.binned[seen], own.label[seen]), 4)
    assert same(trees, model.trees)


def test_empty_and_single_class_tables(spark, bins):
    nothing = spark.createDataFrame([], "match_id long, a double, b double, c double, label int")
    rows = boosting.binned_rows(train.assemble(nothing, ["a", "b", "c"]), bins)
    assert len(boosting.Fit(rows, bins, Settings()).go_on(2).trees) == 2
    one = train.assemble(spark.createDataFrame([(i, i / 50, 0.5, 7.0, 1) for i in range(50)], "match_id long, a double, b double, c double, label int"), ["a", "b", "c"])
    model = boosting.Fit(boosting.binned_rows(one, bins), bins, Settings()).go_on(2)
    assert model.predict(one).where("probability < 0.99 OR probability > 1").count() == 0


def test_forest_leaves_are_shares_and_blocks_join(table, bins):
    own = local(table, bins)
    part = own.fold >= 0
    arguments = (own.binned[part], own.label[part], own.row[part])
    whole = list(boosting.forest_trees(range(6), 4, *arguments))
    assert same(whole, [t for n in range(6) for t in boosting.forest_trees([n], 4, *arguments)])
    p = np.mean([t.values(own.binned[~part]) for t in boosting.forest_trees(range(30), -1, *arguments)], axis=0)
    assert ((p >= 0) & (p <= 1)).all() and ((p > 0.5) == (own.label[~part] > 0.5)).mean() > 0.75
    order = np.random.default_rng(0).permutation(part.sum())
    assert same(whole, list(boosting.forest_trees(range(6), 4, *[x[order] for x in arguments])))


def test_sample_is_bounded_and_independent_of_files(table, bins):
    few = local(table, bins, most=300)
    assert 200 < len(few.row) < 400
    again = search.sample(table.repartition(7), bins, weight="weight", watched="is_test", most=300)
    assert np.array_equal(few.row, again.row) and np.array_equal(few.binned, again.binned)


def test_random_search_draws_from_all_settings(spark, table, bins):
    assert len(search.drawn_settings(search.BOOSTED_SETTINGS, 5000)) == 972
    drawn = search.drawn_settings({**search.BOOSTED_SETTINGS, "rounds": [12]}, 5)
    assert len(set(drawn)) == 5
    own = local(table, bins)
    found = search.random_search(spark, own, drawn, patience=5).collect()
    assert len(found) == 5 and all(r["folds"] == 3 and 0 < r["mean_rounds"] <= 12 for r in found)
    scores = [r["mean_accuracy"] for r in found]
    assert scores == sorted(scores, reverse=True) and scores[0] > 0.75
    model = search.fit_boosted(spark, own, drawn[found[0]["number"]], 5)
    assert model.predict(table).where("prediction = label").count() > 700


GRID = {"trees": [3, 30], "depths": [2, -1], "steps": [0.1, 0.2], "rounds": [2, 5], "strengths": [0.1, 10]}


def test_vote_search_scores_all_combinations_from_prefixes(spark, table, bins):
    own = local(table, bins)
    found = search.vote_search(spark, own, GRID).collect()
    assert len(found) == 32 and len({(r["rf"], r["gbt"], r["lr"]) for r in found}) == 32
    hits = []
    for fold in range(3):
        taught, held = (own.fold >= 0) & (own.fold != fold), own.fold == fold
        rows = (own.binned[taught], own.label[taught])
        forest = np.mean([t.values(own.binned[held]) for t in boosting.forest_trees(range(3), 2, *rows, own.row[taught])], axis=0)
        start, trees = boosting.boost_rows(Settings(**{**search.VOTE_TREES.__dict__, "step": 0.1, "rounds": 2}), *rows, own.weight[taught], own.row[taught])
        boosted = boosting.probability(start + sum(t.values(own.binned[held]) for t in trees))
        beta = search.newton_logistic(own.values[taught], own.label[taught], 10)
        p = (forest + boosted + boosting.probability(own.values[held] @ beta[:-1] + beta[-1])) / 3
        hits.append(((p > 0.5) == (own.label[held] > 0.5)).mean())
    one = next(r for r in found if (r["rf"], r["gbt"], r["lr"]) == ("rf_trees3_depth2", "gbt_step0_1_rounds2", "lr_c10"))
    assert one["mean_accuracy"] == pytest.approx(np.mean(hits))
    vote = search.fit_vote(spark, own, found[0], GRID)
    scored = vote.predict(table)
    assert scored.where("vote = label").count() > 650 and scored.where("vote_prob < 0 OR vote_prob > 1").count() == 0


def test_full_vote_grid():
    names = search.member_names(**search.VOTE_SETTINGS)
    assert [len(n) for n in names.values()] == [9, 9, 4]
    jobs = search._member_jobs(search.VOTE_SETTINGS)
    assert [sum(j[0] == m for j in jobs) for m in names] == [24, 3, 4]


def test_logistic_meets_its_equations():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 3))
    y = (x[:, 0] + rng.normal(size=300) > 0).astype(float)
    beta = search.newton_logistic(x, y, 0.5)
    residual = boosting.probability(x @ beta[:-1] + beta[-1]) - y
    assert abs(residual.sum()) < 1e-6 and np.abs(0.5 * x.T @ residual + beta[:-1]).max() < 1e-6


def test_calibrators_meet_their_equations(table):
    models, scores = calibration.out_of_fold(table, train.forest(trees=5, depth=3), keep=["match_id"])
    assert sorted(models) == [0, 1, 2] and scores.select("match_id").distinct().count() == scores.count() == 900
    assert scores.join(table.select("match_id", F.col("fold").alias("own")), "match_id").where("own <> fold").count() == 0
    targets = calibration.with_targets(scores)
    fitted = calibration.fit_platt(targets)
    rows = targets.toPandas()
    for fold, (slope, shift) in fitted.items():
        own = rows[rows["fold"] == fold]
        n = own["label"].sum()
        assert own["target"].where(own["label"] == 1).dropna().unique() == pytest.approx([(n + 1) / (n + 2)])
        rest = 1 / (1 + np.exp(-(own["score"] * slope + shift))) - own["target"]
        assert abs(rest.sum()) < 1e-6 and abs((rest * own["score"]).sum()) < 1e-6 and slope > 0
    scored = calibration.apply(table, models, fitted)
    assert scored.columns == [*table.columns, "calibrated_prob"] and scored.where("calibrated_prob < 0 OR calibrated_prob > 1").count() == 0
    wanted = np.mean([1 / (1 + np.exp(-(m.transform(table).select("match_id", train.positive_probability().alias("p")).toPandas().sort_values("match_id")["p"] * fitted[n][0] + fitted[n][1])))
                      for n, m in models.items()], axis=0)
    assert scored.toPandas().sort_values("match_id")["calibrated_prob"].to_numpy() == pytest.approx(wanted)


def test_calibrators_of_equal_scores_and_one_class(frame):
    targets = calibration.with_targets(frame([(0, float(i % 2), 0.5) for i in range(10)] + [(1, 1.0, i / 10) for i in range(5)], "fold int, label double, score double"))
    fitted = calibration.fit_platt(targets)
    left = {r["fold"]: r for r in calibration.equations(targets, fitted).collect()}
    assert all(abs(left[n]["rest_shift"]) < 1e-6 and abs(left[n]["rest_slope"]) < 1e-6 for n in (0, 1))
    assert calibration.fit_platt(targets.where("fold > 5")) == {}


def test_rows_that_differ_in_their_key_only_are_merged_and_fit_the_same_trees(spark, table, bins):
    """Five copies of every match under new keys: as many rows to fit on as without them."""
    many = settle(table.withColumn("match_id", F.explode(F.array(*[F.col("match_id") + 1000 * i for i in range(5)]))))
    plain = boosting.binned_rows(many, bins, weight="weight", watched="is_test")
    merged = boosting.binned_rows(many, bins, weight="weight", watched="is_test", merge=True)
    assert plain.count() == 4500 and merged.count() <= 900 and merged.agg(F.sum("copies")).first()[0] == 4500
    settings = Settings(leaves=8, depth=3, child_weight=0.1)
    one, two = boosting.Fit(plain, bins, settings), boosting.Fit(merged, bins, settings)
    assert same(one.go_on(3, patience=9).trees, two.go_on(3, patience=9).trees) and one.watched == pytest.approx(two.watched, abs=1e-9)
    with pytest.raises(ValueError, match="row by itself"):
        boosting.Fit(merged, bins, Settings(rows=0.5))


def test_children_at_the_greatest_depth_ask_for_no_sums(table, bins):
    own = local(table, bins)
    first, second = boosting.derivatives(np.zeros(len(own.row)), own.label, own.weight)
    rows, asked = boosting.LocalRows(own.binned, first, second, np.arange(len(own.row))), []

    def sums(tree, nodes):
        asked.append(list(nodes))
        return rows.sums(tree, nodes)

    settings = Settings(leaves=4, depth=2, least_rows=5)
    tree = boosting.grow(settings, sums, boosting.drawn_columns(settings, 3, 0), boosting.newton_value(settings))
    assert (tree.feature >= 0).sum() == 3 and len(asked) == 2
    at = tree.leaf(own.binned)
    for leaf in np.unique(at):
        assert tree.value[leaf] == pytest.approx(-settings.step * first[at == leaf].sum() / second[at == leaf].sum())


def test_a_level_is_a_job_on_held_blocks_and_no_plan_of_its_own(binned, bins, monkeypatch):
    fit, planned = boosting.Fit(binned, bins, Settings(leaves=8, depth=3)), []
    plan = type(binned).mapInArrow
    monkeypatch.setattr(type(binned), "mapInArrow", lambda *a, **k: planned.append(1) or plan(*a, **k))
    trees = list(fit.go_on(3, patience=9).trees)
    assert len(trees) == 3 and not planned
    monkeypatch.setattr(boosting, "_DIRECT", 0)  # sums are added up by tasks first, as with many partitions
    assert same(trees, boosting.Fit(binned.repartition(6), bins, Settings(leaves=8, depth=3)).go_on(3, patience=9).trees)
