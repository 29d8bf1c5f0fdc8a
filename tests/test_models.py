"""Splits, evaluation, models and simulation."""

import random
import re

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from scoreline.models import evaluate, simulate, split, train
from scoreline.storage import settle


@pytest.fixture(scope="module")
def labelled(spark):
    """Two features, of which the first decides the label nine times in ten."""
    rng = random.Random(5)
    rows = []
    for i in range(600):
        a, b = rng.random(), rng.random()
        label = int(a > 0.5) if rng.random() < 0.9 else rng.randint(0, 1)
        rows.append((i, a, b, label))
    return settle(spark.createDataFrame(rows, "id int, a double, b double, label int").repartition(4))


@pytest.fixture(scope="module")
def assembled(labelled):
    return settle(train.assemble(split.mark_test(labelled, 25, 42, ["id"]), ["a", "b"]))


def test_test_flag_depends_on_the_key_only(labelled):
    once = rows_of(split.mark_test(labelled.repartition(1), 20, 42, ["id"]).select("id", "is_test"))
    again = rows_of(split.mark_test(labelled.repartition(8), 20, 42, ["id"]).select("id", "is_test"))
    assert once == again and 0.12 < sum(t for _, t in once) / len(once) < 0.28


def test_stratified_split(labelled):
    parts = split.mark_test_stratified(labelled, "label", 0.2, 42, ["id"])
    assert parts.count() == 600
    for row in parts.groupBy("label").agg(F.sum("is_test").alias("t"), F.count("*").alias("n")).collect():
        assert abs(row["t"] - row["n"] * 0.2) <= 0.5


def test_folds_are_balanced_and_disjoint(labelled):
    folds = split.add_folds(labelled, "label", 5, 42, ["id"])
    assert folds.select("id").distinct().count() == folds.count() == 600
    for label in (0, 1):
        sizes = [r["count"] for r in folds.where(F.col("label") == label).groupBy("fold").count().collect()]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_class_weights_are_balanced(frame):
    df = frame([(i, "hot" if i < 9 else "cold") for i in range(12)], "id int, label string")
    sums = split.add_class_weights(df, "label").groupBy("label").agg(F.sum("weight")).collect()
    assert [r[1] for r in sums] == [pytest.approx(6.0)] * 2


def brute_auc(rows):
    pos, neg = [s for l, s in rows if l], [s for l, s in rows if not l]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_matches_brute_force(frame):
    rng = random.Random(2)
    rows = [(rng.randint(0, 1), 0.25 if i % 3 == 0 else rng.random()) for i in range(300)]
    assert evaluate.roc_auc(frame(rows, "l int, s double"), "l", "s").first()[0] == pytest.approx(brute_auc(rows))
    assert evaluate.roc_auc(frame([(1, 0.5)], "l int, s double"), "l", "s").first()[0] is None


def test_class_report(frame):
    df = frame([(0, 0), (0, 0), (0, 1), (1, 1), (2, 1)], "y int, p int")
    found = {r["class"]: r for r in evaluate.class_report(df, "y", "p").collect()}
    assert (found["0"]["precision"], found["0"]["recall"]) == (1.0, pytest.approx(2 / 3))
    assert (found["1"]["precision"], found["1"]["recall"], found["1"]["f1"]) == (pytest.approx(1 / 3), 1.0, 0.5)
    assert (found["2"]["precision"], found["2"]["recall"], found["2"]["f1"], found["2"]["support"]) == (0.0, 0.0, 0.0, 1)
    assert found["macro avg"]["f1"] == pytest.approx((0.8 + 0.5 + 0.0) / 3)
    assert found["weighted avg"]["recall"] == pytest.approx(3 / 5) and found["weighted avg"]["support"] == 5


def test_accuracy_and_mse(frame):
    df = frame([(1, 1, 2.0, 4.0), (0, 1, 1.0, 1.0)], "y int, p int, a double, b double")
    assert tuple(evaluate.accuracy(df, "y", "p").first()) == (0.5, 2)
    assert rows_of(evaluate.mean_squared_errors(df, {"a": "b"})) == [("a", 2.0)]


@pytest.mark.parametrize("estimator", [
    lambda: train.forest(trees=10, depth=4), lambda: train.boosted(rounds=5, depth=3), lambda: train.logistic(iterations=50)])
def test_classifiers_learn(assembled, estimator):
    fitted, held = assembled.where("is_test = 0"), assembled.where("is_test = 1")
    scored = estimator().fit(fitted).transform(held).withColumn("p", train.positive_probability())
    assert evaluate.accuracy(scored, "label", "prediction").first()[0] > 0.8
    assert scored.where("p < 0 OR p > 1").count() == 0


def test_importances_sum_to_one(assembled):
    rows = train.importance_rows(assembled, train.forest(trees=10, depth=4).fit(assembled), ["a", "b"]).collect()
    assert [r["feature"] for r in rows] == ["a", "b"] and sum(r["importance"] for r in rows) == pytest.approx(1.0)


def test_importance_weights_differ_by_role(frame):
    rng = random.Random(1)
    rows = []
    for i in range(300):
        a, b = rng.random(), rng.random()
        rows.append(("x", a, b, a, a) if i % 2 else ("y", a, b, b, b))
    weights = {r["role"]: r for r in train.importance_weights(
        frame(rows, "role string, a double, b double, t1 double, t2 double"), "role", ["a", "b"], ["t1", "t2"], 5).collect()}
    assert weights["x"]["a"] > 0.9 and weights["y"]["b"] > 0.9
    assert all(r["a"] + r["b"] == pytest.approx(1.0) for r in weights.values())


def test_vote_is_the_mean_probability(assembled):
    models = train.fit_members(assembled, {"rf": train.forest(trees=3, depth=2), "lr": train.logistic(iterations=20)})
    voted = train.soft_vote(assembled, models)
    wrong = voted.where("abs(vote_prob - (p_rf + p_lr) / 2) > 1e-12 OR (vote_prob > 0.5) <> (vote = 1)")
    assert wrong.count() == 0


def test_grid_search_scores_every_combination(assembled):
    rows = settle(split.add_folds(assembled, "label", 3, 42, ["id"]))
    found = train.vote_grid_search(rows, {
        "rf": {"d1": train.forest(trees=2, depth=1), "d3": train.forest(trees=2, depth=3)},
        "lr": {"c1": train.logistic(iterations=10, penalty=1.0), "c2": train.logistic(iterations=10)}}, "fold").collect()
    assert {(r["rf"], r["lr"]) for r in found} == {(a, b) for a in ("rf_d1", "rf_d3") for b in ("lr_c1", "lr_c2")}
    scores = [r["mean_accuracy"] for r in found]
    assert scores == sorted(scores, reverse=True) and scores[0] > 0.8


def test_combination_scores_match_brute_force(frame):
    rng = random.Random(8)
    rows = [(i % 3, rng.randint(0, 1), *[rng.random() for _ in range(4)]) for i in range(90)]
    df = frame(rows, "fold int, label int, p_a_1 double, p_a_2 double, p_b_1 double, p_b_2 double").repartition(4)
    found = {(r["a"], r["b"]): r["mean_accuracy"] for r in train.combination_scores(df, {"a": ["1", "2"], "b": ["1", "2"]}, "fold").collect()}
    for i, j in ((0, 0), (0, 1), (1, 0), (1, 1)):
        right = {f: [int((r[2 + i] + r[4 + j]) / 2 > 0.5) == r[1] for r in rows if r[0] == f] for f in range(3)}
        assert found[(f"a_{i + 1}", f"b_{j + 1}")] == pytest.approx(sum(sum(v) / len(v) for v in right.values()) / 3)


def test_random_search_and_cross_validation(assembled):
    rows = settle(split.add_folds(assembled, "label", 3, 42, ["id"]))
    model, table = train.random_search(rows, train.forest(trees=3), {"maxDepth": [1, 2, 3], "minInfoGain": [0.0, 0.1]},
                                       draws=2, fold="fold", folds=3)
    assert table.count() == 2 and model.transform(rows).count() == 600
    scores = train.cross_val_scores(rows, train.forest(trees=3, depth=3), "fold").collect()
    assert sorted(r["fold"] for r in scores) == [0, 1, 2] and sum(r["rows"] for r in scores) == 600


def test_early_stopping_stops(assembled):
    rows = assembled.withColumn("validation", F.col("is_test") == 1)
    model = train.boosted_with_early_stop("label", "validation", rounds=40, depth=3).fit(rows)
    assert model.getNumTrees < 40


def test_ols(frame):
    rng = random.Random(4)
    rows = []
    for _ in range(200):
        a, b = rng.random(), rng.random()
        rows.append((1.0 + 2.0 * a - 3.0 * b + rng.gauss(0, 0.01), a, b))
    found = {r["term"]: r for r in train.ols(frame(rows, "y double, a double, b double"), "y", ["a", "b"]).collect()}
    assert [round(found[t]["coefficient"], 1) for t in ("const", "a", "b")] == [1.0, 2.0, -3.0]
    assert found["a"]["p_value"] < 0.01 and found["a"]["r2"] > 0.99 and found["a"]["std_error"] > 0


def test_kmeans_numbers_clusters_by_their_centre(frame):
    rng = random.Random(6)
    rows = [(i, rng.gauss(c, 0.1), rng.gauss(-c, 0.1)) for i, c in enumerate([0.0, 5.0, 10.0] * 40)]
    marked, centres = train.kmeans_roles(frame(rows, "id int, a double, b double"), ["a", "b"])
    assert [round(r["a"]) for r in centres.orderBy("role_cluster").collect()] == [10, 5, 0]
    assert marked.where("role_cluster <> CASE WHEN a > 7.5 THEN 0 WHEN a > 2.5 THEN 1 ELSE 2 END").count() == 0


def test_multiclass_and_regression_targets(assembled):
    rows = train.index_classes(assembled.withColumn("team", F.when(F.col("a") > 0.5, "x").otherwise("y")), "team", "winner")
    scored = train.forest("winner", trees=3, depth=3).fit(rows).transform(rows)
    assert evaluate.accuracy(scored, "winner", "prediction").first()[0] > 0.95
    models = train.fit_regressors(assembled, ["a", "b"], trees=3)
    assert set(models) == {"a", "b"} and "a_pred" in models["a"].transform(assembled).columns


def test_noise_ensemble_is_reproducible(spark, frame):
    games = frame([(1, 0.9), (2, 0.5), (3, 0.1)], "game int, f double")

    def predict(rows):
        return rows.withColumn("prediction", F.when(F.col("f") > 0.5, 1).otherwise(0))

    first = rows_of(simulate.noise_ensemble(games.repartition(1), "game", ["f"], predict, "prediction", draws=2500))
    again = rows_of(simulate.noise_ensemble(games.repartition(3), "game", ["f"], predict, "prediction", draws=2500))
    assert first == again
    for _, p1, p2, draws, winner in first:
        assert p1 + p2 == pytest.approx(1.0) and draws == 2500 and winner == (0 if p1 > p2 else 1)
    assert first[0][2] > 0.95 and 0.4 < first[1][1] < 0.6 and first[2][1] > 0.95


def test_noise_stays_within_limits(frame):
    games = frame([(1, 0.99), (2, 0.01)], "game int, f double")
    drawn = simulate.noisy_draws(games, "game", ["f"], 500, 0.15, limits=(0.0, 1.0))
    assert drawn.count() == 1000 and drawn.where("f < 0 OR f > 1").count() == 0


def test_limited_noise_is_compiled(frame, capsys):
    """The JVM interprets methods of 8,000 bytes and more; six features are those of a match."""
    names = [f"f{i}" for i in range(6)]
    games = frame([("a-b", *[0.5] * 5, None)], "game string, " + ", ".join(f"{n} double" for n in names))
    drawn = simulate.noisy_draws(games, "game", names, 5, 0.01, limits=(0.0, 1.0))
    total = drawn.agg(*[F.sum(n) for n in names])
    assert total.collect()[0][5] is None
    total.explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000, sizes
