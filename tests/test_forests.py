"""Forests on merged rows."""

import random
import time
from functools import cache
from multiprocessing.pool import ThreadPool

import numpy as np
import pytest
from pyspark.sql import functions as F

from scoreline import session
from scoreline.models import boosting, forests, train
from scoreline.models.forests import Forest
from scoreline.storage import settle


@pytest.fixture(scope="module")
def table(spark):
    """Few distinct features, many rows of each: 40 pairings in 4,000 matches."""
    rng = random.Random(3)
    kinds = [(rng.random(), rng.random(), rng.random()) for _ in range(40)]
    rows = []
    for i in range(4000):
        a, b, c = kinds[i % 40]
        rows.append((i, a, b, c, int(rng.random() < (0.9 if (a > 0.5) ^ (b > 0.5) else 0.2)), float(rng.randint(1, 3)), 10.0 * a + rng.randint(0, 4)))
    df = spark.createDataFrame(rows, "match_id long, a double, b double, c double, label int, weight double, score double").repartition(5)
    return settle(train.assemble(df, ["a", "b", "c"]))


def same(one, two):
    return len(one) == len(two) and all(np.array_equal(getattr(a, n), getattr(b, n)) for a, b in zip(one, two, strict=True)
                                        for n in ("feature", "cut", "left", "right", "value"))


def test_merged_rows_keep_every_match_and_its_weight(table):
    rows = train.merged(table, ["label"], "weight")
    assert rows.count() <= 240 and rows.agg(F.sum("copies"), F.sum("copies_weight")).first() == (4000, table.agg(F.sum("weight")).first()[0])


@pytest.mark.parametrize("settings", [{}, {"regression": True, "labelCol": "score"}])
def test_merged_rows_and_partitions_grow_the_same_trees(table, settings):
    forest = Forest(numTrees=4, maxDepth=4, **settings)
    label = settings.get("labelCol", "label")
    plain = forest.fit(table).trees
    assert same(plain, forest.fit(table.repartition(3)).trees)
    assert same(plain, train.counted(forest).fit(train.merged(table, [label])).trees)


def test_sums_are_bounded_by_passes(table, monkeypatch):
    once = Forest(numTrees=5, maxDepth=5).fit(table).trees
    monkeypatch.setattr(forests, "MOST_SUMS", 3 * forests.BINS * 2 * 2)
    assert same(once, Forest(numTrees=5, maxDepth=5).fit(table).trees)


def test_a_row_is_drawn_by_the_number_of_its_copies(table):
    rows = train.merged(table, ["label"])
    drawn = forests._drawn_rows(Forest(copiesCol="copies"), rows, boosting.fit_bins(rows, bins=forests.BINS), 400).toPandas()
    counts = np.stack([np.frombuffer(bytes(d), np.int32) for d in drawn["drawn"]])
    # 4,000 rows drawn 4,000 times: mean and variance of each tree's total are those of that many single draws.
    assert counts.sum(axis=0).mean() == pytest.approx(4000, abs=20) and counts.sum(axis=0).std() == pytest.approx(4000 ** 0.5, rel=0.15)


@pytest.mark.parametrize("classes", [0, 2])
def test_best_split_is_that_of_plain_search(classes):
    rng = np.random.default_rng(1)
    sums = rng.integers(0, 50, (3, 2, 8, 2)) * boosting.UNIT
    sums[:, 1] = rng.permuted(sums[:, 0], axis=1)  # the slots of a node have the same totals
    gain, slot, cut, left, right = (a.to_pylist() for a in forests.best_splits(sums, classes))

    def strength(part):
        weight = part.sum() if classes else part[1]
        return 0 if not weight else ((part.astype(float) ** 2).sum() if classes else float(part[0]) ** 2) / weight / boosting.UNIT

    for n in range(3):
        tried = {(s, c): strength(sums[n, s, :c + 1].sum(axis=0)) + strength(sums[n, s, c + 1:].sum(axis=0)) - strength(sums[n, s].sum(axis=0))
                 for s in range(2) for c in range(7)}
        assert gain[n] == pytest.approx(max(tried.values())) and tried[slot[n], cut[n]] == pytest.approx(gain[n])
        assert np.array_equal(np.frombuffer(left[n], np.int64) + np.frombuffer(right[n], np.int64), sums[n, 0].sum(axis=0))


def test_leaves_are_shares_and_means(table):
    scored = Forest(numTrees=30, maxDepth=6, weightCol="weight").fit(table).transform(table)
    p = scored.select("a", "b", train.positive_probability().alias("p"), "prediction").toPandas()
    first = (p["a"] > 0.5) ^ (p["b"] > 0.5)
    assert p["p"][first].mean() == pytest.approx(0.9, abs=0.06) and p["p"][~first].mean() == pytest.approx(0.2, abs=0.06)
    assert ((p["p"] > 0.5) == (p["prediction"] == 1)).all()
    model = Forest(labelCol="score", numTrees=30, maxDepth=6, regression=True).fit(table)
    means = model.transform(table).select(F.avg(F.abs(F.col("prediction") - 10 * F.col("a") - 2))).first()[0]
    assert means < 0.5 and model.featureImportances.toArray()[0] > 0.95 and model.featureImportances.toArray().sum() == pytest.approx(1.0)


def test_missing_labels_and_single_classes(table):
    with pytest.raises(Exception, match="NULL or NaN"):
        Forest(labelCol="score", regression=True).fit(table.withColumn("score", F.when(F.col("match_id") > 5, F.col("score"))))
    scored = Forest(numTrees=2).fit(table.where("label = 1")).transform(table)
    assert scored.where("prediction <> 1").count() == 0


def test_a_regression_reads_sums_of_cells(table, monkeypatch):
    """Draws of many labels in a cell are one row, also when a task gives its sums out early, and the trees are those of all rows."""
    forest = Forest(labelCol="score", numTrees=4, maxDepth=4, regression=True, weightCol="weight")
    drawn = forests._drawn_rows(forest, table, boosting.fit_bins(table, bins=forests.BINS), 4)
    assert drawn.columns == ["bins", "sums"] and drawn.count() == drawn.select("bins").distinct().count() <= 40
    by_cell = forest.fit(table).trees
    monkeypatch.setattr(forests, "_HELD_CELLS", 3)
    assert same(by_cell, forest.fit(table).trees)
    monkeypatch.setattr(forests, "_SHARED", 1 << 40)
    assert "sums" not in forests._drawn_rows(forest, table, boosting.fit_bins(table, bins=forests.BINS), 4).columns
    assert same(by_cell, forest.fit(table).trees)


def test_fits_side_by_side_ship_the_package_once(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(session, "_ship", cache(lambda *key: (time.sleep(0.2), calls.append(key))))
    with ThreadPool(4) as pool:
        pool.map(session.ship_package, [spark] * 4, chunksize=1)
    assert len(calls) == 1


def test_counted_rows_fit_the_forest_of_all_rows(table):
    """Uneven copies move the bins, which count every row that a merged one stands for."""
    uneven = settle(table.where("match_id % 40 < 3 OR match_id < 400"))
    neutral = {n: 0.0 for n in "abc"}
    plain = Forest(numTrees=4, maxDepth=4, weightCol="weight").fit(settle(train.model_input(uneven.drop("features"), ["a", "b", "c"], neutral))).trees
    rows = train.merged_input(uneven.drop("features"), ["a", "b", "c"], ["label"], neutral, "weight")
    assert rows.count() < uneven.count() and rows.agg(F.sum("copies")).first()[0] == uneven.count()
    assert same(plain, train.fit_counted(Forest(numTrees=4, maxDepth=4), rows, "weight").trees)


@pytest.mark.parametrize("features", [3, 9])
def test_rows_go_down_all_trees_together(features):
    """The same sums as tree by tree, on uneven trees, single leaves, classes and means; repeated rows are found as rows."""
    draw = np.random.default_rng(features)
    binned = draw.integers(0, 6, (500, features)).astype(np.uint8)
    own, place = forests._distinct(binned)
    assert len(own) == len(np.unique(binned, axis=0)) and np.array_equal(own[place], binned)
    for shape in ((2,), ()):
        uneven = boosting.Tree(*[np.array(a) for a in ([0, -1, features - 1, 1, -1, -1, -1], [2, 0, 4, 0, 0, 0, 0], [1, -1, 3, 5, -1, -1, -1],
                                                      [2, -1, 4, 6, -1, -1, -1])], draw.random((7, *shape)))
        leaf = boosting.Tree(*[np.array([n]) for n in (-1, 0, -1, -1)], draw.random((1, *shape)))
        plain = sum(t.values(own) for t in (uneven, leaf, uneven))
        assert np.array_equal(forests._sum_of_values([uneven, leaf, uneven], own), plain.reshape(len(own), -1))
