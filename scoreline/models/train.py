"""Fitting models: the distributed estimators of ``pyspark.ml``, and the forests of ``forests``, which are one too.

``training_table`` prepares their input: fits read it repeatedly. ``merged`` makes one row of those with equal features,
and ``counted`` tells an estimator what such a row stands for.
"""

from __future__ import annotations

import random
from collections.abc import Iterable, Iterator, Mapping, Sequence
from functools import reduce
from itertools import product
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.stats import fit_standard
from ..storage import settle
from .boosting import fit_bins
from .forests import BINS, Forest

#: The number of rows that a merged row stands for, and that times their weight.
COPIES = "copies"
COPIES_WEIGHT = "copies_weight"
#: The feature that counts a row's missing ones.
MISSING = "n_missing"


def assemble(df: DataFrame, features: Sequence[str], invalid: str = "error", result: str = "features") -> DataFrame:
    """Add the feature vector; a missing feature is an error, or its row is skipped or kept."""
    return VectorAssembler(inputCols=list(features), outputCol=result, handleInvalid=invalid).transform(df)


def model_input(df: DataFrame, features: Sequence[str], neutral: Mapping[str, float] | None = None) -> DataFrame:
    """Add the feature vector of every row, alike for fits and predictions.

    A feature that is NULL or NaN takes its neutral value (0 if none is given), and one more
    feature, ``MISSING``, counts them.
    """
    known = {f: F.col(f).isNotNull() & ~F.isnan(F.col(f).cast("double")) for f in features}
    count = sum((F.when(k, 0.0).otherwise(1.0) for k in known.values()), F.lit(0.0))
    filled = {f: F.when(k, F.col(f).cast("double")).otherwise(F.lit(float((neutral or {}).get(f) or 0.0))) for f, k in known.items()}
    return assemble(df.withColumn(MISSING, count).withColumns(filled), [*features, MISSING])


def training_table(df: DataFrame, features: Sequence[str], row_key: Sequence[str], keep: Sequence[str],
                   neutral: Mapping[str, float] | None = None) -> DataFrame:
    """The written input of fits: ``keep`` and the feature vector of ``model_input``.

    Rows are spread by the hash of their key and sorted within a partition, so
    that all cores take part and bagging draws the same rows on every run.
    """
    spark = df.sparkSession
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = model_input(df, features, neutral).select(*keep, "features")
    return settle(rows.repartition(spread, *row_key).sortWithinPartitions(*row_key), "training")


def merged(df: DataFrame, keep: Sequence[str], weight: str | None = None, features: str = "features") -> DataFrame:
    """The written rows of ``df`` without repetition: ``keep``, features, their number and their weight in all.

    Matches of one pairing and season have the same features, so that fits read a row per pairing, not per match.
    """
    names = list(dict.fromkeys([*keep, *([weight] if weight else [])]))
    rows = df.groupBy(*names, vector_to_array(features).alias("_v")).agg(F.count(F.lit(1)).alias(COPIES))
    total = F.col(COPIES) * (F.col(weight).cast("double") if weight else F.lit(1.0))
    return settle(rows.select(*[F.col(n).alias(n, metadata=df.schema[n].metadata) for n in names], array_to_vector("_v").alias(features),
                              COPIES, total.alias(COPIES_WEIGHT)), "merged")


def merged_input(df: DataFrame, features: Sequence[str], keep: Sequence[str], neutral: Mapping[str, float] | None = None,
                 weight: str | None = None) -> DataFrame:
    """What ``merged`` makes of ``model_input``. Rows are counted before they have a vector, so that only merged rows are written.

    Rows with a number of ``COPIES`` stand for as many.
    """
    names, inputs = [*keep, *([weight] if weight else [])], [*features, MISSING]
    number = F.sum(COPIES) if COPIES in df.columns else F.count(F.lit(1))
    rows = model_input(df, features, neutral).groupBy(*names, *inputs).agg(number.alias(COPIES))
    total = F.col(COPIES) * (F.col(weight).cast("double") if weight else F.lit(1.0))
    return settle(rows.select(*names, array_to_vector(F.array(*inputs)).alias("features"), COPIES, total.alias(COPIES_WEIGHT)), "merged")


def fit_counted(forest: Forest, rows: DataFrame, weight: str | None = None) -> Model:
    """The forest of all rows that merged ``rows`` stand for: its bins count every one of them, too."""
    return counted(forest, weight).fit_binned(rows, fit_bins(rows, bins=BINS, copies=COPIES))


def counted(estimator: Estimator, weight: str | None = None) -> Estimator:
    """The estimator for rows of ``merged``: a forest draws as many rows as they stand for, others take it as a weight, which is the same."""
    if not isinstance(estimator, Forest):
        return estimator.copy().setWeightCol(COPIES_WEIGHT)
    made = estimator.copy().setCopiesCol(COPIES)
    return made.setWeightCol(weight) if weight else made


def _named(estimator: Estimator, name: str) -> Estimator:
    estimator = estimator.copy().setPredictionCol(f"pred_{name}")
    return estimator.setProbabilityCol(f"prob_{name}").setRawPredictionCol(f"raw_{name}")


def forest(label: str = "label", trees: int = 50, depth: int = 10, seed: int = 42, **extra) -> Forest:
    return Forest(labelCol=label, numTrees=trees, maxDepth=depth, seed=seed, **extra)


def boosted(label: str = "label", rounds: int = 50, depth: int = 5, step: float = 0.1, seed: int = 42,
            **extra) -> GBTClassifier:
    """Boosted trees for two classes."""
    return GBTClassifier(labelCol=label, maxIter=rounds, maxDepth=depth, stepSize=step, seed=seed, **extra)


def boosted_with_early_stop(label: str, validation: str, rounds: int = 500, tolerance: float = 0.01,
                            **extra) -> GBTClassifier:
    """Boosted trees that stop when the rows marked by ``validation`` gain no more."""
    return boosted(label, rounds, validationIndicatorCol=validation, validationTol=tolerance, **extra)


def logistic(label: str = "label", iterations: int = 1000, penalty: float = 0.0, **extra) -> LogisticRegression:
    return LogisticRegression(labelCol=label, maxIter=iterations, regParam=penalty, **extra)


def index_classes(df: DataFrame, column: str, result: str, invalid: str = "error") -> DataFrame:
    """Class numbers for a target with many values, such as the winning team itself; a row without a class is an error."""
    indexer = StringIndexer(inputCol=column, outputCol=result, stringOrderType="alphabetAsc", handleInvalid=invalid)
    return indexer.fit(df).transform(df)


def positive_probability(name: str = "probability") -> Column:
    return vector_to_array(name).getItem(1)


def fit_regressors(df: DataFrame, targets: Sequence[str], trees: int = 100, depth: int = 10,
                   seed: int = 42) -> dict[str, Model]:
    """One regression forest per target; every split may use every feature."""
    return {y: Forest(labelCol=y, predictionCol=f"{y}_pred", numTrees=trees, maxDepth=depth, regression=True, seed=seed).fit(df) for y in targets}


def importance_rows(df: DataFrame, model: Model, features: Sequence[str]) -> DataFrame:
    """Feature importances as rows, the largest first; ``df`` lends its session."""
    values = [(f, float(v)) for f, v in zip(features, model.featureImportances.toArray(), strict=True)]
    rows = df.sparkSession.createDataFrame(values, "feature string, importance double")
    return rows.orderBy(F.col("importance").desc(), "feature")


def importance_weights(df: DataFrame, role: str, features: Sequence[str], targets: Sequence[str],
                       trees: int = 100, depth: int = 10, seed: int = 42, most_roles: int = 100, parallelism: int = 4) -> DataFrame:
    """One row per role (NULL is one too): the importances of a forest fitted on the rows of that role.

    Importances are averaged over the targets and sum to 1. Rows are written once by role, and the
    bins of a role serve all targets. Each fit is a distributed job, and several run at a time; more than ``most_roles`` roles are an error.
    """
    roles = [r[0] for r in df.select(role).distinct().orderBy(role).limit(most_roles + 1).collect()]
    if len(roles) > most_roles:
        raise ValueError(f"more than {most_roles} roles")
    number = reduce(lambda rest, at: F.when(F.col(role).eqNullSafe(F.lit(roles[at])), at).otherwise(rest), range(len(roles)), F.lit(None).cast("int"))
    written = settle(df.select(number.alias("_role"), *dict.fromkeys([*features, *targets])), "by_role", ["_role"])
    parts = [assemble(written.where(F.col("_role") == at), features, invalid="skip") for at in range(len(roles))]
    forests = [Forest(labelCol=y, numTrees=trees, maxDepth=depth, regression=True, seed=seed) for y in targets]
    with ThreadPool(parallelism) as pool:
        bins = pool.map(lambda rows: fit_bins(rows, bins=BINS), parts, chunksize=1)
        models = pool.map(lambda job: job[2].fit_binned(*job[:2]), [(p, b, f) for p, b in zip(parts, bins, strict=True) for f in forests], chunksize=1)
    weights = []
    for at, value in enumerate(roles):
        found = [m.featureImportances.toArray() for m in models[at * len(targets):(at + 1) * len(targets)]]
        mean = sum(found) / len(found)
        total = mean.sum() or 1.0
        weights.append((value, *[float(v / total) for v in mean]))
    columns = ", ".join(f"`{f}` double" for f in features)
    kind = df.schema[role].dataType.simpleString()
    return df.sparkSession.createDataFrame(weights, f"`{role}` {kind}, {columns}")


def ols(df: DataFrame, target: str, predictors: Sequence[str]) -> DataFrame:
    """Least squares with a constant: coefficient, standard error, t and p per term, and R2.

    Rows that lack a predictor are left out. The predictors must not add up to a constant; of counts that do, leave one out.
    """
    rows = assemble(df, predictors, invalid="skip").select("features", F.col(target).cast("double").alias(target))
    fit = LinearRegression(labelCol=target, solver="normal", regParam=0.0).fit(rows)
    summary = fit.summary
    terms = zip([*predictors, "const"], [*fit.coefficients.toArray(), fit.intercept],
                summary.coefficientStandardErrors, summary.tValues, summary.pValues, strict=True)
    values = [(n, *[float(v) for v in rest], float(summary.r2)) for n, *rest in terms]
    return df.sparkSession.createDataFrame(
        values, "term string, coefficient double, std_error double, t_value double, p_value double, r2 double")


def kmeans_roles(df: DataFrame, features: Sequence[str], clusters: int = 3, seed: int = 42,
                 result: str = "role_cluster", iterations: int = 300) -> tuple[DataFrame, DataFrame]:
    """Cluster standardised rows: the rows with their cluster, and the centres in units.

    Rows that lack a feature are left out.

    Clusters are numbered by descending first feature of their centre, so the
    numbers do not depend on the start of the search.
    """
    scaling = fit_standard(df, features)
    scaled = {f: f"_z_{f}" for f in features}
    rows = assemble(scaling.apply(df, scaled), list(scaled.values()), invalid="skip", result="_z")
    fit = KMeans(k=clusters, seed=seed, maxIter=iterations, featuresCol="_z", predictionCol="_cluster").fit(rows)
    centres = [[float(v) * scaling.scale[f] + scaling.shift[f] for f, v in zip(features, c, strict=True)]
               for c in fit.clusterCenters()]
    order = sorted(range(len(centres)), key=lambda i: centres[i], reverse=True)
    numbers = F.array(*[F.lit(order.index(i)) for i in range(len(centres))])
    marked = fit.transform(rows).withColumn(result, numbers[F.col("_cluster")])
    table = df.sparkSession.createDataFrame(
        [(n, *centres[i]) for n, i in enumerate(order)],
        f"{result} int, " + ", ".join(f"`{f}` double" for f in features))
    return marked.drop("_cluster", "_z", *scaled.values()), table


def _fit_all(jobs: Sequence[tuple[Estimator, DataFrame]], parallelism: int) -> list[Model]:
    """Run several fits at a time, so that the short stages of one fill the gaps of another."""
    with ThreadPool(parallelism) as pool:
        return pool.map(lambda job: job[0].fit(job[1]), jobs, chunksize=1)


def fit_members(df: DataFrame, members: Mapping[str, Estimator], parallelism: int = 2) -> dict[str, Model]:
    """Fit named classifiers whose output columns do not collide; they have one label column and no weights. Rows may be merged already."""
    rows = df if COPIES_WEIGHT in df.columns else merged(df, list(dict.fromkeys(e.getLabelCol() for e in members.values())))
    models = _fit_all([(counted(_named(estimator, name)), rows) for name, estimator in members.items()], parallelism)
    return dict(zip(members, models, strict=True))


def soft_vote(df: DataFrame, models: Mapping[str, Model], result: str = "vote") -> DataFrame:
    """Add the mean class-1 probability of the members and the class it gives."""
    for name, model in models.items():
        df = model.transform(df).withColumn(f"p_{name}", positive_probability(f"prob_{name}")).drop(
            f"prob_{name}", f"raw_{name}", f"pred_{name}")
    return average_vote(df, [f"p_{n}" for n in models], result)


def average_vote(df: DataFrame, probabilities: Sequence[str], result: str = "vote") -> DataFrame:
    """Add the mean of the probability columns and the class it gives."""
    mean = sum((F.col(p) for p in probabilities), F.lit(0.0)) / F.lit(len(probabilities))
    return df.withColumn(f"{result}_prob", mean).withColumn(result, (mean > 0.5).cast("int"))


def vote_grid_search(df: DataFrame, members: Mapping[str, Mapping[str, Estimator]], fold: str,
                     label: str = "label", parallelism: int = 4) -> DataFrame:
    """Accuracy of every combination of member settings, the best first.

    ``members`` maps a member to its named settings. Every setting is fitted
    once per fold; all combinations are then scored in one pass over its
    probability columns.
    """
    settings = {f"{m}_{s}": e for m, group in members.items() for s, e in group.items()}
    folds = [r[0] for r in df.select(fold).distinct().orderBy(fold).collect()]
    scored = None
    for number in folds:
        models = fit_members(df.where(F.col(fold) != number), settings, parallelism)
        held = soft_vote(df.where(F.col(fold) == number), models).select(
            label, F.lit(number).alias(fold), *[f"p_{s}" for s in settings])
        scored = held if scored is None else scored.unionByName(held)

    return combination_scores(scored, members, fold, label)


def combination_scores(scored: DataFrame, members: Mapping[str, Iterable[str]], fold: str,
                       label: str = "label") -> DataFrame:
    """The mean accuracy over the folds of every combination, the best first.

    ``scored`` has a column ``p_<member>_<setting>`` with the probability of
    class 1 for every member and setting.
    """
    combinations = list(product(*[[f"{m}_{s}" for s in settings] for m, settings in members.items()]))
    settings = list(dict.fromkeys(s for c in combinations for s in c))
    # Column j averages the settings of combination j.
    weights = np.zeros((len(settings), len(combinations)))
    for j, combination in enumerate(combinations):
        for name in combination:
            weights[settings.index(name), j] = 1.0 / len(combination)

    def hits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            votes = frame[settings].to_numpy(dtype=float) @ weights > 0.5
            right = votes == (frame["label"].to_numpy(dtype=float) == 1.0)[:, None]
            for number, places in frame.groupby("fold").indices.items():
                yield pd.DataFrame({"fold": int(number), "combination": range(len(combinations)),
                                    "hits": right[places].sum(axis=0), "rows": len(places)})

    columns = [F.col(fold).cast("bigint").alias("fold"), F.col(label).cast("double").alias("label"),
               *[F.col(f"p_{s}").alias(s) for s in settings]]
    counted = scored.select(*columns).mapInPandas(hits, "fold bigint, combination int, hits bigint, rows bigint")
    per_fold = counted.groupBy("fold", "combination").agg((F.sum("hits") / F.sum("rows")).alias("accuracy"))
    means = per_fold.groupBy("combination").agg(F.avg("accuracy").alias("mean_accuracy"))
    names = F.array(*[F.struct(*[F.lit(s).alias(m) for m, s in zip(members, c, strict=True)]) for c in combinations])
    return means.select(names[F.col("combination")].alias("c"), "mean_accuracy").select(
        "c.*", "mean_accuracy").orderBy(F.col("mean_accuracy").desc(), *members)


def random_search(df: DataFrame, estimator: Estimator, grid: Mapping[str, Sequence], draws: int, fold: str,
                  folds: int, seed: int = 42, parallelism: int = 2) -> tuple[Model, DataFrame]:
    """Cross-validate a seeded draw of settings: the best model and one row per setting."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    settings = builder.build()
    drawn = random.Random(seed).sample(settings, min(draws, len(settings)))
    measure = MulticlassClassificationEvaluator(labelCol=estimator.getLabelCol(), metricName="accuracy")
    search = CrossValidator(estimator=estimator, estimatorParamMaps=drawn, evaluator=measure, numFolds=folds,
                            foldCol=fold, parallelism=parallelism).fit(df)
    rows = [("; ".join(f"{p.name}={v}" for p, v in sorted(s.items(), key=lambda kv: kv[0].name)), float(a))
            for s, a in zip(drawn, search.avgMetrics, strict=True)]
    table = df.sparkSession.createDataFrame(rows, "setting string, mean_accuracy double")
    return search.bestModel, table.orderBy(F.col("mean_accuracy").desc(), "setting")


def cross_val_scores(df: DataFrame, estimator: Estimator, fold: str, label: str = "label",
                     parallelism: int = 4) -> DataFrame:
    """The accuracy on each held-out fold, one row per fold."""
    folds = [r[0] for r in df.select(fold).distinct().orderBy(fold).collect()]
    rows = merged(df, [fold, label])
    models = _fit_all([(counted(estimator), rows.where(F.col(fold) != number)) for number in folds], parallelism)
    scored = None
    for number, model in zip(folds, models, strict=True):
        held = model.transform(df.where(F.col(fold) == number))
        held = held.select(fold, (F.col("prediction") == F.col(label)).cast("double").alias("hit"))
        scored = held if scored is None else scored.unionByName(held)
    return scored.groupBy(fold).agg(F.avg("hit").alias("accuracy"), F.count("hit").alias("rows"))
