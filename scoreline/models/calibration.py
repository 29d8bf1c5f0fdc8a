"""Platt scaling across folds: every row is scored by a model that has not seen it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import settle
from .train import _fit_all, counted, merged, positive_probability

#: What a calibrator's equations may differ from zero by, a row.
TOLERANCE = 1e-12


def out_of_fold(df: DataFrame, estimator: Estimator, fold: str = "fold", label: str = "label", keep: Sequence[str] = (),
                parallelism: int = 4) -> tuple[dict[int, Model], DataFrame]:
    """A model per fold, fitted on the others, and the written scores (probability of class 1) of every row by its fold's model."""
    folds = [r[0] for r in df.select(fold).distinct().orderBy(fold).collect()]
    rows = merged(df, [fold, label])
    models = dict(zip(folds, _fit_all([(counted(estimator), rows.where(F.col(fold) != n)) for n in folds], parallelism), strict=True))
    parts = [m.transform(df.where(F.col(fold) == n)).select(F.col(fold).alias("fold"), F.col(label).cast("double").alias("label"),
                                                           positive_probability().alias("score"), *keep) for n, m in models.items()]
    return models, settle(reduce(DataFrame.unionByName, parts), "scores")


def with_targets(scores: DataFrame) -> DataFrame:
    """Add the smoothed targets of each fold: a share short of 1 or 0, so that no calibrator runs off to infinity."""
    n = scores.groupBy("fold").agg(F.sum("label").alias("_positive"), F.sum(1 - F.col("label")).alias("_negative"))
    target = F.when(F.col("label") == 1, (F.col("_positive") + 1) / (F.col("_positive") + 2)).otherwise(1 / (F.col("_negative") + 2))
    return settle(scores.join(n, "fold").withColumn("target", target).drop("_positive", "_negative"), "targets")


def _by_fold(values: Mapping[int, float]) -> Column:
    return F.create_map(*[F.lit(v) for pair in values.items() for v in (pair[0], float(pair[1]))])[F.col("fold")]


def calibrated(score: Column, slope: Column | float, shift: Column | float) -> Column:
    return 1 / (1 + F.exp(-(score * slope + shift)))


def equations(targets: DataFrame, calibrators: Mapping[int, tuple[float, float]]) -> DataFrame:
    """Per fold: rows, loss, what the equations of the fit leave (``rest_shift``, ``rest_slope``) and their derivatives."""
    p = calibrated(F.col("score"), _by_fold({n: c[0] for n, c in calibrators.items()}), _by_fold({n: c[1] for n, c in calibrators.items()}))
    s, t = F.col("score"), F.col("target")
    rows = targets.withColumn("p", F.greatest(F.lit(1e-300), F.least(F.lit(1 - 1e-16), p)))
    p = F.col("p")
    loss = -(t * F.ln(p) + (1 - t) * F.ln(1 - p))
    sums = {"loss": loss, "rest_shift": p - t, "rest_slope": (p - t) * s, "h00": p * (1 - p), "h01": p * (1 - p) * s, "h11": p * (1 - p) * s * s}
    return rows.groupBy("fold").agg(F.count(F.lit(1)).alias("rows"), *[F.sum(c).alias(n) for n, c in sums.items()])


def fit_platt(targets: DataFrame, steps: int = 50) -> dict[int, tuple[float, float]]:
    """Slope and shift of each fold's logistic function: Newton steps for all folds in one aggregate, halved where they do not help."""
    at = {r["fold"]: np.array([0.0, np.log(r["t"] / (1 - r["t"]))]) for r in targets.groupBy("fold").agg(F.avg("target").alias("t")).collect()}

    def look(where: Mapping[int, np.ndarray]) -> dict:
        return {r["fold"]: r for r in equations(targets, {n: tuple(v.tolist()) for n, v in where.items()}).collect()}

    def rest(r) -> np.ndarray:
        return np.array([r["rest_slope"], r["rest_shift"]])

    seen = look(at) if at else {}
    for _ in range(steps):
        open_folds = [n for n, r in seen.items() if np.abs(rest(r)).max() > TOLERANCE * r["rows"]]
        if not open_folds:
            break
        step = {n: np.linalg.lstsq(np.array([[r["h11"], r["h01"]], [r["h01"], r["h00"]]]), rest(r), rcond=None)[0] for n, r in seen.items()}
        size = {n: float(n in open_folds) for n in seen}
        for _ in range(30):
            tried = {n: at[n] - size[n] * step[n] for n in at}
            found = look(tried)
            worse = [n for n in open_folds if found[n]["loss"] > seen[n]["loss"] * (1 + 1e-12)]
            if not worse:
                break
            size = {n: size[n] / 2 if n in worse else size[n] for n in size}
        at, seen = tried, found
    return {n: (float(v[0]), float(v[1])) for n, v in at.items()}


def apply(df: DataFrame, models: Mapping[int, Model], calibrators: Mapping[int, tuple[float, float]], result: str = "calibrated_prob") -> DataFrame:
    """Add the mean of what the folds' models say, each read by its own calibrator."""
    made = []
    for n, model in models.items():
        scored = model.transform(df)
        df = scored.withColumn(f"_cal_{n}", calibrated(positive_probability(), *[F.lit(v) for v in calibrators[n]])).drop(
            *[c for c in scored.columns if c not in df.columns])
        made.append(F.col(f"_cal_{n}"))
    return df.withColumn(result, sum(made[1:], made[0]) / len(made)).drop(*[f"_cal_{n}" for n in models])
