"""Searches over settings, each fit a task of its own.

A search fits many settings on the same rows. They are a bounded sample of the labelled rows, at most
about ``FIT_ROWS``, drawn by the hash of their key and broadcast once, binned; Spark spreads the
fits (setting and fold), and a lost executor costs the fits that it ran. Nothing is fitted twice: a boosted model of 200
rounds holds those of 50 and 100, a forest of 200 trees those of fewer.
"""

from __future__ import annotations

import pickle
import random
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, replace
from itertools import product

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from ..storage import settle
from . import boosting
from .boosting import Bins, Model, Settings, Tree
from .train import combination_scores

#: Labelled rows that a search fits on, at most (about).
FIT_ROWS = 50_000
#: Trees of a forest that one task grows.
BLOCK = 25
#: The settings drawn from, 972 in all (fixed values: they must be those of the searches users know).
BOOSTED_SETTINGS = {
    "leaves": [15, 31, 63],
    "depth": [-1, 10, 20, 30],
    "step": [0.01, 0.05, 0.1],
    "rounds": [500],
    "rows": [0.6, 0.8, 1.0],
    "columns": [0.6, 0.8, 1.0],
    "child_weight": [0.1, 1, 3],
    "gain": [0.1],
}
#: The settings of the three voting members, 324 combinations (fixed values, as above); depth -1 is unlimited.
VOTE_SETTINGS = {"trees": [50, 100, 200], "depths": [5, 10, -1], "steps": [0.01, 0.1, 0.2], "rounds": [50, 100, 200], "strengths": [0.01, 0.1, 1, 10]}
#: Boosted voting members: trees of depth 6, a row and a unit of weight in a leaf, a unit of penalty.
VOTE_TREES = Settings(leaves=64, depth=6, least_rows=1, child_weight=1.0, penalty=1.0)


@dataclass(frozen=True)
class Sample:
    """Rows in memory: binned and plain features, label, weight, fold (-1: watched), row number."""

    bins: Bins
    binned: np.ndarray
    values: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    fold: np.ndarray
    row: np.ndarray


def sample(df: DataFrame, bins: Bins, fold: str = "fold", label: str = "label", weight: str | None = None, watched: str | None = None,
           row_key: str = "match_id", features: str = "features", most: int = FIT_ROWS) -> Sample:
    """At most about ``most`` rows of a written table, the same under any partitioning; all of them if there are fewer."""
    share = min(1.0, most / max(df.count(), 1))
    drawn = df.where(F.pmod(F.xxhash64(F.lit(17), F.col(row_key)), F.lit(1_000_000)) < round(share * 1_000_000))
    place = F.when(F.col(watched).cast("boolean"), -1).otherwise(F.col(fold)) if watched else F.col(fold)
    rows = drawn.select(F.xxhash64(row_key).alias("row"), F.col(label).cast("double").alias("label"), place.cast("int").alias("fold"),
                        (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("weight"), vector_to_array(features).alias("values"))
    table = rows.toArrow().sort_by([("row", "ascending"), ("label", "ascending")])
    values = np.array(table["values"].to_pylist(), float).reshape(table.num_rows, len(bins.low))
    label, weight, fold, row = (table[c].to_numpy() for c in ("label", "weight", "fold", "row"))
    return Sample(bins, bins.apply(values), values, label, weight, fold, row)


def run_fits(spark: SparkSession, shared: Broadcast, jobs: Sequence[tuple], fit: Callable[[Sample, tuple], pd.DataFrame], schema: str) -> DataFrame:
    """The written results of ``fit`` for every job, each in a task of its own."""
    ship_package(spark)
    jobs = list(jobs)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for number in frame["id"]:
                yield fit(shared.value, jobs[number])

    return settle(spark.range(0, len(jobs), 1, len(jobs)).mapInPandas(work, schema), "fits")


def drawn_settings(grid: Mapping[str, Sequence], draws: int, seed: int = 42, **fixed) -> list[Settings]:
    """A seeded draw without repetition from all combinations of ``grid``."""
    names = list(grid)
    combinations = list(product(*[grid[n] for n in names]))
    chosen = random.Random(seed).sample(combinations, min(draws, len(combinations)))
    return [Settings(**dict(zip(names, c, strict=True)), **fixed) for c in chosen]


def described(settings: Settings, names: Sequence[str]) -> str:
    return "; ".join(f"{n}={getattr(settings, n)}" for n in names)


def random_search(spark: SparkSession, rows: Sample, settings: Sequence[Settings], patience: int = 50, names: Sequence[str] | None = None) -> DataFrame:
    """One row per setting, the best first: setting, mean accuracy over the folds, mean number of rounds kept, folds.

    Every fold's model learns from the other folds and stops when the watched rows (fold -1; without any, all rounds
    are used) have gained nothing for ``patience`` rounds.
    """
    folds = sorted(set(rows.fold[rows.fold >= 0].tolist()))
    jobs = [(i, fold, s) for i, s in enumerate(settings) for fold in folds]
    shared = spark.sparkContext.broadcast(rows)

    def fit(own: Sample, job: tuple) -> pd.DataFrame:
        number, fold, setting = job
        start, trees = _boosted(own, setting, (own.fold >= 0) & (own.fold != fold), patience)
        held = own.fold == fold
        right = (Model(own.bins, start, trees).margins(own.binned[held]) > 0) == (own.label[held] > 0.5)
        return pd.DataFrame({"number": [number], "fold": [fold], "hits": [int(right.sum())], "rows": [int(held.sum())], "rounds": [len(trees)]})

    found = run_fits(spark, shared, jobs, fit, "number int, fold int, hits bigint, rows bigint, rounds int")
    names = list(names or BOOSTED_SETTINGS)
    told = F.array(*[F.lit(described(s, names)) for s in settings])
    means = found.groupBy("number").agg(F.avg(F.col("hits") / F.col("rows")).alias("mean_accuracy"), F.avg("rounds").alias("mean_rounds"), F.count(F.lit(1)).alias("folds"))
    return means.select(told[F.col("number")].alias("setting"), "number", "mean_accuracy", "mean_rounds", "folds").orderBy(F.col("mean_accuracy").desc(), "number")


def _boosted(own: Sample, settings: Settings, part: np.ndarray, patience: int) -> tuple[float, list[Tree]]:
    watched = own.fold < 0
    pair = (own.binned[watched], own.label[watched]) if watched.any() else None
    return boosting.boost_rows(settings, own.binned[part], own.label[part], own.weight[part], own.row[part], pair, patience)


def fit_boosted(spark: SparkSession, rows: Sample, settings: Settings, patience: int = 50) -> Model:
    """A model of the sample's rows, fitted by one task."""
    def fit(own: Sample, job: tuple) -> pd.DataFrame:
        start, trees = _boosted(own, job[0], own.fold >= 0, patience)
        return pd.DataFrame({"model": [pickle.dumps((start, trees))]})

    made = run_fits(spark, spark.sparkContext.broadcast(rows), [(settings,)], fit, "model binary").first()[0]
    return Model(rows.bins, *pickle.loads(bytes(made)))


# --- voting


def newton_logistic(values: np.ndarray, label: np.ndarray, strength: float, steps: int = 100) -> np.ndarray:
    """Coefficients, then the constant, that minimise strength * log loss + half the square of the coefficients."""
    x = np.column_stack([values, np.ones(len(values))])
    penalty = np.diag([1.0] * values.shape[1] + [0.0])
    beta = np.zeros(x.shape[1])

    def cost(b: np.ndarray) -> float:
        return strength * boosting.losses(x @ b, label).sum() + b @ penalty @ b / 2

    for _ in range(steps):
        p = boosting.probability(x @ beta)
        slope = strength * (x.T @ (p - label)) + penalty @ beta
        step = np.linalg.lstsq(strength * (x.T * (p * (1 - p))) @ x + penalty, slope, rcond=None)[0]
        size = 1.0
        while size > 1e-10 and cost(beta - size * step) > cost(beta):
            size /= 2
        beta = beta - size * step
        if np.abs(slope).max() < 1e-9 * max(len(label), 1):
            break
    return beta


def member_names(trees, depths, steps, rounds, strengths) -> dict[str, list[str]]:
    """The settings of each member by name; a column name with a dot would need back-ticks."""
    def name(text: str) -> str:
        return text.replace(".", "_")

    return {"rf": [f"trees{n}_depth{'All' if d < 0 else d}" for n in trees for d in depths],
            "gbt": [name(f"step{s}_rounds{n}") for s in steps for n in rounds], "lr": [name(f"c{c}") for c in strengths]}


def _member_jobs(grid: Mapping[str, Sequence]) -> list[tuple]:
    """The fits whose prefixes are all settings: blocks of the largest forests, the longest boosting, every penalty."""
    most = max(grid["trees"])
    blocks = [("rf", d, range(at, min(at + BLOCK, most))) for d in grid["depths"] for at in range(0, most, BLOCK)]
    return [*blocks, *[("gbt", s, max(grid["rounds"])) for s in grid["steps"]], *[("lr", c, None) for c in grid["strengths"]]]


def vote_search(spark: SparkSession, rows: Sample, grid: Mapping[str, Sequence] = VOTE_SETTINGS) -> DataFrame:
    """The mean accuracy over the folds of every combination of member settings, the best first."""
    folds = sorted(set(rows.fold[rows.fold >= 0].tolist()))
    jobs = [(fold, *job) for fold in folds for job in _member_jobs(grid)]
    members = member_names(**grid)

    def fit(own: Sample, job: tuple) -> pd.DataFrame:
        fold, member, setting, extent = job
        taught, held = (own.fold >= 0) & (own.fold != fold), own.fold == fold
        binned, label = own.binned[taught], own.label[taught]
        made = {}
        if member == "rf":
            # The share of each forest that this block's trees hold.
            names = {n: f"trees{n}_depth{'All' if setting < 0 else setting}" for n in grid["trees"]}
            total = dict.fromkeys(names, 0.0)
            for number, tree in zip(extent, boosting.forest_trees(extent, setting, binned, label, own.row[taught]), strict=True):
                values = tree.values(own.binned[held])
                for n in names:
                    total[n] = total[n] + (values / n if number < n else 0.0)
            made = {f"rf_{names[n]}": total[n] for n in names}
        elif member == "gbt":
            start, trees = boosting.boost_rows(replace(VOTE_TREES, step=setting, rounds=extent), binned, label, own.weight[taught], own.row[taught])
            margin = np.full(held.sum(), start)
            for number, tree in enumerate(trees, 1):
                margin = margin + tree.values(own.binned[held])
                if number in grid["rounds"]:
                    made["gbt_" + f"step{setting}_rounds{number}".replace(".", "_")] = boosting.probability(margin)
        else:
            beta = newton_logistic(own.values[taught], label, setting)
            made["lr_" + f"c{setting}".replace(".", "_")] = boosting.probability(own.values[held] @ beta[:-1] + beta[-1])
        place = np.flatnonzero(held)
        return pd.concat([pd.DataFrame({"fold": fold, "place": place, "label": own.label[held].astype(int), "name": n, "p": p}) for n, p in made.items()])

    found = run_fits(spark, spark.sparkContext.broadcast(rows), jobs, fit, "fold int, place bigint, label int, name string, p double")
    names = [f"{m}_{s}" for m, group in members.items() for s in group]
    wide = found.groupBy("fold", "place", "label").agg(*[F.sum(F.when(F.col("name") == n, F.col("p"))).alias(f"p_{n}") for n in names])
    return combination_scores(settle(wide, "votes"), members, "fold")


@dataclass
class Vote:
    """Three fitted members whose probabilities are averaged."""

    bins: Bins
    forest: list[Tree]
    boosted: Model
    beta: np.ndarray

    def probabilities(self, values: np.ndarray) -> np.ndarray:
        """A column per member: forest, boosted trees, logistic."""
        binned = self.bins.apply(values)
        forest = np.zeros(len(values))
        for tree in self.forest:
            forest += tree.values(binned)
        return np.column_stack([forest / max(len(self.forest), 1), boosting.probability(self.boosted.margins(binned)),
                                boosting.probability(values @ self.beta[:-1] + self.beta[-1])])

    def predict(self, df: DataFrame, features: str = "features", result: str = "vote") -> DataFrame:
        """Add the mean probability of class 1 and the class it gives."""
        shared = df.sparkSession.sparkContext.broadcast(self)
        ship_package(df.sparkSession)

        @F.pandas_udf("double")
        def voted(values):
            return pd.Series(shared.value.probabilities(np.array(values.tolist(), float)).mean(axis=1))

        return df.withColumn(f"{result}_prob", voted(vector_to_array(features))).withColumn(result, (F.col(f"{result}_prob") > 0.5).cast("int"))


def fit_vote(spark: SparkSession, rows: Sample, best: Mapping[str, str], grid: Mapping[str, Sequence] = VOTE_SETTINGS) -> Vote:
    """The members of one combination (a row of ``vote_search``), fitted on all rows of the sample."""
    names = member_names(**grid)
    forest = list(product(grid["trees"], grid["depths"]))[names["rf"].index(best["rf"].removeprefix("rf_"))]
    gbt = list(product(grid["steps"], grid["rounds"]))[names["gbt"].index(best["gbt"].removeprefix("gbt_"))]
    lr = grid["strengths"][names["lr"].index(best["lr"].removeprefix("lr_"))]
    jobs = [("rf", forest[1], range(at, min(at + BLOCK, forest[0]))) for at in range(0, forest[0], BLOCK)] + [("gbt", *gbt), ("lr", lr, None)]

    def fit(own: Sample, job: tuple) -> pd.DataFrame:
        member, setting, extent = job
        taught = own.fold >= 0
        binned, label = own.binned[taught], own.label[taught]
        if member == "rf":
            made = list(boosting.forest_trees(extent, setting, binned, label, own.row[taught]))
        elif member == "gbt":
            made = boosting.boost_rows(replace(VOTE_TREES, step=setting, rounds=extent), binned, label, own.weight[taught], own.row[taught])
        else:
            made = newton_logistic(own.values[taught], label, setting)
        return pd.DataFrame({"member": [member], "first": [extent.start if member == "rf" else 0], "made": [pickle.dumps(made)]})

    found = run_fits(spark, spark.sparkContext.broadcast(rows), jobs, fit, "member string, first int, made binary").orderBy("member", "first").collect()
    made = {m: [pickle.loads(bytes(r["made"])) for r in found if r["member"] == m] for m in names}
    return Vote(rows.bins, [tree for block in made["rf"] for tree in block], Model(rows.bins, *made["gbt"][0]), made["lr"][0])
