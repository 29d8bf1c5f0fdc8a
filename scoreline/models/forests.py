"""Random forests on a table of any size, as an estimator of ``pyspark.ml``.

Trees need nothing of the rows but their sums per (node, feature, bin). Features are binned once, and rows of
equal bins, label and weight become one row with their number: matches of one pairing and season have the same features, so
that a fit reads about as many rows as there are pairings. How often a tree draws a row with replacement
follows the Poisson law of its number of copies, which is the law of the sum of one draw for each copy. Where many labels
share few cells of bins, as in regressions, the draws of a cell are added up once, and a fit reads a row per cell.

A level of all trees is one job: tasks add up the sums of the open nodes, a shuffle brings the sums of a node
together, and the best split of each node, not its sums, reaches the driver. Nodes are taken in groups whose sums hold at
most ``MOST_SUMS`` numbers in a task. Sums are whole numbers, so that order, tasks and retries cannot change a tree.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol, HasSeed, HasWeightCol
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from ..storage import settle
from .boosting import UNIT, Bins, Tree, _arrays, fit_bins, uniform

#: Bins of a feature, as in the library's forests.
BINS = 32
#: Numbers that a task adds up in one pass.
MOST_SUMS = 1 << 24
#: Nodes whose splits are looked for side by side.
_CHUNK = 1024
#: Rows per cell of bins from which a regression reads sums of cells instead of rows.
_SHARED = 4
#: Cells whose sums a task holds while it adds up draws.
_HELD_CELLS = 1 << 14


class _Settings(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol, HasSeed, HasWeightCol):
    """What a forest and its model share; the names are those of the library's forests."""

    numTrees = Param(Params._dummy(), "numTrees", "number of trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "greatest depth of a leaf", TypeConverters.toInt)
    minInfoGain = Param(Params._dummy(), "minInfoGain", "least gain of a split", TypeConverters.toFloat)
    regression = Param(Params._dummy(), "regression", "means of a number instead of shares of classes", TypeConverters.toBoolean)
    copiesCol = Param(Params._dummy(), "copiesCol", "column with the number of rows that a row stands for", TypeConverters.toString)

    def setPredictionCol(self, value: str):
        return self._set(predictionCol=value)

    def setProbabilityCol(self, value: str):
        return self._set(probabilityCol=value)

    def setRawPredictionCol(self, value: str):
        return self._set(rawPredictionCol=value)

    def setWeightCol(self, value: str):
        return self._set(weightCol=value)

    def setCopiesCol(self, value: str):
        return self._set(copiesCol=value)


class Forest(Estimator, _Settings):
    """Trees on rows drawn with replacement. A classifier draws about the root of the number of features at every node."""

    @keyword_only
    def __init__(self, *, featuresCol: str = "features", labelCol: str = "label", predictionCol: str = "prediction", probabilityCol: str = "probability",
                 rawPredictionCol: str = "rawPrediction", weightCol: str | None = None, copiesCol: str | None = None, seed: int = 42, numTrees: int = 50,
                 maxDepth: int = 10, minInfoGain: float = 0.0, regression: bool = False) -> None:
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", predictionCol="prediction", probabilityCol="probability", rawPredictionCol="rawPrediction",
                         seed=42, numTrees=50, maxDepth=10, minInfoGain=0.0, regression=False)
        self._set(**{n: v for n, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> ForestModel:
        return self.fit_binned(df, fit_bins(df, self.getFeaturesCol(), BINS))

    def fit_binned(self, df: DataFrame, bins: Bins) -> ForestModel:
        """Fit with the bins of these features, which serve several labels."""
        regression, trees = self.getOrDefault("regression"), self.getOrDefault("numTrees")
        classes = 0 if regression else _classes(df, self.getLabelCol())
        rows = _drawn_rows(self, df, bins, trees)
        grower = _Grower(rows, self, len(bins.low), classes)
        for _ in range(self.getOrDefault("maxDepth")):
            if not grower.level():
                break
        model = ForestModel(bins, grower.trees(), grower.importances(), classes)
        return self._copyValues(model)


class ForestModel(Model, _Settings):
    """A fitted forest. The value of a leaf holds the shares of the classes, or one mean."""

    def __init__(self, bins: Bins, trees: list[Tree], importances: np.ndarray, classes: int) -> None:
        super().__init__()
        self.bins, self.trees, self.classes = bins, trees, classes
        self._importances = importances

    @property
    def featureImportances(self) -> DenseVector:
        return DenseVector(self._importances)

    @property
    def getNumTrees(self) -> int:
        return len(self.trees)

    def _transform(self, df: DataFrame) -> DataFrame:
        spark = df.sparkSession
        ship_package(spark)
        shared = spark.sparkContext.broadcast((self.bins, self.trees, max(self.classes, 1)))

        @F.arrow_udf("array<double>")
        def scored(column: pa.Array) -> pa.Array:
            bins, trees, width = shared.value
            total = np.zeros((0, width))
            if len(column):
                # Rows of equal bins take the same way through every tree.
                binned, place = _distinct(bins.apply(_arrays(column, len(bins.low))))
                total = (_sum_of_values(trees, binned) / len(trees))[place]
            return pa.ListArray.from_arrays(np.arange(len(total) + 1, dtype=np.int32) * width, total.ravel())

        name = f"_{self.uid}"
        df = df.withColumn(name, scored(vector_to_array(self.getFeaturesCol())))
        if not self.classes:
            return df.withColumn(self.getPredictionCol(), F.col(name)[0]).drop(name)
        votes = F.transform(F.col(name), lambda p: p * float(len(self.trees)))
        best = F.array_position(F.col(name), F.array_max(name)) - 1
        return df.withColumns({self.getRawPredictionCol(): array_to_vector(votes), self.getProbabilityCol(): array_to_vector(F.col(name)),
                               self.getPredictionCol(): best.cast("double")}).drop(name)


def _distinct(binned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows, and the place of every row among them. Up to eight bins are one number, which sorts faster than rows."""
    rows, features = binned.shape
    if features > 8:
        own, place = np.unique(binned, axis=0, return_inverse=True)
        return own, place.ravel()
    wide = np.zeros((rows, 8), np.uint8)
    wide[:, :features] = binned
    _, first, place = np.unique(wide.view(np.uint64).ravel(), return_index=True, return_inverse=True)
    return binned[first], place.ravel()


def _sum_of_values(trees: list[Tree], binned: np.ndarray) -> np.ndarray:
    """The sum over all trees of the values of each row's leaf.

    All rows go down a tree together, and leaves lead to themselves: a level takes fewer passes over the rows than
    to pick those still under way, as the trees of a forest are about equally deep everywhere.
    """
    count = len(binned)
    bins, rows = np.ascontiguousarray(binned.T).ravel(), np.arange(count)
    total = np.zeros((count, trees[0].value.shape[1] if trees[0].value.ndim > 1 else 1))
    for tree in trees:
        inner, own = tree.feature >= 0, np.arange(len(tree.feature))
        column = np.where(inner, tree.feature, 0) * count
        cut = np.where(inner, tree.cut, np.iinfo(np.uint8).max).astype(np.uint8)
        child = np.where(inner, [tree.left, tree.right], own).T.ravel()
        at, open_nodes = np.zeros(count, np.int64), own[:1][inner[:1]]
        while len(open_nodes):
            right = bins.take(column.take(at) + rows) > cut.take(at)
            at = child.take(2 * at + right)
            below = np.concatenate([tree.left[open_nodes], tree.right[open_nodes]])
            open_nodes = below[inner[below]]
        total += tree.value.take(at, axis=0).reshape(count, -1)
    return total


def _classes(df: DataFrame, label: str) -> int:
    """The number of classes: as the column says, or one more than the largest label; two at least."""
    named = df.schema[label].metadata.get("ml_attr", {}).get("vals")
    found = len(named) if named else int(df.agg(F.max(label)).first()[0] or 0) + 1
    return max(found, 2)


def _drawn_rows(forest: Forest, df: DataFrame, bins: Bins, trees: int) -> DataFrame:
    """The written input: bins, label, weight in units, and how often each tree draws the row."""
    ship_package(df.sparkSession)
    shared, features = df.sparkSession.sparkContext.broadcast(bins), len(bins.low)
    label = F.col(forest.getLabelCol()).cast("double")
    known = F.when(label.isNull() | F.isnan(label), F.raise_error("labels must not be NULL or NaN").cast("double")).otherwise(label)
    weight = F.col(forest.getWeightCol()).cast("double") if forest.isDefined("weightCol") else F.lit(1.0)
    copies = F.col(forest.getOrDefault("copiesCol")).cast("bigint") if forest.isDefined("copiesCol") else F.lit(1).cast("bigint")
    rows = df.select(known.alias("label"), weight.alias("weight"), copies.alias("copies"), vector_to_array(forest.getFeaturesCol()).alias("bins"))

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = shared.value.apply(_arrays(batch.column("bins"), features))
            yield batch.set_column(3, "bins", pa.array([r.tobytes() for r in own], pa.binary()))

    merged = rows.mapInArrow(binned, "label double, weight double, copies bigint, bins binary").groupBy("bins", "label", "weight").agg(
        F.sum("copies").alias("copies")).withColumn("row", F.xxhash64("bins", "label", "weight"))
    seed = forest.getSeed() & 0x7FFFFFFF

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, copies = batch.column("row").to_numpy().view(np.uint64), batch.column("copies").to_numpy()
            drawn = [np.random.default_rng([seed, int(r)]).poisson(n, trees).astype(np.int32).tobytes() for r, n in zip(rows, copies, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("label", "weight", "bins")] + [pa.array(drawn, pa.binary())], ["label", "weight", "bins", "drawn"])

    drawn = "label double, weight double, bins binary, drawn binary"
    if not forest.getOrDefault("regression"):
        return settle(merged.mapInArrow(draw, drawn), "drawn")
    merged = settle(merged, "counted")
    if merged.select("bins").distinct().count() * _SHARED > merged.count():
        return settle(merged.mapInArrow(draw, drawn), "drawn")

    def total(parts: Iterator[tuple[list[bytes], np.ndarray]]) -> Iterator[pa.RecordBatch]:
        """Sums of equal cells, given out whenever a task holds many."""
        held = {}
        for cells, sums in parts:
            for cell, own in zip(cells, sums, strict=True):
                if cell in held:
                    held[cell] += own
                else:
                    held[cell] = own.copy()
            if len(held) > _HELD_CELLS:
                yield _cells(held)
                held = {}
        yield _cells(held)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts():
            for batch in draw(batches):
                label, weight, counts = _draws(batch, trees)
                times = weight[:, None] * counts
                yield batch.column("bins").to_pylist(), np.stack([np.floor(times * label[:, None] + 0.5), times], axis=1).astype(np.int64)

        return total(parts())

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return total((b.column("bins").to_pylist(), np.frombuffer(b"".join(b.column("sums").to_pylist()), np.int64).reshape(-1, 2, trees)) for b in batches)

    cells = merged.mapInArrow(summed, "bins binary, sums binary").repartition("bins")
    return settle(cells.mapInArrow(joined, "bins binary, sums binary"), "drawn")


def _cells(held: dict[bytes, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array([s.tobytes() for s in held.values()], pa.binary())], ["bins", "sums"])


def _draws(batch: pa.RecordBatch, trees: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Label, weight in units, and the number of draws per row and tree."""
    drawn = np.frombuffer(b"".join(batch.column("drawn").to_pylist()), np.int32).reshape(-1, trees)
    return batch.column("label").to_numpy(), np.floor(batch.column("weight").to_numpy() * UNIT + 0.5), drawn


@dataclass
class _Open:
    """The nodes of one tree that a pass splits: their place among all of the pass, and the features they may use."""

    tree: int
    nodes: np.ndarray
    first: int
    columns: np.ndarray


class _Grower:
    """The trees of a forest under way, level by level."""

    def __init__(self, rows: DataFrame, forest: Forest, features: int, classes: int) -> None:
        self.rows, self.features, self.classes = rows, features, classes
        self.depth, self.least = forest.getOrDefault("maxDepth"), forest.getOrDefault("minInfoGain")
        self.seed, self.count = forest.getSeed() & 0x7FFFFFFF, forest.getOrDefault("numTrees")
        self.chosen = features if not classes else max(1, int(np.ceil(features ** 0.5)))
        self.width = classes or 2
        # Of every tree: feature, cut, left, right, name and sums of its nodes; the importance of its features.
        self.made = [([-1], [0], [-1], [-1], [1], [None]) for _ in range(self.count)]
        self.gained = np.zeros((self.count, features))
        self.open = [np.array([0]) for _ in range(self.count)]

    def _columns(self, tree: int, nodes: np.ndarray) -> np.ndarray:
        """The features drawn for each node."""
        if self.chosen == self.features:
            return np.tile(np.arange(self.features), (len(nodes), 1))
        names = np.array([self.made[tree][4][n] for n in nodes], np.uint64)
        order = uniform(names[:, None] * np.uint64(self.features) + np.arange(self.features, dtype=np.uint64), self.seed, tree)
        return np.sort(np.argsort(order, axis=1)[:, :self.chosen], axis=1)

    def level(self) -> bool:
        """Split every open node that gains by it; false if none is left."""
        most = max(1, MOST_SUMS // (self.chosen * BINS * self.width))
        waiting = [(t, nodes) for t, nodes in enumerate(self.open) if len(nodes)]
        self.open = [np.zeros(0, np.int64) for _ in range(self.count)]
        while waiting:
            group, size = [], 0
            while waiting and size < most:
                tree, nodes = waiting.pop(0)
                if len(nodes) > most - size:
                    waiting.insert(0, (tree, nodes[most - size:]))
                    nodes = nodes[:most - size]
                group.append(_Open(tree, nodes, size, self._columns(tree, nodes)))
                size += len(nodes)
            self._split(group, size)
        return any(len(nodes) for nodes in self.open)

    def _split(self, group: list[_Open], size: int) -> None:
        found = self._best(group, size)
        gain, place = found["gain"].to_numpy(), found["node"].to_numpy()
        slot, cut = found["slot"].to_numpy(), found["cut"].to_numpy()
        left, right = (_numbers(found[c], self.width) for c in ("left", "right"))
        first = np.array([o.first for o in group])
        for i in np.argsort(place).tolist():
            own = group[int(np.searchsorted(first, place[i], side="right")) - 1]
            at = int(place[i] - own.first)
            node = int(own.nodes[at])
            features, cuts, lefts, rights, names, sums = self.made[own.tree]
            whole = left[i] + right[i]
            if node == 0:
                sums[0] = whole
            if slot[i] < 0:
                continue
            weight, strength = self._weight(whole), self._strength(whole)
            if not gain[i] / weight > max(self.least, 1e-12 * strength / weight):
                continue
            features[node], cuts[node] = int(own.columns[at, slot[i]]), int(cut[i])
            self.gained[own.tree, features[node]] += gain[i]
            lefts[node], rights[node] = len(features), len(features) + 1
            for side, part in enumerate((left[i], right[i])):
                for array, value in zip((features, cuts, lefts, rights, names, sums), (-1, 0, -1, -1, 2 * names[node] + side, part), strict=True):
                    array.append(value)
            self.open[own.tree] = np.append(self.open[own.tree], [lefts[node], rights[node]])

    def _weight(self, sums: np.ndarray) -> float:
        return float(sums.sum() if self.classes else sums[1]) / UNIT

    def _strength(self, sums: np.ndarray) -> float:
        return float(_strength(sums.astype(float), self.classes)) / UNIT

    def _best(self, group: list[_Open], size: int) -> pa.Table:
        """The best split of every node of a group, and the sums of both its sides; slot -1 if it has none."""
        ship_package(self.rows.sparkSession)
        spark, features, chosen, width, classes = self.rows.sparkSession, self.features, self.chosen, self.width, self.classes
        shared = spark.sparkContext.broadcast((group, {o.tree: self._tree(o.tree, False) for o in group}))
        count, by_cell = self.count, "sums" in self.rows.columns

        def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            group, trees = shared.value
            cells = chosen * BINS * width
            total = np.zeros(size * cells, np.int64)
            lookup = {}
            for own in group:
                lookup[own.tree] = np.full(len(trees[own.tree].feature), -1, np.int64)
                lookup[own.tree][own.nodes] = np.arange(len(own.nodes))
            for batch in batches:
                binned = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, features)
                if by_cell:
                    sums = np.frombuffer(b"".join(batch.column("sums").to_pylist()), np.int64).reshape(-1, 2, count)
                else:
                    label, weight, drawn = _draws(batch, count)
                for own in group:
                    rows = np.flatnonzero(sums[:, 1, own.tree] if by_cell else drawn[:, own.tree])
                    node = lookup[own.tree][trees[own.tree].leaf(binned[rows])]
                    rows, node = rows[node >= 0], node[node >= 0]
                    if not len(rows):
                        continue
                    columns = own.columns[node]
                    place = ((node[:, None] * chosen + np.arange(chosen)) * BINS + binned[rows[:, None], columns]) * width
                    part = total[own.first * cells:(own.first + len(own.nodes)) * cells]
                    if by_cell:
                        _add(part, place, sums[rows, 0, own.tree])
                        _add(part, place + 1, sums[rows, 1, own.tree])
                        continue
                    times = weight[rows] * drawn[rows, own.tree]
                    if classes:
                        _add(part, place + label[rows].astype(np.int64)[:, None], times)
                    else:
                        _add(part, place, np.floor(times * label[rows] + 0.5))
                        _add(part, place + 1, times)
            total = total.reshape(size, cells)
            for at in range(0, size, _CHUNK):
                some = at + np.flatnonzero(total[at:at + _CHUNK].any(axis=1))
                yield pa.RecordBatch.from_arrays([pa.array(some), pa.array([total[n].tobytes() for n in some], pa.binary())], ["node", "sums"])

        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = {}
            for batch in batches:
                for node, raw in zip(batch.column("node").to_pylist(), batch.column("sums").to_pylist(), strict=True):
                    sums = np.frombuffer(raw, np.int64)
                    held[node] = held[node] + sums if node in held else sums
            nodes = sorted(held)
            for at in range(0, len(nodes), _CHUNK):
                some = nodes[at:at + _CHUNK]
                sums = np.stack([held[n] for n in some]).reshape(len(some), chosen, BINS, width)
                yield pa.RecordBatch.from_arrays([pa.array(some), *best_splits(sums, classes)], ["node", "gain", "slot", "cut", "left", "right"])

        sums = self.rows.mapInArrow(add_up, "node bigint, sums binary").repartition("node")
        return sums.mapInArrow(choose, "node bigint, gain double, slot int, cut int, left binary, right binary").toArrow()

    def _tree(self, number: int, valued: bool = True) -> Tree:
        features, cuts, lefts, rights, _, sums = self.made[number]
        arrays = [np.array(a, np.int64) for a in (features, cuts, lefts, rights)]
        if not valued:
            return Tree(*arrays, np.zeros(0))
        width = self.classes or 1
        values = np.full((len(features), width), 1.0 / width if self.classes else 0.0)
        for node, own in enumerate(sums):
            if own is not None and self._weight(own) > 0:
                values[node] = own / own.sum() if self.classes else own[0] / own[1]
        return Tree(*arrays, values)

    def trees(self) -> list[Tree]:
        return [self._tree(t) for t in range(self.count)]

    def importances(self) -> np.ndarray:
        """The mean over the trees of the share of the gain that each feature brought."""
        whole = self.gained.sum(axis=1, keepdims=True)
        shares = np.where(whole > 0, self.gained / np.where(whole > 0, whole, 1.0), 0.0).sum(axis=0)
        return shares / (shares.sum() or 1.0)


def _add(total: np.ndarray, place: np.ndarray, value: np.ndarray) -> None:
    total += np.bincount(place.ravel(), np.repeat(value, place.shape[1]), len(total)).astype(np.int64)


def _numbers(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(-1, width)


def _strength(sums: np.ndarray, classes: int) -> np.ndarray:
    """What the impurity of a node falls short of: squares of the classes' weights, or of the sum, over the weight."""
    weight = sums.sum(axis=-1) if classes else sums[..., 1]
    square = (sums ** 2).sum(axis=-1) if classes else sums[..., 0] ** 2
    return np.where(weight > 0, square / np.where(weight > 0, weight, 1.0), 0.0)


def best_splits(sums: np.ndarray, classes: int) -> tuple:
    """Gain, feature slot, cut and the sums of both sides of the best split per node, from sums of shape (nodes, slots, bins, width)."""
    left = np.cumsum(sums, axis=2)[:, :, :-1]
    whole = sums[:, 0].sum(axis=1)
    right = whole[:, None, None] - left
    gain = (_strength(left.astype(float), classes) + _strength(right.astype(float), classes) - _strength(whole.astype(float), classes)[:, None, None]) / UNIT
    weight = [part.sum(axis=-1) if classes else part[..., 1] for part in (left, right)]
    gain[(weight[0] <= 0) | (weight[1] <= 0)] = -np.inf
    flat = gain.reshape(len(sums), -1)
    best = flat.argmax(axis=1)
    slot, cut = np.divmod(best, left.shape[2])
    own = np.arange(len(sums))
    none = ~np.isfinite(flat[own, best])
    sides = [part[own, slot, cut].astype(np.int64) for part in (left, right)]
    return (pa.array(flat[own, best]), pa.array(np.where(none, -1, slot).astype(np.int32)), pa.array(cut.astype(np.int32)),
            *[pa.array([r.tobytes() for r in part], pa.binary()) for part in sides])
