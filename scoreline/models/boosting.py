"""Trees over binned features, grown leaf by leaf from sums of derivatives.

Features are binned once. A tree needs nothing of the rows but, per node, feature and bin, the sums of
the first and second derivatives of the loss and the number of rows. ``grow`` asks for these sums a
level at a time and splits the leaf of the largest gain first. Derivatives are whole
numbers (multiples of 1 / ``UNIT``), so the sums do not depend on the order of rows, on tasks or retries.

The sums come from one of two places:

- ``Fit`` keeps the rows in a written table, whose batches the executors hold as blocks of bytes (in memory, else on disk). Every level
  of a tree is one aggregate over the blocks; the sums alone reach the driver, never rows. A level is a job of the RDD API, as a plan of
  its own for each would take longer than its work. Each row keeps its margin, written anew every ``KEEP`` rounds. A fit goes on for as many rounds as asked.
  A row may stand for ``copies`` rows of equal bins, label and weight: matches of one pairing and season have the same features,
  so that a fit reads as many rows as there are pairings, whatever the number of matches. The sums are the same.
- ``LocalRows`` holds a bounded sample of rows inside a task, for searches that fit many settings side by side.

A forest is the same with derivatives that make a leaf the share of its label, drawn rows and drawn features per node.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from ..storage import settle

#: Bins of a feature; cells of equal width they are made of.
BINS = 63
CELLS = 1 << 14
#: The smallest step of a derivative.
UNIT = 1 << 20
#: Rounds after which the margins of rows are written anew.
KEEP = 25
#: Partitions whose sums go to the driver as they are; those of more are added up by tasks before.
_DIRECT = 32


@dataclass(frozen=True)
class Settings:
    """How to grow trees. ``depth`` -1 is unlimited; ``rows`` and ``columns`` are shares drawn for a tree."""

    rounds: int = 100
    leaves: int = 31
    depth: int = -1
    step: float = 0.1
    rows: float = 1.0
    columns: float = 1.0
    child_weight: float = 1e-3
    least_rows: int = 20
    gain: float = 0.0
    penalty: float = 0.0
    seed: int = 42


@dataclass(frozen=True)
class Bins:
    """The bin of every cell of every feature."""

    low: np.ndarray
    width: np.ndarray
    of_cell: np.ndarray

    def apply(self, values: np.ndarray) -> np.ndarray:
        """A row of bins for each row of features; what lies outside the fitted range falls into the outer bins."""
        return self.of_cell[np.arange(len(self.low)), cells_of(values, self.low, self.width)]


def cells_of(values: np.ndarray, low: np.ndarray, width: np.ndarray) -> np.ndarray:
    scaled = np.floor((values - low) / np.where(width > 0, width, 1.0) * CELLS)
    return np.clip(np.nan_to_num(scaled), 0, CELLS - 1).astype(np.int64)


def bins_of(counts: np.ndarray, low: np.ndarray, width: np.ndarray, bins: int = BINS) -> Bins:
    """Bins from the rows per (feature, cell): a cell lies in the bin that the share of rows below it falls into."""
    below = np.cumsum(counts, axis=1) - counts
    return Bins(low, width, (below * bins // np.maximum(counts.sum(axis=1, keepdims=True), 1)).astype(np.uint8))


@dataclass
class Tree:
    """Nodes in arrays: a row goes left if the bin of the node's feature is at most ``cut``; ``feature`` -1 is a leaf."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def leaf(self, binned: np.ndarray) -> np.ndarray:
        at = np.zeros(len(binned), np.int64)
        while True:
            inner = np.flatnonzero(self.feature[at] >= 0)
            if not len(inner):
                return at
            own = at[inner]
            goes = binned[inner, self.feature[own]] <= self.cut[own]
            at[inner] = np.where(goes, self.left[own], self.right[own])

    def values(self, binned: np.ndarray) -> np.ndarray:
        return self.value[self.leaf(binned)]


#: From (tree so far, wanted leaves) to sums of shape (leaves, features, bins, 3): first, second derivative, rows.
Sums = Callable[[Tree, Sequence[int]], np.ndarray]


class _Grower:
    """A tree under way: every node whose children are known, those that turn out not to be wanted included."""

    def __init__(self, settings: Settings, sums: Sums, columns: Callable[[int], np.ndarray]) -> None:
        self.settings, self.sums, self.columns = settings, sums, columns
        self.name, self.feature, self.cut, self.left, self.right = [1], [-1], [0], [-1], [-1]
        self.total, self.split, self.depth, self.held = {}, {}, [0], {}

    def tree(self) -> Tree:
        return Tree(*[np.array(a, np.int64) for a in (self.feature, self.cut, self.left, self.right)], np.zeros(len(self.feature)))

    def learn(self, nodes: Sequence[int], sums: np.ndarray) -> None:
        """Keep the sums of new nodes and find their best splits."""
        s = self.settings
        total = sums[:, 0].sum(axis=1)
        left = np.cumsum(sums, axis=2)[:, :, :-1]
        right = total[:, None, None] - left

        def strength(part: np.ndarray) -> np.ndarray:
            weight = part[..., 1] / UNIT + s.penalty
            return np.where(weight > 0, (part[..., 0] / UNIT) ** 2 / np.where(weight > 0, weight, 1.0), 0.0)

        gain = strength(left) + strength(right) - strength(total)[:, None, None]
        for part in (left, right):
            gain[(part[..., 2] < max(s.least_rows, 1)) | (part[..., 1] < s.child_weight * UNIT)] = -np.inf
        for node, own, all_of_it, some in zip(nodes, gain, total, sums, strict=True):
            own = np.where(self.columns(self.name[node])[:, None], own, -np.inf)
            best = int(np.argmax(own))
            self.total[node] = all_of_it
            self.split[node] = (float(own.flat[best]), best // own.shape[1], best % own.shape[1])
            self.held[node] = some

    def simulate(self) -> tuple[list[int], list[int]]:
        """Split the leaf of the largest gain first (ties: the smallest name): split nodes in order, and those whose children are unknown."""
        s, heap, done, unknown, leaves = self.settings, [], [], [], 1

        def offer(node: int) -> None:
            if (s.depth < 0 or self.depth[node] < s.depth) and self.split[node][0] > max(s.gain, 1e-12):
                heapq.heappush(heap, (-self.split[node][0], self.name[node], node))

        offer(0)
        while heap and leaves < s.leaves:
            node = heapq.heappop(heap)[2]
            leaves += 1
            done.append(node)
            if self.left[node] < 0:
                unknown.append(node)
            else:
                offer(self.left[node])
                offer(self.right[node])
        return done, unknown

    def expand(self, nodes: Sequence[int]) -> None:
        """Learn the children of ``nodes``: sums of the smaller child are asked for, the other's are the difference.

        Children at the greatest depth are never split: the sums of their parent tell their totals, and nothing is asked.
        """
        asked, last = [], []
        for node in nodes:
            _, self.feature[node], self.cut[node] = self.split[node]
            rows = self.held[node][self.feature[node], :, 2]
            for side in (self.left, self.right):
                side[node] = len(self.name)
                self.name.append(2 * self.name[node] + (side is self.right))
                self.depth.append(self.depth[node] + 1)
                for array, value in ((self.feature, -1), (self.cut, 0), (self.left, -1), (self.right, -1)):
                    array.append(value)
            small = self.left[node] if 2 * rows[:self.cut[node] + 1].sum() <= rows.sum() else self.right[node]
            (last if self.depth[small] == self.settings.depth else asked).append((node, small))
        parts = {}
        for (node, small), own in zip(asked, self.sums(self.tree(), [small for _, small in asked]) if asked else [], strict=True):
            parts[small] = own
            parts[self.left[node] + self.right[node] - small] = self.held.pop(node) - own
        if parts:
            self.learn(sorted(parts), np.stack([parts[n] for n in sorted(parts)]))
        for node, _ in last:
            whole = self.held.pop(node)[self.feature[node]]
            left = whole[:self.cut[node] + 1].sum(axis=0)
            self.total[self.left[node]], self.total[self.right[node]] = left, whole.sum(axis=0) - left

    def finish(self, done: Sequence[int], value: Callable[[np.ndarray], float]) -> Tree:
        """The tree of the split nodes; nodes are numbered in order of splitting."""
        number, kept = {0: 0}, [0]
        for node in done:
            for child in (self.left[node], self.right[node]):
                number[child] = len(kept)
                kept.append(child)
        inner = set(done)
        return Tree(np.array([self.feature[n] if n in inner else -1 for n in kept]), np.array([self.cut[n] if n in inner else 0 for n in kept]),
                    np.array([number[self.left[n]] if n in inner else -1 for n in kept]),
                    np.array([number[self.right[n]] if n in inner else -1 for n in kept]), np.array([value(self.total[n]) for n in kept]))


def grow(settings: Settings, sums: Sums, columns: Callable[[int], np.ndarray], value: Callable[[np.ndarray], float],
         root: np.ndarray | None = None) -> Tree:
    """A tree from sums alone. ``columns`` gives the features that a node (1, its children 2 and 3, and so on) may split by."""
    grower = _Grower(settings, sums, columns)
    grower.learn([0], sums(grower.tree(), [0]) if root is None else root)
    while True:
        done, unknown = grower.simulate()
        if not unknown:
            return grower.finish(done, value)
        grower.expand(unknown)


def named_nodes(tree: Tree) -> list[tuple[int, int, int, float | None]]:
    """Name, feature, cut and value (of leaves) of every node; the root is 1, its children 2 and 3, and so on."""
    made, open_nodes = [], [(0, 1)]
    for node, name in open_nodes:
        inner = tree.feature[node] >= 0
        made.append((name, int(tree.feature[node]), int(tree.cut[node]), None if inner else float(tree.value[node])))
        if inner:
            open_nodes += [(int(tree.left[node]), 2 * name), (int(tree.right[node]), 2 * name + 1)]
    return made


def newton_value(settings: Settings) -> Callable[[np.ndarray], float]:
    """The step of a leaf against its derivatives."""
    def value(total: np.ndarray) -> float:
        weight = total[1] / UNIT + settings.penalty
        return -settings.step * (total[0] / UNIT) / weight if weight > 0 else 0.0

    return value


def drawn_columns(settings: Settings, features: int, number: int) -> Callable[[int], np.ndarray]:
    """The features of tree ``number``: a share of them, one at least."""
    chosen = np.ones(features, bool)
    if settings.columns < 1:
        chosen[:] = False
        chosen[np.random.default_rng([settings.seed, number]).permutation(features)[:max(1, round(settings.columns * features))]] = True
    return lambda node: chosen


def uniform(row: np.ndarray, *seeds: int) -> np.ndarray:
    """A number in [0, 1) that depends on the row's number and the seeds only."""
    h = row.astype(np.uint64)
    for seed in seeds:
        h = (h ^ np.uint64(seed + 0x632BE5AB)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(11)) / 2.0 ** 53


def probability(margin: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(margin, -700, 700)))


def derivatives(margin: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the weighted log loss, in units; halves go up."""
    p = probability(margin)
    return np.floor(weight * (p - label) * UNIT + 0.5), np.floor(weight * p * (1 - p) * UNIT + 0.5)


def losses(margin: np.ndarray, label: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, np.where(label > 0.5, -margin, margin))


def sum_by_bin(binned: np.ndarray, node: np.ndarray, nodes: int, parts: Sequence[np.ndarray], bins: int = BINS,
               copies: np.ndarray | None = None) -> np.ndarray:
    """Sums of ``parts`` and the number of rows per (node, feature, bin); exact, as all parts are whole numbers.

    With ``copies`` a row counts as many times; the parts have them already.
    """
    rows, features = binned.shape
    place = ((node[:, None] * features + np.arange(features)) * bins + binned).ravel()
    size = nodes * features * bins
    made = [np.bincount(place, np.repeat(part, features), size).astype(np.int64) for part in parts]
    counted = np.bincount(place, None if copies is None else np.repeat(copies, features), size).astype(np.int64)
    return np.stack([*made, counted], axis=1).reshape(nodes, features, bins, -1)


# --- rows inside a task


class LocalRows:
    """Binned rows in memory: their sums by node, for trees of one fit. Rows are found through the leaves they are in."""

    def __init__(self, binned: np.ndarray, first: np.ndarray, second: np.ndarray, rows: np.ndarray) -> None:
        """``rows`` are the places of the rows that take part; each may occur several times."""
        self.binned, self.first, self.second, self.of_leaf, self.split = binned, first, second, {0: rows}, set()

    def sums(self, tree: Tree, nodes: Sequence[int]) -> np.ndarray:
        for node in np.flatnonzero(tree.feature >= 0).tolist():
            if node not in self.split:
                rows = self.of_leaf.pop(node)
                goes = self.binned[rows, tree.feature[node]] <= tree.cut[node]
                self.of_leaf[int(tree.left[node])], self.of_leaf[int(tree.right[node])] = rows[goes], rows[~goes]
                self.split.add(node)
        rows = np.concatenate([self.of_leaf[n] for n in nodes])
        node = np.repeat(np.arange(len(nodes)), [len(self.of_leaf[n]) for n in nodes])
        return sum_by_bin(self.binned[rows], node, len(nodes), (self.first[rows], self.second[rows]))


def start_margin(label: np.ndarray, weight: np.ndarray) -> float:
    """The log odds of the label."""
    return _log_odds(float((weight * label).sum()), float(weight.sum()))


def _log_odds(positive: float, total: float) -> float:
    share = min(max(positive / total if total else 0.5, 1e-15), 1 - 1e-15)
    return float(np.log(share / (1 - share)))


def boost_rows(settings: Settings, binned: np.ndarray, label: np.ndarray, weight: np.ndarray, row: np.ndarray,
               watched: tuple[np.ndarray, np.ndarray] | None = None, patience: int = 50) -> tuple[float, list[Tree]]:
    """Boosted trees of rows in memory: start margin and trees, up to the best round if the loss of ``watched`` rows stops falling."""
    start = start_margin(label, weight)
    margin, trees, value = np.full(len(label), start), [], newton_value(settings)
    margins = np.full(len(watched[1]), start) if watched else None
    best, least = 0, np.inf
    for number in range(settings.rounds):
        first, second = derivatives(margin, label, weight)
        part = np.flatnonzero(uniform(row, settings.seed, number) < settings.rows) if settings.rows < 1 else np.arange(len(label))
        rows = LocalRows(binned, first, second, part)
        trees.append(grow(settings, rows.sums, drawn_columns(settings, binned.shape[1], number), value))
        margin = margin + trees[-1].values(binned)
        if watched:
            margins = margins + trees[-1].values(watched[0])
            loss = float(losses(margins, watched[1]).mean()) if len(margins) else 0.0
            if loss < least:
                best, least = number + 1, loss
            elif number + 1 - best >= patience:
                break
    return start, trees[:best] if watched else trees


def forest_trees(numbers: Sequence[int], depth: int, binned: np.ndarray, label: np.ndarray, row: np.ndarray, seed: int = 42) -> Iterator[Tree]:
    """Trees of a forest by their numbers: rows drawn with replacement, a new draw of features (square root) at every node, until leaves are pure."""
    settings = Settings(leaves=1 << 62, depth=depth, least_rows=1, child_weight=0.0)
    features = binned.shape[1]
    chosen = max(1, int(features ** 0.5))

    def share(total: np.ndarray) -> float:
        return -total[0] / total[1] if total[1] else 0.5

    for number in numbers:
        random = np.random.default_rng([seed, number])
        order = np.argsort(row, kind="stable")
        rows = LocalRows(binned, -UNIT * label, np.full(len(label), float(UNIT)), np.sort(order[random.integers(0, max(len(row), 1), len(row))]))

        def columns(node: int, number: int = number) -> np.ndarray:
            mask = np.zeros(features, bool)
            mask[np.random.default_rng([seed, number, node % (1 << 62), node >> 62]).permutation(features)[:chosen]] = True
            return mask

        yield grow(settings, rows.sums, columns, share)


# --- rows in a table


@dataclass
class Model:
    """Boosted trees of two classes."""

    bins: Bins
    start: float
    trees: list[Tree] = field(default_factory=list)

    def margins(self, binned: np.ndarray) -> np.ndarray:
        total = np.full(len(binned), self.start)
        for tree in self.trees:
            total += tree.values(binned)
        return total

    def predict(self, df: DataFrame, features: str = "features") -> DataFrame:
        """Add ``probability`` (of class 1) and ``prediction`` to rows with a feature vector."""
        shared = df.sparkSession.sparkContext.broadcast(self)
        ship_package(df.sparkSession)
        vector = vector_to_array(features)

        @F.pandas_udf("double")
        def scored(values):  # a batch of feature arrays
            own = shared.value
            return values.__class__(probability(own.margins(own.bins.apply(_matrix(values, len(own.bins.low))))))

        return df.withColumn("probability", scored(vector)).withColumn("prediction", (F.col("probability") > 0.5).cast("double"))


def _matrix(values, features: int) -> np.ndarray:
    return np.array(values.tolist(), float).reshape(len(values), features)


def fit_bins(df: DataFrame, features: str = "features", bins: int = BINS, copies: str | None = None) -> Bins:
    """Bins from all rows: one aggregate for the ranges, one for the counts of cells. A row counts as many times as its ``copies`` say."""
    ship_package(df.sparkSession)
    rows = df.select(vector_to_array(features).alias("v"), (F.col(copies) if copies else F.lit(1)).cast("bigint").alias("n"))

    def limits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = _arrays(batch.column(0), len(batch.column(0)[0]))
                yield pa.RecordBatch.from_arrays([pa.array(range(values.shape[1]), pa.int32()), pa.array(values.min(axis=0)), pa.array(values.max(axis=0))],
                                                 ["feature", "low", "high"])

    ranges = rows.mapInArrow(limits, "feature int, low double, high double").groupBy("feature").agg(
        F.min("low").alias("low"), F.max("high").alias("high")).orderBy("feature").toArrow()
    low = ranges["low"].to_numpy()
    width = ranges["high"].to_numpy() - low
    shared = df.sparkSession.sparkContext.broadcast((low, width))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, width = shared.value
        counts = np.zeros(len(low) * CELLS, np.int64)
        for batch in batches:
            cells = cells_of(_arrays(batch.column(0), len(low)), low, width)
            times = np.repeat(batch.column(1).to_numpy(), len(low))
            counts += np.bincount((np.arange(len(low)) * CELLS + cells).ravel(), times, len(counts)).astype(np.int64)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], ["cell", "n"])

    found = rows.mapInArrow(count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(len(low) * CELLS, np.int64)
    counts[found["cell"].to_numpy()] = found["n"].to_numpy()
    return bins_of(counts.reshape(len(low), CELLS), low, width, bins)


def _arrays(column: pa.Array, features: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, features)


def binned_rows(df: DataFrame, bins: Bins, label: str = "label", weight: str | None = None, watched: str | None = None,
                row_key: str = "match_id", features: str = "features", keep: Sequence[str] = (), merge: bool = False) -> DataFrame:
    """The written input of fits: row, label, weight, watched, bins (a byte per feature) and the columns to keep.

    With ``merge`` rows that differ in their key only become one with their number as ``copies``, for fits that draw no rows.
    """
    shared = df.sparkSession.sparkContext.broadcast(bins)
    ship_package(df.sparkSession)
    rows = df.select(F.xxhash64(row_key).alias("row"), F.col(label).cast("double").alias("label"),
                     (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("weight"),
                     (F.col(watched).cast("boolean") if watched else F.lit(False)).alias("watched"), vector_to_array(features).alias("bins"), *keep)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            binned = own.apply(_arrays(batch.column("bins"), len(own.low)))
            at = batch.schema.get_field_index("bins")
            yield batch.set_column(at, "bins", pa.array([r.tobytes() for r in binned], pa.binary()))

    kinds = {**{n: t for n, t in rows.dtypes}, "bins": "binary"}
    made = rows.mapInArrow(work, ", ".join(f"`{n}` {kinds[n]}" for n in rows.columns))
    if merge:
        made = made.groupBy(*[n for n in made.columns if n != "row"]).agg(F.min("row").alias("row"), F.count(F.lit(1)).alias("copies"))
    return settle(made, "binned")


def _batch_bins(batch: pa.RecordBatch, features: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, features)


def _margins(batch: pa.RecordBatch, late: Sequence[Tree], features: int) -> tuple[np.ndarray, np.ndarray]:
    """The bins of rows, and their kept margins with those of later trees."""
    binned = _batch_bins(batch, features)
    margin = batch.column("margin").to_numpy().copy()
    for tree in late:
        margin += tree.values(binned)
    return binned, margin


def _blocks(rows: DataFrame) -> RDD:
    """The batches of a table as Arrow streams, held by the executors."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema) as stream:
                    stream.write_batch(batch)
                yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["block"])

    return rows.mapInArrow(pack, "block binary").rdd.map(lambda row: bytes(row[0])).persist(StorageLevel.MEMORY_AND_DISK)


class Fit:
    """Boosted trees fitted on a table, round by round. The table is that of ``binned_rows``; watched rows teach nothing."""

    def __init__(self, rows: DataFrame, bins: Bins, settings: Settings) -> None:
        self.spark, self.settings = rows.sparkSession, settings
        ship_package(self.spark)
        if "copies" not in rows.columns:
            rows = rows.withColumn("copies", F.lit(1).cast("bigint"))
        elif settings.rows < 1:
            raise ValueError("a fit that draws rows needs every row by itself")
        weight = F.col("weight") * F.col("copies")
        taught = rows.where(~F.col("watched")).agg(F.sum(weight * F.col("label")), F.sum(weight)).first()
        self.model = Model(bins, _log_odds(taught[0] or 0.0, taught[1] or 0.0))
        self.rows, self.kept = rows.withColumn("margin", F.lit(self.model.start)), 0
        self.blocks = _blocks(self.rows)
        self.watched: list[float] = []  # the mean loss of watched rows after each round

    def _keep(self) -> None:
        """Write the margins of all rows, so that a later round adds up few trees."""
        late, at = self.spark.sparkContext.broadcast(self.model.trees[self.kept:]), self.rows.columns.index("margin")
        features = len(self.model.bins.low)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.set_column(at, "margin", pa.array(_margins(batch, late.value, features)[1]))

        self.rows = settle(self.rows.mapInArrow(work, self.rows.schema), "margins")
        self.kept = len(self.model.trees)
        self.blocks.unpersist()
        self.blocks = _blocks(self.rows)

    def _sums(self, number: int) -> tuple[Sums, dict]:
        """The source of sums for one round, and what the first call also finds: the loss of watched rows before the round."""
        late, settings, said = self.model.trees[self.kept:], self.settings, {}
        features = len(self.model.bins.low)

        def sums(tree: Tree, nodes: Sequence[int]) -> np.ndarray:
            size, wanted = len(nodes) * features * BINS, len(nodes)
            lookup = np.full(len(tree.feature), -1, np.int64)
            lookup[list(nodes)] = np.arange(wanted)

            def work(blocks: Iterator[bytes]) -> Iterator[np.ndarray]:
                total = np.zeros((size + 1, 3), np.int64)
                for block in blocks:
                    batch = pa.ipc.open_stream(block).read_next_batch()
                    binned, margin = _margins(batch, late, features)
                    label, weight, row, copies = (batch.column(c).to_numpy() for c in ("label", "weight", "row", "copies"))
                    watched = batch.column("watched").to_numpy(zero_copy_only=False)
                    loss = losses(margin[watched], label[watched])
                    total[size] += [int((np.floor(loss * UNIT) * copies[watched]).sum()), int(copies[watched].sum()), 0]
                    node = lookup[tree.leaf(binned)]
                    part = (node >= 0) & ~watched
                    if settings.rows < 1:
                        part &= uniform(row, settings.seed, number) < settings.rows
                    part = np.flatnonzero(part)
                    first, second = derivatives(margin[part], label[part], weight[part])
                    own = copies[part]
                    total[:size] += sum_by_bin(binned[part], node[part], wanted, (first * own, second * own), copies=own).reshape(size, 3)
                yield total

            # Nodes x features x bins times three numbers of each partition, or of a few once partitions are many, reach the driver.
            made = self.blocks.mapPartitions(work)
            total = made.treeAggregate(np.zeros((size + 1, 3), np.int64), np.add, np.add, 1 if made.getNumPartitions() <= _DIRECT else 2)
            said.setdefault("loss", total[size, 0] / UNIT / total[size, 1] if total[size, 1] else 0.0)
            return total[:size].reshape(len(nodes), features, BINS, 3)

        return sums, said

    def go_on(self, rounds: int, patience: int | None = None) -> Model:
        """Add up to ``rounds`` trees to those fitted before; with patience stop when so many rounds brought no gain."""
        for _ in range(rounds):
            number, root = len(self.model.trees), self._next()
            if patience and number - self.best_round() >= patience:
                return self.model
            sums, _ = self._sums(number)
            columns = drawn_columns(self.settings, len(self.model.bins.low), number)
            self.model.trees.append(grow(self.settings, sums, columns, newton_value(self.settings), root))
        if patience:
            self._next()
        return self.model

    def _next(self) -> np.ndarray:
        """The sums of all rows before a round, which also tell the loss of the watched rows after the round before."""
        number = len(self.model.trees)
        if number - self.kept >= KEEP:
            self._keep()
        sums, said = self._sums(number)
        root = sums(Tree(*[np.array([v]) for v in (-1, 0, -1, -1)], np.zeros(1)), [0])
        if number > len(self.watched):
            self.watched.append(said["loss"])
        return root

    def best_round(self) -> int:
        """The number of trees after which the watched rows had the least loss."""
        return int(np.argmin(self.watched)) + 1 if self.watched else len(self.model.trees)

    def best(self) -> Model:
        """The model of the best round: the trees fitted until then, none of them again."""
        return replace(self.model, trees=self.model.trees[:self.best_round()])
