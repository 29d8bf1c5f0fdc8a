"""Mixing sources to target weights by iterative proportional fitting.

Documents are counted into cells (source, language, topic); the cells' token
weights are raked to the target marginals, one dimension after the other, until
all agree. A cell's probability is its calibrated weight over its tokens, scaled
to the token budget and held to at most one, what is cut off going to the other
cells. A document is drawn if a hash of its key falls below the probability of
its cell, so that a retry draws the same documents.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle

#: Of the sources' and languages' and topics' shares of all tokens, the powers that the targets are in proportion to.
TEMPERATURES = {"source": 0.5, "lang": 0.7, "topic": 0.5}
#: Share of the input's tokens that the sample is to have.
BUDGET = 0.7
#: Cells come to the driver; with more of them the operator refuses to run. 1e6 cells are about 100 MB.
MOST_CELLS = 1_000_000
#: Largest gap between a raked share and its target that passes without a warning.
AGREEMENT = 1e-4


def topic_of(text: Column) -> Column:
    """A coarse topic by form: tables, contact data, legal lines, else prose."""
    return (F.when(text.contains(" | "), "table").when(text.contains("@"), "contact")
            .when(F.lower(text).contains("license"), "legal").otherwise("prose"))


def tokens_of(text: Column) -> Column:
    """Words between runs of blanks; a text without any counts one, as it still ends a document."""
    return F.greatest(F.regexp_count(text, F.lit("[^ \\t\\n\\x0B\\f\\r]+")), F.lit(1)).cast("bigint")


def rake(weights: np.ndarray, codes: Sequence[np.ndarray], targets: Sequence[np.ndarray], rounds: int = 500,
         tolerance: float = 1e-9) -> tuple[np.ndarray, float]:
    """Scale positive cell weights until every marginal equals its target share.

    Returns weights that add up to one and the largest gap that is left (above the
    tolerance only where the targets contradict each other on the cells present).
    """
    w, gap = weights / weights.sum(), np.inf
    for _ in range(rounds):
        gap = 0.0
        for code, target in zip(codes, targets, strict=True):
            have = np.bincount(code, w, len(target))
            gap = max(gap, float(np.abs(have - target).max()))
            w = w * (target / have)[code]
        if gap < tolerance:
            break
    return w, gap


def capped_probabilities(tokens: np.ndarray, weights: np.ndarray, budget: float) -> np.ndarray:
    """Probabilities in proportion to weight / tokens, at most one, with ``budget`` tokens expected.

    Cells that reach one are taken whole and the rest of the budget is spread over
    the others in proportion again; a budget above all tokens takes everything.
    """
    p, open_cells = np.zeros(len(tokens)), np.ones(len(tokens), bool)
    while open_cells.any():
        rest = budget - tokens[~open_cells].sum()
        p[open_cells] = rest * weights[open_cells] / weights[open_cells].sum() / tokens[open_cells]
        over = open_cells & (p >= 1)
        if not over.any():
            break
        p[over], open_cells = 1.0, open_cells & ~over
    return np.clip(p, 0.0, 1.0)


def _targets(cells: pd.DataFrame, column: str, wish: float | Mapping[str, float]) -> tuple[np.ndarray, np.ndarray]:
    code, names = pd.factorize(cells[column])
    have = np.bincount(code, cells["tokens"], len(names))
    want = have ** wish if isinstance(wish, (int, float)) else np.array([float(wish[n]) for n in names])
    if (want <= 0).any():
        raise ValueError(f"targets of {column} must be positive")
    return code, want / want.sum()


def calibrate(cells: pd.DataFrame, wishes: Mapping[str, float | Mapping[str, float]], budget: float) -> pd.DataFrame:
    """``cells`` (one row per combination, with its tokens) and their weight and probability.

    A wish is a power of the present shares, or a target per value for every value present.
    """
    if cells.empty:
        return cells.assign(weight=pd.Series(dtype=float), probability=pd.Series(dtype=float))
    pairs = [_targets(cells, c, w) for c, w in wishes.items()]
    tokens = cells["tokens"].to_numpy(float)
    weight, gap = rake(tokens, [c for c, _ in pairs], [t for _, t in pairs])
    if gap > AGREEMENT:
        warnings.warn(f"the targets contradict each other on the cells present: a share is off by {gap:.4f}", stacklevel=2)
    return cells.assign(weight=weight, probability=capped_probabilities(tokens, weight, budget * tokens.sum()))


def draw(key: Column, seed: int) -> Column:
    """A number in [0, 1) from the key."""
    return F.pmod(F.xxhash64(F.lit(seed), F.coalesce(key.cast("string"), F.lit(""))), F.lit(1 << 52)) / F.lit(float(1 << 52))


def mix(docs: DataFrame, wishes: Mapping[str, float | Mapping[str, float]] = TEMPERATURES, budget: float = BUDGET, seed: int = 7,
        key: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", most_cells: int = MOST_CELLS) -> DataFrame:
    """One row per row of ``docs``: key, source, lang, topic, tokens, weight, probability, selected.

    ``weight`` is the calibrated share of its cell in the sample wished for,
    ``probability`` the chance of each of the cell's documents. NULL source,
    language or text count as a value ''. Repeated rows share their fate. An empty
    input gives no rows. Extra columns are not read.
    """
    spark, body = docs.sparkSession, F.coalesce(F.col(text), F.lit(""))
    rows = settle(docs.select(F.col(key).alias("id"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
                              F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"), topic_of(body).alias("topic"),
                              tokens_of(body).alias("tokens")), "mixing")
    counts = rows.groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("tokens")).limit(most_cells + 1).toPandas()
    if len(counts) > most_cells:
        raise ValueError(f"more than {most_cells} cells; use coarser sources or topics")
    counts = counts.sort_values(["source", "lang", "topic"], ignore_index=True)
    cells = calibrate(counts, wishes, budget)[["source", "lang", "topic", "weight", "probability"]]
    table = spark.createDataFrame([tuple(r) for r in cells.itertuples(index=False)], "source STRING, lang STRING, topic STRING, weight DOUBLE, probability DOUBLE")
    # At most ``most_cells`` rows, counted above.
    joined = rows.join(F.broadcast(table), ["source", "lang", "topic"])
    return joined.select(F.col("id").alias(key), "source", "lang", "topic", "tokens", "weight", "probability",
                         (draw(F.col("id"), seed) < F.col("probability")).alias("selected"))


def op2_mixing(docs: DataFrame) -> DataFrame:
    return mix(docs)
