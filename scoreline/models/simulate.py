"""Win probabilities of coming games by repeated noisy scoring."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import choose_greater, clip
from ..functions.seeded import fast_gaussian
from ..storage import settle

# Fixed value: draws of one game that one row of the first step stands for.
_BLOCK = 1000


def noisy_draws(games: DataFrame, game: str, features: Sequence[str], draws: int, scale: float, seed: int = 42,
                limits: tuple[float, float] | None = None,
                gaussian: Callable[..., Column] = fast_gaussian) -> DataFrame:
    """Each game ``draws`` times, with N(0, scale) added to its features.

    ``gaussian`` is one of the functions of ``functions.seeded``. Blocks of draws
    are spread over the cluster before they are expanded, so a few games with
    many draws use all executors.
    """
    spread = int(games.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = games.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit((draws - 1) // _BLOCK))))
    blocks = blocks.repartition(spread, game, "_block")
    first = F.col("_block") * F.lit(_BLOCK)
    last = F.least(first + F.lit(_BLOCK - 1), F.lit(draws - 1))
    rows = blocks.withColumn("draw", F.explode(F.sequence(first, last))).drop("_block")
    noisy = rows.withColumns({f: F.col(f) + gaussian(seed, F.lit(f), F.col(game), F.col("draw"), scale=scale) for f in features})
    # A step of its own: within one expression the noise is written out twice, and a method of that size is not compiled by the JVM.
    return noisy if limits is None else noisy.withColumns({f: clip(F.col(f), *limits) for f in features})


def win_probabilities(scored: DataFrame, game: str, prediction: str) -> DataFrame:
    """The share of draws each side won, and the likelier winner (0 or 1; 1 on a tie)."""
    shares = scored.groupBy(game).agg(
        F.avg(F.when(F.col(prediction) == 0, 1.0).otherwise(0.0)).alias("team_1_win_prob"),
        F.avg(F.when(F.col(prediction) == 1, 1.0).otherwise(0.0)).alias("team_2_win_prob"),
        F.count(F.lit(1)).alias("draws"))
    return shares.withColumn("winner_pred", choose_greater(F.col("team_1_win_prob"), F.col("team_2_win_prob")))


def by_pairing(games: DataFrame, game: str, pairing: Sequence[str], features: Sequence[str],
               simulate: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """One row per game, simulated once per distinct pairing.

    Games of the same pairing have the same features, so that as many draws serve all of
    them, and the work is bounded by the number of pairings. ``simulate`` gets the pairings
    and the name of their key.
    """
    key = F.concat_ws("-", *[F.coalesce(F.col(c).cast("string"), F.lit("?")) for c in pairing]).alias("pairing")
    keyed = games.select(game, key, *features)
    results = simulate(settle(keyed.drop(game).dropDuplicates(["pairing"]), "pairings"), "pairing")
    return keyed.select(game, "pairing").join(settle(results, "simulated"), "pairing").drop("pairing")


def noise_ensemble(games: DataFrame, game: str, features: Sequence[str],
                   predict: Callable[[DataFrame], DataFrame], prediction: str, draws: int = 15000,
                   scale: float = 0.15, seed: int = 42, limits: tuple[float, float] | None = None,
                   gaussian: Callable[..., Column] = fast_gaussian) -> DataFrame:
    """One row per game: the votes of ``draws`` noisy predictions."""
    rows = noisy_draws(games, game, features, draws, scale, seed, limits, gaussian)
    return win_probabilities(predict(rows), game, prediction)
