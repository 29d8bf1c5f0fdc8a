"""Match features: team averages, both sides of a match, differences, scaling, label."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import equality_label, ratio
from ..models.split import mark_test
from ..operators.aggregate import mean_by_keys
from ..operators.joins import map_lookup, role_playing_join
from ..operators.sample import add_noisy, add_swapped, pairwise_difference
from ..operators.stats import Scaling, fit_minmax
from ..storage import settle


def per_map_rates(players: DataFrame, rates: Mapping[str, tuple[str, str]], keep: Sequence[str]) -> DataFrame:
    """Rates ``{result: (statistic, maps played)}``; NULL without maps."""
    return players.select(*keep, *[ratio(F.col(s), F.col(m)).alias(r) for r, (s, m) in rates.items()])


def team_table(players: DataFrame, record: DataFrame, keys: Sequence[str], rates: Mapping[str, tuple[str, str]],
               record_metrics: Sequence[str]) -> DataFrame:
    """Record and mean player rates, one row per key of the record."""
    means = mean_by_keys(per_map_rates(players, rates, keys), keys, list(rates))
    numbers = record.select(*keys, *[F.col(m).cast("double").alias(m) for m in record_metrics])
    return numbers.join(means, list(keys), "left")


def paired_matches(matches: DataFrame, teams: DataFrame, metrics: Sequence[str], keep: Sequence[str],
                   sides: Mapping[str, Sequence[str]], team_keys: Sequence[str], how: str = "inner") -> DataFrame:
    """The metrics of both teams on each match."""
    needed = list(dict.fromkeys([*keep, *[c for columns in sides.values() for c in columns]]))
    return role_playing_join(matches.select(*needed), teams, team_keys, sides, metrics, how)


def difference_names(metrics: Sequence[str]) -> list[str]:
    return [f"{m}_diff" for m in metrics]


def match_features(matches: DataFrame, teams: DataFrame, metrics: Sequence[str], swap_share: float = 0.5,
                   noise_share: float = 0.0, noise: float = 0.08, seed: int = 42,
                   test_percent: int | None = None) -> tuple[DataFrame, Scaling]:
    """The training table of decided matches and the scaling fitted on it.

    ``matches`` has match_id, season, both team ids and scores and the winner.
    A share of the matches is added with the sides exchanged, a share of those
    rows with noise. Label 1 means that the second team won. With a test percentage the
    table has ``is_test`` (by match), and only the other rows set the bounds. The paired
    matches are written once; samples, bounds and table are taken from them.
    """
    sides = {"team1": ["team_1_id", "season"], "team2": ["team_2_id", "season"]}
    base = ["match_id", "season", "team_1_id", "team_2_id", "team_1_score", "team_2_score", "winner_id"]
    paired = settle(paired_matches(matches.where(F.col("winner_id").isNotNull()), teams, metrics, base, sides,
                                   ["team_id", "season"]), "paired")
    flags = []
    if swap_share:
        paired = add_swapped(paired, swap_share, seed, ["match_id"])
        flags.append("swapped")
    if noise_share:
        columns = [f"{m}_{s}" for m in metrics for s in sides]
        paired = add_noisy(paired, columns, noise_share, noise, seed, ["match_id", *flags])
        flags.append("noisy")
    label = equality_label(F.col("winner_id"), F.col("team_2_id")).alias("label")
    keep = ["match_id", F.col("season").alias("year"), *flags, "team_1_score", "team_2_score", label]
    table = pairwise_difference(paired, metrics, keep)
    fitted = table
    if test_percent is not None:
        table = mark_test(table, test_percent, seed, ["match_id"])
        fitted = table.where("is_test = 0")
    scaling = fit_minmax(fitted, difference_names(metrics))
    return scaling.apply(table), scaling


def pairing_features(matches: DataFrame, teams: DataFrame, metrics: Sequence[str], test_percent: int, copies: str = "copies",
                     seed: int = 42) -> tuple[DataFrame, Scaling]:
    """The rows and the scaling of ``match_features`` without added ones, matches of equal rows as one with their number as ``copies``.

    Matches of the same two teams in one season have the same features, so they are counted before teams are joined: the
    written table has a row per season, pair of teams, label and ``is_test``, whatever the number of matches.
    """
    sides = {"team1": ["team_1_id", "year"], "team2": ["team_2_id", "year"]}
    label = equality_label(F.col("winner_id"), F.col("team_2_id")).alias("label")
    decided = mark_test(matches.where(F.col("winner_id").isNotNull()), test_percent, seed, ["match_id"])
    keep = [F.col("season").alias("year"), "team_1_id", "team_2_id", label, "is_test"]
    counted = decided.groupBy(*keep).agg(F.count(F.lit(1)).alias(copies))
    paired = paired_matches(counted, teams, metrics, counted.columns, sides, ["team_id", "season"])
    table = settle(pairwise_difference(paired, metrics, counted.columns), "paired")
    scaling = fit_minmax(table.where("is_test = 0"), difference_names(metrics))
    return scaling.apply(table), scaling


def coming_features(games: DataFrame, names: DataFrame, teams: DataFrame, metrics: Sequence[str],
                    scaling: Scaling) -> DataFrame:
    """Coming games with the scaled differences of their teams.

    ``games`` has game_id, two team names and the season whose averages count;
    ``names`` has name and id, of equal names the last id counts. A team without
    averages gives NULL features. The ids of the teams are kept.
    """
    for side in ("team_1", "team_2"):
        games = map_lookup(games, f"{side}_name", names, "name", "id", f"{side}_id", ["id"])
    keep = ["game_id", "season", "team_1_id", "team_2_id"]
    paired = paired_matches(games, teams, metrics, keep,
                            {"team1": ["team_1_id", "season"], "team2": ["team_2_id", "season"]},
                            ["team_id", "season"], how="left")
    return scaling.apply(pairwise_difference(paired, metrics, keep))
