"""Rosters with standings, team compositions and role matchups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import percent_to_ratio
from ..functions.text import concat_key
from ..operators.aggregate import constant_by_key, count_pivot, mean_by_keys
from ..operators.joins import join_on, lookup_with_fallback, role_playing_join
from ..operators.order import average_rank
from ..operators.stats import fit_minmax, weighted_score
from ..storage import settle


def roster_standings(standings: DataFrame, teams: DataFrame, current: DataFrame, everyone: DataFrame,
                     statistics: DataFrame, percents: Sequence[str]) -> DataFrame:
    """Player statistics with the player's team and its standing.

    Standings carry the team's name and percent texts. A player without a
    current team gets the one of the list of all players; players without any
    are left out. A team without a standing keeps its players.
    """
    ranked = join_on(teams, standings, {"name": "team"}, "left").drop("team")
    ranked = ranked.withColumns({p: percent_to_ratio(F.col(p)) for p in percents})
    placed = lookup_with_fallback(statistics, [(current, "tag", "tag", "team_id"), (everyone, "tag", "tag", "team_id")],
                                  "team_id")
    placed = placed.where(F.col("team_id").isNotNull())
    return placed.join(ranked.withColumnRenamed("id", "team_id"), "team_id", "left")


def compositions(roster: DataFrame, keys: Sequence[str], role: str, roles: Mapping[object, str]) -> DataFrame:
    """Role counts per team, and their key such as ``1-2-1``."""
    counts = count_pivot(roster, keys, role, roles)
    return counts.withColumn("role_composition", concat_key(*[F.col(c) for c in roles.values()]))


def team_rows(roster: DataFrame, record: DataFrame, keys: Sequence[str], role: str, roles: Mapping[object, str],
              names: Mapping[str, str], win_rate: str) -> DataFrame:
    """Role counts, composition key, name and win rate, one row per team.

    A record may have fewer of the keys: parts of a team share its win rate.
    """
    counts = compositions(roster, keys, role, roles).join(constant_by_key(roster, keys, names), list(keys))
    of_record = [k for k in keys if k in record.columns]
    return counts.join(record.select(*of_record, win_rate), of_record)


def team_comparison(roster: DataFrame, record: DataFrame, keys: Sequence[str], role: str,
                    roles: Mapping[object, str], names: Mapping[str, str], win_rate: str) -> DataFrame:
    """The team rows with the mean win rate of the teams of the same composition."""
    table = settle(team_rows(roster, record, keys, role, roles, names, win_rate), "comparison")
    means = mean_by_keys(table, ["role_composition"], {win_rate: "composition_win_rate"})
    return table.join(settle(means, "means"), "role_composition")


def player_ranks(players: DataFrame, role: str, weights: DataFrame, metrics: Sequence[str],
                 normalized: bool = True) -> DataFrame:
    """Weighted score, average rank (1 is best) and, if wanted, the score scaled to [0, 1]."""
    scored = settle(weighted_score(players, role, weights, metrics, "weighted_score"), "scored")
    ranked = average_rank(scored, "weighted_score", "rank")
    if not normalized:
        return ranked
    return fit_minmax(scored, ["weighted_score"]).apply(ranked, {"weighted_score": "normalized_score"})


def role_matchup(matches: DataFrame, teams: DataFrame, team_keys: Sequence[str], roles: Sequence[str],
                 win_rate: str, rank: str) -> DataFrame:
    """Differences of role counts, win rate and mean rank of the two teams of a match.

    Matches with any missing value are left out. ``maps_won_diff`` is the result
    of the match and no feature of it.
    """
    metrics = [*roles, win_rate, rank]
    paired = role_playing_join(matches, teams, team_keys, {"team1": ["team_1_id", "season"], "team2": ["team_2_id", "season"]},
                               metrics, "left").na.drop("any")
    names = {**{r: f"{r}_diff" for r in roles}, win_rate: "win_rate_diff", rank: "team_rank_diff"}
    return paired.select(
        "match_id", F.col("winner_id").cast("double").alias("winner_id"),
        *[(F.col(f"{m}_team1").cast("double") - F.col(f"{m}_team2").cast("double")).alias(n) for m, n in names.items()],
        (F.col("team_1_score") - F.col("team_2_score")).alias("maps_won_diff"))
