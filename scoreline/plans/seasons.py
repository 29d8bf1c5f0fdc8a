"""Season tables from landed pages, and the form of teams over their last matches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import ratio, trunc_decimals
from ..functions.text import first_match, replace_text
from ..operators.order import latest_n
from ..sources.html import wide_table
from ..storage import settle

# Fixed value: the blank that HTML tables use inside names.
_NON_BREAKING = "\u00a0"


def season_tables(pages: DataFrame, url: str, html: str, table_no: int, ids: DataFrame, tag: str) -> DataFrame:
    """The same statistics table of many season pages with the ids of its names.

    The season is the first four digits of the address. Names without an id are kept.
    """
    rows = wide_table(pages, url, html, table_no)
    name = rows.columns[1]
    quoted = F.col(f"`{name}`")
    rows = rows.withColumn(name, replace_text(quoted, {_NON_BREAKING: " "})).withColumn("year", first_match(F.col(url)))
    known = ids.select(F.col(tag).alias("_tag"), "id").distinct()
    return rows.join(known, quoted == F.col("_tag"), "left").drop("_tag", url)


def rolling_form(sides: DataFrame, lines: DataFrame, ratings: Sequence[str], n: int = 3, digits: int = 3) -> DataFrame:
    """The rating of a team over its last ``n`` matches, one row per team.

    ``sides`` has team_id, match_id and played_at, ``lines`` match_id, player_id
    and for every rating a sum and ``<rating>_games``. A player's rating is the
    sum over the matches by the games played; the players are added up and
    divided by the number of matches that the team really has. The quotient is rounded
    to nine digits before it is cut, so that the order of addition does not show.
    """
    last = settle(latest_n(sides, ["team_id"], ["played_at", "match_id"], n).select("team_id", "match_id"), "last")
    played = last.groupBy("team_id").agg(F.count(F.lit(1)).alias("_matches"))
    players = lines.join(last, "match_id").groupBy("team_id", "player_id").agg(
        *[F.sum(r).alias(r) for r in ratings], *[F.sum(f"{r}_games").alias(f"{r}_games") for r in ratings])
    teams = players.groupBy("team_id").agg(
        *[F.sum(ratio(F.col(r), F.col(f"{r}_games"))).alias(r) for r in ratings])
    return teams.join(settle(played, "played"), "team_id").select(
        "team_id", *[trunc_decimals(F.round(F.col(r) / F.col("_matches"), 9), digits).alias(f"{r}_avg") for r in ratings])
