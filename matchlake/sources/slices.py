"""League slices of the club registry's full dumps."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.functions.columns import LEAGUE_BY_COMPETITION, decode


def slice_by_league(
    clubs: DataFrame,
    players: DataFrame,
    valuations: DataFrame,
    leagues: Mapping[str, str] = LEAGUE_BY_COMPETITION,
) -> dict[str, DataFrame]:
    """Clubs of the wanted competitions, their players and those players' valuations.

    One pass for all leagues: the league travels along the keys, where filtering
    league by league would scan every table once per league.
    """
    competition = F.col("domestic_competition_id")
    kept_clubs = clubs.filter(competition.isin(*leagues)).withColumn("league", decode(competition, leagues))
    club_league = kept_clubs.select(F.col("club_id").alias("current_club_id"), "league").distinct()
    kept_players = players.join(club_league, "current_club_id")
    player_league = kept_players.select("player_id", "league").distinct()
    return {
        "clubs": kept_clubs,
        "players": kept_players,
        "player_valuations": valuations.join(player_league, "player_id"),
    }
