"""Squad values per club."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXACT_MONEY = "decimal(18,4)"


def team_values(players: DataFrame, min_season: int = 2023) -> DataFrame:
    """Sum, averages and number of the valued players of each club, from ``min_season`` on.

    Money is summed as decimals: a sum of doubles depends on the order in which
    tasks deliver their parts, and the ranking of clubs must not.
    """
    value = F.col("market_value_in_eur").cast(EXACT_MONEY)
    highest = F.col("highest_market_value_in_eur").cast(EXACT_MONEY)

    def rounded(average: Column) -> Column:
        return F.round(average, 2).cast("double")

    valued = players.filter(
        F.col("current_club_id").isNotNull()
        & F.col("market_value_in_eur").isNotNull()
        & (F.col("last_season") >= min_season)
    )
    return valued.groupBy("current_club_id", "current_club_name").agg(
        F.sum(value).cast("double").alias("squad_market_value_eur"),
        rounded(F.avg(value)).alias("avg_player_market_value_eur"),
        F.count("player_id").alias("players_count"),
        rounded(F.avg(highest)).alias("avg_highest_market_value_eur"),
    )


def top_teams(values: DataFrame, limit: int = 20) -> DataFrame:
    """The most valuable clubs; equal values by club id, then name."""
    ranking = (F.col("squad_market_value_eur").desc_nulls_last(), "current_club_id", "current_club_name")
    return values.orderBy(*ranking).limit(limit)
