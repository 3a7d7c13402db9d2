"""Latest figures per team."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.operators.dedupe import keep_one
from matchlake.operators.roles import stack_roles

STAT_COLUMNS = (
    "team_id",
    "team_name",
    "squad_market_value_eur",
    "avg_player_market_value_eur",
    "players_count",
    "rank",
    "points",
    "goal_diff",
)


def logo_per_team(matches: DataFrame) -> DataFrame:
    """One logo per team name seen on either side; of several the smallest.

    Pairs are made distinct first, by hashing. A minimum of texts is found by sorting, which
    would be of all matches: Spark drops a distinct before it, as it can't change the result.
    """
    seen = stack_roles(matches, [], ["team_name", "team_logo"]).dropna().distinct()
    return keep_one(seen, ["team_name"], [F.col("team_logo")]).withColumnRenamed("team_logo", "logo_url")


def latest_team_stats(
    training: DataFrame, logos: DataFrame, keys: Sequence[str] = ("source", "team_id", "league")
) -> DataFrame:
    """Each team's complete figures in its latest season, with its logo or an empty text.

    Vendors number their teams on their own, so the vendor belongs to the key; with
    ``keys=("team_id", "league")`` one of two teams of equal ids stays, as in the earlier jobs.

    A team's figures repeat in all its matches of a season; they are made distinct
    first, which aggregates before the shuffle and leaves little to rank.
    """
    named = list(dict.fromkeys(["league", "season", *(k for k in keys if k != "team_id")]))
    rows = stack_roles(training, named, STAT_COLUMNS).dropna().distinct()
    ties = [F.col(c) for c in rows.columns if c not in (*keys, "season")]
    latest = keep_one(rows, keys, [F.col("season").desc(), *ties]).drop("season")
    stats = latest.join(logos, "team_name", "left").withColumn("logo_url", F.coalesce("logo_url", F.lit("")))
    return stats.select(*(c for c in named if c != "season"), *STAT_COLUMNS, "logo_url")


def team_profiles(matches_to_clubs: DataFrame, standings: DataFrame) -> DataFrame:
    """Latest squad value of each team, with its latest standing or NULL, for pairings.

    ``season`` is that of the squad value.
    """
    keys = ["source", "team_id", "league"]

    def latest(df: DataFrame) -> DataFrame:
        ties = [F.col(c).asc_nulls_last() for c in df.columns if c not in (*keys, "season")]
        return keep_one(df, keys, [F.col("season").desc_nulls_last(), *ties])

    squads = latest(
        matches_to_clubs.select(
            *keys,
            "season",
            "team_name",
            "squad_market_value_eur",
            "avg_player_market_value_eur",
            "players_count",
        )
    )
    table = latest(
        standings.select(*keys, "season", "rank", "points", F.col("goal_difference").alias("goal_diff"))
    ).drop("season")
    return squads.join(table, keys, "left")
