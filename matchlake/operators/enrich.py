"""Matches with both sides' squad values and standings, and the datasets built from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.functions.columns import TARGET_BY_OUTCOME, target_of
from matchlake.operators.dedupe import keep_one
from matchlake.operators.roles import ROLES, as_role

VALUE_COLUMNS = (
    "transfermarkt_club_id",
    "transfermarkt_club_name",
    "squad_market_value_eur",
    "avg_player_market_value_eur",
    "players_count",
)
# The columns of the training dataset, in order.
TRAINING_COLUMNS = (
    "match_id",
    "match_date",
    "league",
    "season",
    "source",
    "home_team_id",
    "home_team_name",
    "away_team_id",
    "away_team_name",
    "home_goals",
    "away_goals",
    "home_squad_market_value_eur",
    "away_squad_market_value_eur",
    "market_value_diff_eur",
    "home_avg_player_market_value_eur",
    "away_avg_player_market_value_eur",
    "home_players_count",
    "away_players_count",
    "home_rank",
    "away_rank",
    "home_points",
    "away_points",
    "home_goal_diff",
    "away_goal_diff",
    "result",
)


def join_both_sides(
    matches: DataFrame, facts: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Left join ``facts`` once as the home and once as the away side.

    ``keys`` holds ``team_id`` and whatever else both tables share. There is no
    broadcast hint: Spark broadcasts ``facts`` below its size threshold and
    otherwise shuffles, splitting the partition of a much-played team.
    """
    shared = [k for k in keys if k != "team_id"]
    picked = facts.select(*keys, *columns)
    joined = matches
    for role in ROLES:
        joined = joined.join(as_role(picked, role, ["team_id", *columns]), [*shared, f"{role}_team_id"], "left")
    return joined.select(*matches.columns, *(f"{role}_{name}" for role in ROLES for name in columns))


def enrich(
    matches: DataFrame,
    values: DataFrame,
    keys: Sequence[str] = ("source", "team_id", "league"),
    compat: bool = False,
) -> DataFrame:
    """Matches with both teams' squad values and the difference, NULL where one is unknown.

    ``values`` may hold a team once per season: its latest one counts, so the
    number of matches never changes. ``compat`` joins on (team_id, league) alone and
    lets every row of ``values`` match, as the earlier jobs did.
    """
    if compat:
        keys = ("team_id", "league")
    else:
        order = [F.col("season").desc_nulls_last()] if "season" in values.columns else []
        ties = [F.col(c).asc_nulls_last() for c in values.columns if c not in (*keys, "season")]
        values = keep_one(values, keys, [*order, *ties])
    enriched = join_both_sides(matches, values, keys, VALUE_COLUMNS)
    difference = F.col("home_squad_market_value_eur") - F.col("away_squad_market_value_eur")
    return enriched.withColumn("market_value_diff_eur", difference)


def with_standings(matches: DataFrame, standings: DataFrame) -> DataFrame:
    """Matches with both teams' rank, points and goal difference in the match's season.

    A season's final table holds for all its matches, also the early ones.
    """
    table = standings.withColumnRenamed("goal_difference", "goal_diff")
    keys = ("team_id", "league", "season", "source")
    return join_both_sides(matches, table, keys, ("rank", "points", "goal_diff"))


def training_sets(enriched: DataFrame, standings: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``split_matches`` of the enriched matches with both teams' standings."""
    return split_matches(with_standings(enriched, standings))


def split_matches(matches: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Decided matches with their target, matches to come, and those that are neither.

    A match is to come when it has no home goals. Neither are matches with only one
    side's goals, or with goals but no outcome.
    """
    played = F.col("home_goals").isNotNull() & F.col("away_goals").isNotNull()
    decided = played & F.coalesce(F.col("result").isin(*TARGET_BY_OUTCOME), F.lit(False))
    future = F.col("home_goals").isNull()
    training = matches.filter(decided).select(*TRAINING_COLUMNS).withColumn("target", target_of(F.col("result")))
    return training, matches.filter(future), matches.filter(~decided & ~future)
