"""Resolving match teams to clubs of the value registry by name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.functions.columns import decode
from matchlake.functions.names import club_key
from matchlake.operators.containment import best_held, best_holder
from matchlake.operators.dedupe import keep_one

TEAM_COLUMNS = ("team_id", "team_name", "team_name_normalized", "league", "season", "source")
TEAM_KEY = ("team_id", "league", "season", "source")
CLUB_COLUMNS = (
    "transfermarkt_club_id",
    "transfermarkt_club_name",
    "squad_market_value_eur",
    "avg_player_market_value_eur",
    "players_count",
)
RESOLVED_COLUMNS = (
    *TEAM_COLUMNS,
    "team_name_match",
    *CLUB_COLUMNS,
    "transfermarkt_name_normalized",
    "transfermarkt_name_match",
    "match_type",
)
# Kinds of a match, best first.
MATCH_PRIORITY = {"exact": 1, "contains_transfermarkt": 2, "contains_team": 3}


def teams_of_season(teams: DataFrame, season: int | None) -> DataFrame:
    """Teams of one season; without one, of each source's own latest season."""
    if season is not None:
        return teams.filter(F.col("season") == season)
    latest = teams.groupBy("source").agg(F.max("season").alias("season"))
    return teams.join(latest, ["source", "season"], "left_semi")


def club_columns(values: DataFrame) -> DataFrame:
    """The columns of ``team_values`` under the names the resolved tables use."""
    return values.select(
        F.col("current_club_id").alias("transfermarkt_club_id"),
        F.col("current_club_name").alias("transfermarkt_club_name"),
        "squad_market_value_eur",
        "avg_player_market_value_eur",
        "players_count",
    )


def _value_order() -> list[Column]:
    return [
        F.col("squad_market_value_eur").desc_nulls_last(),
        F.col("transfermarkt_club_id").asc_nulls_last(),
        F.col("transfermarkt_club_name").asc_nulls_last(),
    ]


def _keyed_teams(teams: DataFrame) -> DataFrame:
    return teams.select(*TEAM_COLUMNS, club_key(F.col("team_name")).alias("team_name_match"))


def _keyed_clubs(values: DataFrame) -> DataFrame:
    return club_columns(values).withColumn("transfermarkt_name_match", club_key(F.col("transfermarkt_club_name")))


def _resolved(df: DataFrame) -> DataFrame:
    return df.withColumn("transfermarkt_name_normalized", F.col("transfermarkt_name_match")).select(
        *RESOLVED_COLUMNS
    )


def automatic_matches(teams: DataFrame, values: DataFrame, min_len: int = 4) -> DataFrame:
    """The best club per team whose key equals, contains or is contained in the team's key.

    Equal keys come first, then clubs containing the team, then clubs inside it;
    within a kind the most valuable club wins, then the smallest id. Keys shorter
    than ``min_len`` match nothing.

    Names are resolved once per distinct key against the best club of each distinct
    key, and the result is looked up per team; the pairs of names that many teams
    and clubs share are never enumerated.
    """
    keyed = _keyed_teams(teams)
    team_key, club, kind = "team_name_match", "transfermarkt_name_match", "match_type"
    names = keyed.filter(F.length(team_key) >= min_len).select(team_key).distinct()
    clubs = keep_one(_keyed_clubs(values).filter(F.length(club) >= min_len), [club], _value_order())

    equal_first = F.col(team_key) != F.col(club)
    holders = best_holder(names, team_key, clubs, club, [equal_first, *_value_order()], min_len)
    held = best_held(names, team_key, clubs, club, [equal_first, *_value_order()], min_len)

    def typed(df: DataFrame, inexact: str) -> DataFrame:
        return df.withColumn(kind, F.when(equal_first, inexact).otherwise("exact"))

    priority = [decode(F.col(kind), MATCH_PRIORITY), *_value_order()]
    candidates = typed(holders, "contains_transfermarkt").unionByName(typed(held, "contains_team"))
    best = keep_one(candidates, [team_key], priority)
    matched = keyed.join(best, team_key)
    return _resolved(keep_one(matched, TEAM_KEY, [*priority, F.col("team_name"), F.col("team_name_normalized")]))


def manual_matches(
    teams: DataFrame,
    values: DataFrame,
    overrides: DataFrame,
    actions: Sequence[str] = ("fix",),
    unique: bool = True,
) -> DataFrame:
    """Teams whose (league, name) an override sends to a club, found by the club's key.

    Several clubs may share that key; ``unique`` keeps the most valuable one per team.
    """
    fixes = overrides.filter(F.col("action").isin(*actions)).select(
        "league",
        "team_name",
        club_key(F.col("transfermarkt_club_name")).alias("transfermarkt_name_match"),
    )
    fixed = _keyed_teams(teams).join(fixes, ["league", "team_name"])
    matched = fixed.join(_keyed_clubs(values), "transfermarkt_name_match").withColumn("match_type", F.lit("manual"))
    return _resolved(keep_one(matched, TEAM_KEY, [*_value_order(), F.col("team_name")]) if unique else matched)


def resolve_teams(
    teams: DataFrame,
    values: DataFrame,
    overrides: DataFrame,
    season: int | None = None,
    min_len: int = 4,
    unique: bool = True,
) -> DataFrame:
    """One club per team: the manual override if there is one, else the automatic match."""
    current = teams_of_season(teams, season)
    manual = manual_matches(current, values, overrides, unique=unique)
    automatic = automatic_matches(current, values, min_len)
    rest = automatic.join(manual.select(*TEAM_KEY).distinct(), list(TEAM_KEY), "left_anti")
    return manual.unionByName(rest)
