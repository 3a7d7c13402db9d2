"""Looking up teams and browsing predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mentions(name: Column, text: str) -> Column:
    """Whether ``text`` occurs in ``name``, ignoring case; no wildcards."""
    return F.lower(name).contains(F.lower(F.lit(text)))


def search_teams(teams: DataFrame, text: str = "", limit: int = 12, by_league: bool = False) -> DataFrame:
    """The first teams, by name or by league and name, whose name contains ``text``."""
    order = ["league", "team_name"] if by_league else ["team_name"]
    rest = [c for c in teams.columns if c not in order]
    return teams.filter(mentions(F.col("team_name"), text)).orderBy(*order, *rest).limit(limit)


def filter_predictions(
    predictions: DataFrame, league: str | None = None, team: str | None = None, forecast: str | None = None
) -> DataFrame:
    """Predictions of a league, with a team on either side, with a forecast; each part optional.

    Adds ``dia``, the day of the match.
    """
    found = predictions
    if league:
        found = found.filter(F.col("liga") == league)
    if team:
        found = found.filter(mentions(F.col("local"), team) | mentions(F.col("visitante"), team))
    if forecast:
        found = found.filter(F.col("pronostico") == forecast)
    return found.withColumn("dia", F.coalesce(F.get(F.split("fecha", " "), F.lit(0)), F.lit("")))


def distinct_leagues(predictions: DataFrame, column: str = "liga") -> DataFrame:
    """The leagues present, in order."""
    return predictions.select(column).distinct().orderBy(column)
