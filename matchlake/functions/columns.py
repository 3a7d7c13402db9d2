"""Scalar expressions for outcomes, leagues, seasons and forecasts.

Everything here stays inside whole-stage code generation; nothing calls Python
per row. Malformed input gives NULL, also under ANSI mode.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Codes and labels of the vendors and of the published datasets.
LEAGUE_BY_CODE = {
    "PL": "premier_league",
    "PD": "la_liga",
    "SA": "serie_a",
    "BL1": "bundesliga",
    "FL1": "ligue_1",
}
LEAGUE_BY_COMPETITION = {
    "GB1": "premier_league",
    "ES1": "la_liga",
    "L1": "bundesliga",
    "IT1": "serie_a",
    "FR1": "ligue_1",
}
LEAGUE_LABELS = {
    "la_liga": "La Liga",
    "premier_league": "Premier League",
    "bundesliga": "Bundesliga",
    "serie_a": "Serie A",
    "ligue_1": "Ligue 1",
    "eredivisie": "Eredivisie",
    "primeira_liga": "Primeira Liga",
}
OUTCOME_BY_GOAL_SIGN = {1: "HOME_WIN", 0: "DRAW", -1: "AWAY_WIN"}
OUTCOME_BY_WINNER = {"HOME_TEAM": "HOME_WIN", "AWAY_TEAM": "AWAY_WIN", "DRAW": "DRAW"}
UNDECIDED = "UNKNOWN"
TARGET_BY_OUTCOME = {"HOME_WIN": 0, "DRAW": 1, "AWAY_WIN": 2}
FORECAST_BY_TARGET = {0: "Gana Local", 1: "Empate", 2: "Gana Visitante"}


def decode(column: Column, mapping: Mapping, default: Column | None = None) -> Column:
    """Look ``column`` up in a constant map; ``default`` (or NULL) for anything else."""
    literals = [F.lit(value) for value in chain.from_iterable(mapping.items())]
    found = F.create_map(*literals)[column]
    return found if default is None else F.coalesce(found, default)


def parse_timestamp(text: Column) -> Column:
    """ISO-8601 text, with ``Z`` or an offset, to a zoned timestamp."""
    return F.try_to_timestamp(text)


def season_of(start_date: Column) -> Column:
    """Season as an int: the first four characters of the start date."""
    return F.substring(start_date, 1, 4).try_cast("int")


def league_name(code: Column, leagues: Mapping[str, str] = LEAGUE_BY_CODE) -> Column:
    """Canonical league of a vendor code; unknown codes pass through."""
    return decode(code, leagues, default=code)


def league_label(league: Column, labels: Mapping[str, str] = LEAGUE_LABELS) -> Column:
    """Display label of a canonical league; unknown leagues pass through."""
    return decode(league, labels, default=league)


def outcome_from_score(home_goals: Column, away_goals: Column) -> Column:
    """Outcome by goals; a missing score is undecided."""
    sign = F.signum(home_goals - away_goals).cast("int")
    return decode(sign, OUTCOME_BY_GOAL_SIGN, default=F.lit(UNDECIDED))


def outcome_from_code(winner: Column) -> Column:
    """Outcome by the vendor's winner code; any other code is undecided."""
    return decode(winner, OUTCOME_BY_WINNER, default=F.lit(UNDECIDED))


def target_of(outcome: Column) -> Column:
    """Class index of a decided outcome, NULL for an undecided one."""
    return decode(outcome, TARGET_BY_OUTCOME)


def forecast_label(prediction: Column) -> Column:
    """Published label of a predicted class index."""
    return decode(prediction.cast("int"), FORECAST_BY_TARGET)


def percentage(probabilities: Column, target: int) -> Column:
    """Share of one class in percent; a class the model never saw has 0."""
    return F.round(F.coalesce(F.get(probabilities, F.lit(target)), F.lit(0.0)) * 100, 2)
