"""Each published table as a function of the tables it is built from.

No function reads, writes or counts anything; the jobs do.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.functions.columns import (
    LEAGUE_BY_CODE,
    league_name,
    outcome_from_code,
    outcome_from_score,
    parse_timestamp,
    season_of,
)
from matchlake.functions.names import name_key
from matchlake.operators.dedupe import keep_one
from matchlake.operators.nested import explode_rows, flatten, parse_fields
from matchlake.operators.unify import tag_source, unify
from matchlake.plans import fields

TEAM_SEASON = ("team_id", "league", "season")
LANDED = "ingest_date"
HEADER_B = (
    ("competition.code", "competition_code"),
    ("competition.name", "competition_name"),
    ("season.startDate", "season_start_date"),
)


def _landed(df: DataFrame) -> list[tuple[str, str]]:
    """The landing day, where the raw rows have one."""
    return [(LANDED, LANDED)] if LANDED in df.columns else []


def _latest(flat: DataFrame, order: Sequence[Column] | None, keep_landed: bool = False) -> DataFrame:
    """One row per team, league and season: by ``order``, else of the latest landing."""
    if order is None and LANDED in flat.columns:
        rest = [F.col(c).asc_nulls_last() for c in flat.columns if c not in (*TEAM_SEASON, LANDED)]
        order = [F.col(LANDED).desc_nulls_last(), *rest]
    # Each task sorts what it has got, and flat rows are wide: even parts stay small however large the table is.
    kept = keep_one(flat.hint("rebalance"), TEAM_SEASON, order)
    return kept if keep_landed else kept.drop(LANDED)


def fact_matches_a(fixtures: DataFrame) -> DataFrame:
    """Matches of vendor A; the outcome follows from the goals."""
    flat = flatten(fixtures, fields.MATCH_FIELDS_A)
    return flat.withColumns(
        {
            "match_date": parse_timestamp(F.col("match_date_raw")),
            "result": outcome_from_score(F.col("home_goals"), F.col("away_goals")),
        }
    )


def fact_matches_b(documents: DataFrame, leagues: Mapping[str, str] = LEAGUE_BY_CODE) -> DataFrame:
    """Matches of vendor B, with canonical leagues; the outcome still as the vendor's code."""
    matches = explode_rows(documents, "matches", "match", HEADER_B[:2])
    flat = flatten(matches, fields.MATCH_FIELDS_B).withColumns(
        {
            "match_date": parse_timestamp(F.col("match_date_raw")),
            "league": league_name(F.col("competition_code"), leagues),
            "season": season_of(F.col("season_start_date")),
        }
    )
    return tag_source(flat, fields.SOURCE_B)


def dim_teams_a(teams: DataFrame, order: Sequence[Column] | None = None) -> DataFrame:
    """Teams of vendor A, one row per team, league and season: that of the latest landing."""
    return _latest(flatten(teams, [*parse_fields(fields.TEAM_FIELDS_A), *_landed(teams)]), order)


def _league_and_season(flat: DataFrame, leagues: Mapping[str, str]) -> DataFrame:
    return flat.withColumns(
        {
            "league": league_name(F.col("competition_code"), leagues),
            "season": season_of(F.col("season_start_date")),
        }
    )


def dim_teams_b(
    documents: DataFrame,
    order: Sequence[Column] | None = None,
    leagues: Mapping[str, str] = LEAGUE_BY_CODE,
) -> DataFrame:
    """Teams of vendor B, one row per team, league and season: that of the latest landing."""
    teams = explode_rows(documents, "teams", "team", [*HEADER_B, *_landed(documents)])
    flat = flatten(teams, [*parse_fields(fields.TEAM_FIELDS_B), *_landed(documents)])
    return _latest(tag_source(_league_and_season(flat, leagues), fields.SOURCE_B), order)


def fact_standings_a(
    standings: DataFrame, order: Sequence[Column] | None = None, keep_landed: bool = False
) -> DataFrame:
    """Standings of vendor A, one row per team, league and season: that of the latest landing.

    ``keep_landed`` keeps the day, which a table that later landings are merged into needs.
    """
    flat = flatten(standings, [*parse_fields(fields.STANDING_FIELDS_A), *_landed(standings)])
    return _latest(flat, order, keep_landed)


def fact_standings_b(
    documents: DataFrame,
    unique: bool = True,
    order: Sequence[Column] | None = None,
    leagues: Mapping[str, str] = LEAGUE_BY_CODE,
) -> DataFrame:
    """Overall standings of vendor B, of the latest landing; ``unique=False`` keeps re-landed rows."""
    header = (HEADER_B[0], HEADER_B[2], *_landed(documents))
    names = tuple((name, name) for _, name in header)
    overall = F.col("standing.type") == "TOTAL"
    groups = explode_rows(documents, "standings", "standing", header, where=overall)
    rows = explode_rows(groups, "standing.table", "row", names)
    flat = flatten(rows, [*parse_fields(fields.STANDING_FIELDS_B), *_landed(documents)])
    table = _league_and_season(flat, leagues).drop("competition_code", "season_start_date")
    return _latest(table, order) if unique else table.drop(LANDED)


def dim_clubs(clubs: DataFrame, order: Sequence[Column] | None = None) -> DataFrame:
    """Clubs of the value registry with their simple key, one row per club and league."""
    flat = flatten(clubs, fields.CLUB_FIELDS_C)
    keyed = flat.withColumn("club_name_normalized", name_key(F.col("club_name")))
    return keep_one(keyed, ("club_id", "league"), order)


def fact_matches(
    matches_a: DataFrame,
    matches_b: DataFrame,
    dedupe: Sequence[str] | None = None,
    leagues: Mapping[str, str] = LEAGUE_BY_CODE,
) -> DataFrame:
    """Matches of both vendors with one outcome domain; ``dedupe`` names a key to keep one row of."""
    decided_b = matches_b.withColumns(
        {"league": league_name(F.col("league"), leagues), "result": outcome_from_code(F.col("winner_raw"))}
    )
    sources = {fields.SOURCE_A: matches_a, fields.SOURCE_B: decided_b}
    return unify(sources, fields.MATCH_COLUMNS, dedupe)


def dim_teams(teams_a: DataFrame, teams_b: DataFrame) -> DataFrame:
    """Teams of both vendors with their simple key, one row per team, league, season and vendor."""
    sources = {fields.SOURCE_A: teams_a.withColumnRenamed("team_code", "team_tla"), fields.SOURCE_B: teams_b}
    unified = unify(sources, fields.TEAM_COLUMNS)  # both vendors' teams are unique already
    return unified.withColumn("team_name_normalized", name_key(F.col("team_name")))


def standings(standings_a: DataFrame, standings_b: DataFrame) -> DataFrame:
    """Rank, points and goal difference of both vendors."""
    return unify({fields.SOURCE_A: standings_a, fields.SOURCE_B: standings_b}, fields.STANDING_COLUMNS)
