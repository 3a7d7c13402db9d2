"""Named datasets: where each one lives, its format, layout and declared schema.

Raw schemas are declared so that reading needs no inference pass over the files
and a missing field is NULL. Parquet keeps the schema of its writer.
"""

from __future__ import annotations

from dataclasses import dataclass

# Declared input fields, nested as the vendors deliver them.
GOALS = "struct<home:bigint,away:bigint>"
SIDE_A = "struct<id:bigint,name:string,logo:string,winner:boolean>"
RECORD_A = (
    "struct<played:bigint,win:bigint,draw:bigint,lose:bigint,goals:struct<`for`:bigint,against:bigint>>"
)
SIDE_B = "struct<id:bigint,name:string,shortName:string,tla:string,crest:string>"

FIXTURES_A = f"""
    fixture struct<id:bigint,date:string,timestamp:bigint,timezone:string,referee:string,
                   venue:struct<id:bigint,name:string,city:string>,
                   status:struct<long:string,short:string,elapsed:bigint>>,
    teams struct<home:{SIDE_A},away:{SIDE_A}>,
    goals {GOALS},
    score struct<halftime:{GOALS},fulltime:{GOALS}>,
    league string, season int
"""
TEAMS_A = """
    team struct<id:bigint,name:string,code:string,country:string,founded:bigint,logo:string,national:boolean>,
    venue struct<id:bigint,name:string,city:string,address:string,capacity:bigint,surface:string,image:string>,
    league string, season int
"""
STANDING_ROW_A = f"""
    team struct<id:bigint,name:string,logo:string>, rank bigint, points bigint, goalsDiff bigint,
    form string, description string, status string, `group` string, `update` string,
    `all` {RECORD_A}, home {RECORD_A}, away {RECORD_A}
"""
STANDINGS_A = f"{STANDING_ROW_A}, league string, season int"
MATCHES_B = f"""
    competition struct<code:string,name:string>,
    matches array<struct<id:bigint,utcDate:string,matchday:bigint,stage:string,status:string,
        season:struct<startDate:string,endDate:string>,
        homeTeam:{SIDE_B},awayTeam:{SIDE_B},
        score:struct<winner:string,fullTime:{GOALS},halfTime:{GOALS}>>>
"""
TEAMS_B = """
    competition struct<code:string,name:string>, season struct<startDate:string>,
    teams array<struct<id:bigint,name:string,shortName:string,tla:string,crest:string,founded:bigint,
        venue:string,website:string,clubColors:string,
        area:struct<id:bigint,name:string,code:string,flag:string>,
        coach:struct<id:bigint,name:string,nationality:string>>>
"""
STANDINGS_B = """
    competition struct<code:string>, season struct<startDate:string>,
    standings array<struct<type:string,
        table:array<struct<position:bigint,team:struct<id:bigint,name:string>,
                           points:bigint,goalDifference:bigint,form:string>>>>
"""
CLUBS_C = """
    club_id int, club_code string, name string, domestic_competition_id string, squad_size int,
    average_age double, foreigners_number int, foreigners_percentage double, national_team_players int,
    stadium_name string, stadium_seats int, net_transfer_record string, coach_name string,
    last_season int, url string
"""
PLAYERS_C = """
    player_id int, name string, current_club_id int, current_club_name string,
    market_value_in_eur double, highest_market_value_in_eur double, position string,
    country_of_citizenship string, last_season int
"""
VALUATIONS_C = "player_id int, date string, market_value_in_eur double"
OVERRIDES = "league string, team_name string, transfermarkt_club_name string, action string"
PREDICTIONS = """
    fecha string, liga string, local string, visitante string, prob_gana_local double,
    prob_empate double, prob_gana_visitante double, pronostico string
"""
TEAM_STATS = """
    source string, team_id bigint, team_name string, league string, squad_market_value_eur double,
    avg_player_market_value_eur double, players_count bigint, rank bigint, points bigint,
    goal_diff bigint, logo_url string
"""

BY_LEAGUE = ("league",)
BY_LEAGUE_SEASON = ("league", "season")


@dataclass(frozen=True)
class Dataset:
    """One named dataset below the base location.

    ``layout`` is one of ``records`` (JSON rows or arrays of rows), ``documents``
    (one JSON object per file, any depth of folders), ``csv`` and ``parquet``.
    CSV columns are matched to the schema by the header's names.
    """

    path: str
    layout: str
    schema: str | None = None
    partition_by: tuple[str, ...] = ()


# The layout the published datasets already have.
DATASETS = {
    "raw_fixtures_a": Dataset("raw/api_football/fixtures", "records", FIXTURES_A, BY_LEAGUE_SEASON),
    "raw_teams_a": Dataset("raw/api_football/teams", "records", TEAMS_A, BY_LEAGUE_SEASON),
    "raw_standings_a": Dataset("raw/api_football/standings", "records", STANDINGS_A, BY_LEAGUE_SEASON),
    "raw_matches_b": Dataset("raw/football_data_org/matches", "documents", MATCHES_B),
    "raw_teams_b": Dataset("raw/football_data_org/teams", "documents", TEAMS_B),
    "raw_standings_b": Dataset("raw/football_data_org/standings", "documents", STANDINGS_B),
    "raw_clubs_c": Dataset("raw/transfermarkt/clubs", "csv", f"{CLUBS_C}, league string", BY_LEAGUE),
    "raw_players_c": Dataset("raw/transfermarkt/players", "csv", f"{PLAYERS_C}, league string", BY_LEAGUE),
    "raw_valuations_c": Dataset(
        "raw/transfermarkt/player_valuations", "csv", f"{VALUATIONS_C}, league string", BY_LEAGUE
    ),
    "fact_matches_a": Dataset("processed/api_football/fact_matches", "parquet", None, BY_LEAGUE_SEASON),
    "fact_matches_b": Dataset("processed/football_data_org/fact_matches", "parquet", None, BY_LEAGUE_SEASON),
    "fact_matches": Dataset("processed/fact_matches", "parquet", None, BY_LEAGUE_SEASON),
    "enriched_fact_matches": Dataset("processed/enriched_fact_matches", "parquet", None, BY_LEAGUE_SEASON),
    "dim_teams_a": Dataset("processed/api_football/dim_teams", "parquet", None, BY_LEAGUE_SEASON),
    "dim_teams_b": Dataset("processed/football_data_org/dim_teams", "parquet", None, BY_LEAGUE_SEASON),
    "dim_teams": Dataset("processed/dim_teams", "parquet", None, BY_LEAGUE_SEASON),
    "dim_clubs": Dataset("processed/transfermarkt/dim_clubs", "parquet", None, BY_LEAGUE),
    "team_market_values": Dataset("processed/transfermarkt/team_market_values", "parquet"),
    "team_matching_candidates": Dataset("processed/team_matching_candidates", "parquet", None, BY_LEAGUE),
    "team_club_matches": Dataset("processed/team_transfermarkt_matches", "parquet", None, BY_LEAGUE),
    "fact_standings_a": Dataset("processed/api_football/fact_standings", "parquet", None, BY_LEAGUE_SEASON),
    "fact_standings_b": Dataset(
        "processed/football_data_org/fact_standings", "parquet", None, BY_LEAGUE_SEASON
    ),
    "training_dataset": Dataset("processed/ml/training_dataset", "parquet", None, BY_LEAGUE_SEASON),
    "future_dataset": Dataset("processed/ml/future_dataset", "parquet", None, BY_LEAGUE_SEASON),
    "team_overrides": Dataset("reference/team_transfermarkt_manual_mapping.csv", "csv", OVERRIDES),
    "predictions": Dataset("output/predictions", "records", PREDICTIONS),
    "model_fit": Dataset("output/model_fit", "records", "rows bigint, tasks int"),
    "team_stats": Dataset("output/team_stats", "records", TEAM_STATS),
    "training_snapshot": Dataset("output/training_data", "parquet"),
}
RANDOM_FOREST_MODEL = "output/random_forest_model"


def dataset_path(base: str, name: str) -> str:
    """Full path of a named dataset below ``base`` (a folder or an object-store URI)."""
    return f"{base.rstrip('/')}/{DATASETS[name].path}"


def model_path(base: str) -> str:
    """Full path of the fitted model below ``base``."""
    return f"{base.rstrip('/')}/{RANDOM_FOREST_MODEL}"
