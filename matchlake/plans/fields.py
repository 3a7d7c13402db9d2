"""Nested path and flat column of every field the vendor tables publish.

Fixed values: the columns, their names and their order are those of the datasets
consumers already read.
"""

MATCH_FIELDS_A = """
fixture.id                match_id
fixture.date              match_date_raw
fixture.timestamp         match_timestamp
fixture.timezone          timezone
fixture.referee           referee
league
season
fixture.venue.id          venue_id
fixture.venue.name        venue_name
fixture.venue.city        venue_city
teams.home.id             home_team_id
teams.home.name           home_team_name
teams.home.logo           home_team_logo
teams.home.winner         home_winner
teams.away.id             away_team_id
teams.away.name           away_team_name
teams.away.logo           away_team_logo
teams.away.winner         away_winner
goals.home                home_goals
goals.away                away_goals
score.halftime.home       home_goals_halftime
score.halftime.away       away_goals_halftime
score.fulltime.home       home_goals_fulltime
score.fulltime.away       away_goals_fulltime
fixture.status.long       match_status
fixture.status.short      match_status_short
fixture.status.elapsed    elapsed
"""

TEAM_FIELDS_A = """
team.id                   team_id
team.name                 team_name
team.code                 team_code
team.country              country
team.founded              founded
team.logo                 team_logo
team.national             is_national_team
venue.id                  venue_id
venue.name                venue_name
venue.city                venue_city
venue.address             venue_address
venue.capacity            venue_capacity
venue.surface             venue_surface
venue.image               venue_image
league
season
"""

STANDING_FIELDS_A = """
team.id                   team_id
team.name                 team_name
team.logo                 team_logo
rank
points
goalsDiff                 goal_difference
form                      recent_form
description
status
group                     group_name
all.played                played_all
all.win                   wins_all
all.draw                  draws_all
all.lose                  losses_all
all.goals.for             goals_for_all
all.goals.against         goals_against_all
home.played               played_home
home.win                  wins_home
home.draw                 draws_home
home.lose                 losses_home
home.goals.for            goals_for_home
home.goals.against        goals_against_home
away.played               played_away
away.win                  wins_away
away.draw                 draws_away
away.lose                 losses_away
away.goals.for            goals_for_away
away.goals.against        goals_against_away
update                    last_updated
league
season
"""

MATCH_FIELDS_B = """
match.id                  match_id
match.utcDate             match_date_raw
competition_code
competition_name
match.season.startDate    season_start_date
match.season.endDate      season_end_date
match.matchday            matchday
match.stage               stage
match.status              match_status
match.homeTeam.id         home_team_id
match.homeTeam.name       home_team_name
match.homeTeam.shortName  home_team_short_name
match.homeTeam.tla        home_team_tla
match.homeTeam.crest      home_team_logo
match.awayTeam.id         away_team_id
match.awayTeam.name       away_team_name
match.awayTeam.shortName  away_team_short_name
match.awayTeam.tla        away_team_tla
match.awayTeam.crest      away_team_logo
match.score.fullTime.home home_goals
match.score.fullTime.away away_goals
match.score.halfTime.home home_goals_halftime
match.score.halfTime.away away_goals_halftime
match.score.winner        winner_raw
"""

TEAM_FIELDS_B = """
team.id                   team_id
team.name                 team_name
team.shortName            team_short_name
team.tla                  team_tla
team.crest                team_logo
team.founded              founded
team.venue                venue_name
team.website              website
team.clubColors           club_colors
team.area.id              area_id
team.area.name            country
team.area.code            country_code
team.area.flag            country_flag
team.coach.id             coach_id
team.coach.name           coach_name
team.coach.nationality    coach_nationality
competition_code
competition_name
season_start_date
"""

STANDING_FIELDS_B = """
row.team.id               team_id
row.team.name             team_name
row.position              rank
row.points                points
row.goalDifference        goal_difference
row.form                  recent_form
competition_code
season_start_date
"""

CLUB_FIELDS_C = """
club_id
club_code
name                      club_name
domestic_competition_id
squad_size
average_age
foreigners_number
foreigners_percentage
national_team_players
stadium_name
stadium_seats
net_transfer_record
coach_name
last_season
url
league
"""

# Common columns and their types.
MATCH_COLUMNS = {
    "match_id": "bigint",
    "match_date_raw": "string",
    "match_date": "timestamp",
    "league": "string",
    "season": "int",
    "home_team_id": "bigint",
    "home_team_name": "string",
    "home_team_logo": "string",
    "away_team_id": "bigint",
    "away_team_name": "string",
    "away_team_logo": "string",
    "home_goals": "bigint",
    "away_goals": "bigint",
    "home_goals_halftime": "bigint",
    "away_goals_halftime": "bigint",
    "match_status": "string",
    "result": "string",
}
TEAM_COLUMNS = {
    "team_id": "bigint",
    "team_name": "string",
    "team_short_name": "string",
    "team_tla": "string",
    "team_logo": "string",
    "country": "string",
    "founded": "bigint",
    "venue_name": "string",
    "venue_city": "string",
    "venue_capacity": "bigint",
    "league": "string",
    "season": "int",
}
STANDING_COLUMNS = ("team_id", "league", "season", "rank", "points", "goal_difference")

SOURCE_A = "api_football"
SOURCE_B = "football_data_org"
