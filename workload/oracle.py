"""The queries' results as plain SQL over the test tables."""

from __future__ import annotations

from matchlake.functions.names import CLUB_WORDS
from matchlake.ml import FEATURES
from matchlake.operators.enrich import TRAINING_COLUMNS, VALUE_COLUMNS
from workload.views import TABLES

CODES = "CASE {0} WHEN 'AF' THEN 'africa' WHEN 'AM' THEN 'america' WHEN 'AS' THEN 'asia' WHEN 'EU' THEN 'europe' ELSE {0} END"
OUTCOME = """CASE WHEN {home} > {away} THEN 'HOME_WIN' WHEN {home} < {away} THEN 'AWAY_WIN'
             WHEN {home} = {away} THEN 'DRAW' ELSE 'UNKNOWN' END"""


def simple_key(name: str) -> str:
    return f"regexp_replace(lower(trim({name})), '[^a-z0-9 ]', '', 'g')"


def word_key(name: str) -> str:
    key = f"regexp_replace(lower(trim({name})), '[^a-z0-9 ]', ' ', 'g')"
    for phrase in CLUB_WORDS:
        key = rf"regexp_replace({key}, '\b{phrase}\b', '', 'g')"
    return rf"trim(regexp_replace({key}, '\s+', ' ', 'g'))"


def cents(column: str) -> str:
    return f"cast(round({column} * 100) AS bigint)"


def mean(column: str) -> str:
    """Average of non-negative cents, rounded half up to a cent, in whole numbers."""
    total = f"sum({column})"
    return f"cast((2 * {total} + count({column})) // (2 * count({column})) AS double) / 100"


CTES = {
    "match": f"""
        SELECT l_orderkey * 10 + l_linenumber AS match_id,
               CASE WHEN l_linestatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S+00:00')
                    ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS match_date_raw,
               cast(o_orderdate AS timestamp) AS match_date,
               lower(r_name) AS league, cast(year(o_orderdate) AS int) AS season,
               cast(c_nationkey AS bigint) AS home_team_id, h.n_name AS home_team_name,
               lower(h.n_name) || '.png' AS home_team_logo,
               cast(s_nationkey AS bigint) AS away_team_id, a.n_name AS away_team_name,
               lower(a.n_name) || '.png' AS away_team_logo,
               home_goals, away_goals, home_goals // 2 AS home_goals_halftime,
               away_goals // 2 AS away_goals_halftime,
               CASE WHEN home_goals IS NULL THEN 'Not Started' ELSE 'Match Finished' END AS match_status,
               {OUTCOME.format(home="home_goals", away="away_goals")} AS result,
               CASE WHEN l_linestatus = 'F' THEN 'api_football' ELSE 'football_data_org' END AS source,
               r_name, upper(substr(r_name, 1, 2)) AS code, o_orderpriority, l_partkey, l_suppkey, s_name
        FROM (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN cast(l_quantity AS bigint) % 5 END AS home_goals,
                     CASE WHEN o_orderstatus <> 'P' THEN cast(l_linenumber % 4 AS bigint) END AS away_goals
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
        JOIN customer ON o_custkey = c_custkey
        JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation h ON c_nationkey = h.n_nationkey
        JOIN nation a ON s_nationkey = a.n_nationkey
        JOIN region ON h.n_regionkey = r_regionkey""",
    "fact": """
        SELECT match_id, match_date_raw, match_date, league, season, home_team_id, home_team_name,
               home_team_logo, away_team_id, away_team_name, away_team_logo, home_goals, away_goals,
               home_goals_halftime, away_goals_halftime, match_status, result, source
        FROM match""",
    "squad": f"""
        SELECT c_nationkey AS current_club_id, n_name AS current_club_name,
               cast(sum({cents("c_acctbal")}) AS double) / 100 AS squad_market_value_eur,
               {mean(cents("c_acctbal"))} AS avg_player_market_value_eur,
               count(c_custkey) AS players_count,
               {mean(cents("(c_acctbal + 1000)"))} AS avg_highest_market_value_eur
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN (SELECT o_custkey, max(year(o_orderdate)) AS last_season FROM orders GROUP BY 1)
          ON c_custkey = o_custkey
        WHERE c_acctbal >= 0 AND last_season >= 1999
        GROUP BY 1, 2""",
    "side": """
        SELECT source, league, season, 'home' AS role, home_team_id AS team_id, home_team_name AS team_name,
               home_goals AS scored, away_goals AS conceded FROM match
        UNION ALL
        SELECT source, league, season, 'away', away_team_id, away_team_name, away_goals, home_goals FROM match""",
    "link": """
        SELECT DISTINCT league, season, source, team_id, team_name, current_club_id AS transfermarkt_club_id,
               current_club_name AS transfermarkt_club_name, squad_market_value_eur,
               avg_player_market_value_eur, players_count
        FROM side JOIN squad ON team_id = current_club_id""",
    "latest_link": """
        SELECT * FROM link l
        WHERE season = (SELECT max(season) FROM link x
                        WHERE x.source = l.source AND x.league = l.league AND x.team_id = l.team_id)""",
    "enriched": f"""
        SELECT f.*, {", ".join(f"h.{c} AS home_{c}, a.{c} AS away_{c}" for c in VALUE_COLUMNS)},
               h.squad_market_value_eur - a.squad_market_value_eur AS market_value_diff_eur
        FROM fact f
        LEFT JOIN latest_link h
          ON f.source = h.source AND f.league = h.league AND f.home_team_id = h.team_id
        LEFT JOIN latest_link a
          ON f.source = a.source AND f.league = a.league AND f.away_team_id = a.team_id""",
    "record": """
        SELECT source, league, season, team_id, team_name,
               """
    + ", ".join(
        f"""count(scored) FILTER (WHERE {c}) AS played_{s},
            count(*) FILTER (WHERE {c} AND scored > conceded) AS wins_{s},
            count(*) FILTER (WHERE {c} AND scored = conceded) AS draws_{s},
            count(*) FILTER (WHERE {c} AND scored < conceded) AS losses_{s},
            cast(coalesce(sum(scored) FILTER (WHERE {c}), 0) AS bigint) AS goals_for_{s},
            cast(coalesce(sum(conceded) FILTER (WHERE {c}), 0) AS bigint) AS goals_against_{s}"""
        for s, c in (("all", "true"), ("home", "role = 'home'"), ("away", "role = 'away'"))
    )
    + " FROM side GROUP BY 1, 2, 3, 4, 5",
    "standing": """
        SELECT *, row_number() OVER (PARTITION BY source, league, season
                                     ORDER BY points DESC, goal_difference DESC, team_id) AS rank
        FROM (SELECT *, wins_all * 3 + draws_all AS points,
                     goals_for_all - goals_against_all AS goal_difference FROM record)""",
    "with_table": """
        SELECT e.*, h.rank AS home_rank, h.points AS home_points, h.goal_difference AS home_goal_diff,
               a.rank AS away_rank, a.points AS away_points, a.goal_difference AS away_goal_diff
        FROM enriched e
        LEFT JOIN standing h ON e.source = h.source AND e.league = h.league AND e.season = h.season
                             AND e.home_team_id = h.team_id
        LEFT JOIN standing a ON e.source = a.source AND e.league = a.league AND e.season = a.season
                             AND e.away_team_id = a.team_id""",
    "training": f"""
        SELECT {", ".join(TRAINING_COLUMNS)},
               cast(CASE result WHEN 'HOME_WIN' THEN 0 WHEN 'DRAW' THEN 1 ELSE 2 END AS int) AS target
        FROM with_table
        WHERE home_goals IS NOT NULL AND away_goals IS NOT NULL AND result <> 'UNKNOWN'""",
    "prediction": """
        SELECT strftime(match_date, '%Y-%m-%d %H:%M:%S') AS fecha, league AS liga, home_team_name AS local,
               away_team_name AS visitante, home_goals AS goles,
               CASE result WHEN 'HOME_WIN' THEN 'Gana Local' WHEN 'DRAW' THEN 'Empate'
                           WHEN 'AWAY_WIN' THEN 'Gana Visitante' END AS pronostico
        FROM match""",
    "team": f"""
        SELECT *, cast(2025 AS int) AS season, {simple_key("team_name")} AS team_name_normalized,
               {word_key("team_name")} AS team_name_match
        FROM (SELECT p_partkey AS team_id,
                     CASE p_type WHEN 'ECONOMY' THEN p_name WHEN 'LARGE' THEN 'Club ' || p_name || ' F.C.'
                          WHEN 'PROMO' THEN p_name || ' ' || p_brand WHEN 'SMALL' THEN split_part(p_name, ' ', 2)
                          WHEN 'MEDIUM' THEN 'FC ' || p_name || ' Calcio' ELSE reverse(p_name) END AS team_name,
                     lower(p_type) AS league, 'parts' AS source
              FROM part
              UNION ALL
              SELECT c_custkey, split_part(c_name, '#', 2), lower(c_mktsegment), 'customers' FROM customer)""",
    "club": f"""
        SELECT *, {simple_key("transfermarkt_club_name")} AS simple_name,
               {word_key("transfermarkt_club_name")} AS transfermarkt_name_match
        FROM (SELECT min(p_partkey) AS transfermarkt_club_id, p_name AS transfermarkt_club_name,
                     cast(sum({cents("p_retailprice")}) AS double) / 100 AS squad_market_value_eur,
                     {mean(cents("p_retailprice"))} AS avg_player_market_value_eur,
                     count(*) AS players_count
              FROM part GROUP BY p_name
              UNION ALL
              SELECT s_suppkey + 1000000000, s_name, s_acctbal, s_acctbal, 1 FROM supplier)""",
    "auto": """
        SELECT * EXCLUDE (simple_name, place) FROM (
            SELECT *, row_number() OVER (
                       PARTITION BY team_id, league, season, source
                       ORDER BY CASE match_type WHEN 'exact' THEN 1 WHEN 'contains_transfermarkt' THEN 2 ELSE 3 END,
                                squad_market_value_eur DESC, transfermarkt_club_id) AS place
            FROM (SELECT *, transfermarkt_name_match AS transfermarkt_name_normalized,
                         CASE WHEN team_name_match = transfermarkt_name_match THEN 'exact'
                              WHEN contains(transfermarkt_name_match, team_name_match) THEN 'contains_transfermarkt'
                              WHEN contains(team_name_match, transfermarkt_name_match) THEN 'contains_team' END AS match_type
                  FROM team CROSS JOIN club
                  WHERE length(team_name_match) >= 4 AND length(transfermarkt_name_match) >= 4)
            WHERE match_type IS NOT NULL) WHERE place = 1""",
    "manual": f"""
        SELECT * EXCLUDE (simple_name, place) FROM (
            SELECT t.*, c.*, c.transfermarkt_name_match AS transfermarkt_name_normalized, 'manual' AS match_type,
                   row_number() OVER (PARTITION BY team_id, t.league, season, source
                                      ORDER BY squad_market_value_eur DESC, transfermarkt_club_id) AS place
            FROM team t
            JOIN (SELECT DISTINCT lower(p_type) AS league, reverse(p_name) AS fixed_name,
                         {word_key("p_name")} AS fixed_key FROM part WHERE p_type = 'STANDARD') o
              ON t.league = o.league AND t.team_name = o.fixed_name
            JOIN (SELECT * FROM club) c ON c.transfermarkt_name_match = o.fixed_key)
        WHERE place = 1""",
}
NEEDS = {
    "fact": ["match"],
    "side": ["match"],
    "link": ["side", "squad"],
    "latest_link": ["link"],
    "enriched": ["fact", "latest_link"],
    "record": ["side"],
    "standing": ["record"],
    "with_table": ["enriched", "standing"],
    "training": ["with_table"],
    "prediction": ["match"],
    "auto": ["team", "club"],
    "manual": ["team", "club"],
}
RESOLVED = """team_id, team_name, team_name_normalized, league, season, source, team_name_match,
    transfermarkt_club_id, transfermarkt_club_name, squad_market_value_eur, avg_player_market_value_eur,
    players_count, transfermarkt_name_normalized, transfermarkt_name_match, match_type"""


def using(names: str, sql: str) -> str:
    """``sql`` after the named common tables and whatever those need."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        add(name)
    return "WITH " + ",\n".join(f"{name} AS ({CTES[name]})" for name in ordered) + "\n" + sql


def first_per(keys: str, columns: str, rows: str) -> str:
    """One row of ``rows`` per key, the smallest by the other columns in turn."""
    others = [c.strip() for c in columns.split(",") if c.strip() not in [k.strip() for k in keys.split(",")]]
    order = ", ".join(f"{c} NULLS LAST" for c in others)
    return f"""SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS place
               FROM ({rows})) WHERE place = 1"""


TEAM_A = """team_id, team_name, team_code, country, founded, team_logo, is_national_team, venue_id, venue_name,
    venue_city, venue_address, venue_capacity, venue_surface, venue_image, league, season"""
TEAM_A_ROWS = """
    SELECT home_team_id AS team_id, home_team_name AS team_name, substr(home_team_name, 1, 3) AS team_code,
           r_name AS country, l_suppkey AS founded, home_team_logo AS team_logo, false AS is_national_team,
           l_partkey AS venue_id, s_name AS venue_name, away_team_name AS venue_city,
           o_orderpriority AS venue_address, l_partkey AS venue_capacity, match_status AS venue_surface,
           lower(s_name) || '.png' AS venue_image, league, season
    FROM match WHERE source = 'api_football'"""
TEAM_B = """team_id, team_name, team_short_name, team_tla, team_logo, founded, venue_name, website, club_colors,
    area_id, country, country_code, country_flag, coach_id, coach_name, coach_nationality, competition_code,
    competition_name, season_start_date, league, season, source"""
TEAM_B_ROWS = " UNION ALL ".join(
    f"""SELECT {role}_team_id AS team_id, {role}_team_name AS team_name, lower({role}_team_name) AS team_short_name,
               substr({role}_team_name, 1, 3) AS team_tla, {role}_team_logo AS team_logo, l_suppkey AS founded,
               s_name AS venue_name, lower({role}_team_name) || '.example' AS website,
               o_orderpriority AS club_colors, l_suppkey AS area_id, r_name AS country, code AS country_code,
               lower(r_name) || '.png' AS country_flag, l_partkey AS coach_id, s_name AS coach_name,
               r_name AS coach_nationality, code AS competition_code, r_name AS competition_name,
               season || '-01-01' AS season_start_date, {CODES.format("code")} AS league, season, source
        FROM match WHERE source = 'football_data_org'"""
    for role in ("home", "away")
)
NAMES = """(SELECT 'part' AS kind, p_partkey AS id, 'Club ' || p_name || ' F.C. Fc #' || p_brand AS name FROM part
            UNION ALL SELECT 'document', doc_id, text FROM documents)"""
CLUB_COLUMNS = """club_id, club_code, club_name, domestic_competition_id, squad_size, average_age,
    foreigners_number, foreigners_percentage, national_team_players, stadium_name, stadium_seats,
    net_transfer_record, coach_name, last_season, url, league, club_name_normalized"""
ENVELOPES = """(SELECT doc_id, lang, source, n_chars, coalesce(toxic, 0) = 1 AS failed,
                coalesce(quality, 1) = 0 AS empty FROM documents LEFT JOIN labels USING (doc_id))"""
SEARCHED = """(SELECT DISTINCT p_name AS team_name, lower(p_type) AS league FROM part)"""


def oracle_queries() -> dict[str, str]:
    """SQL by query name."""
    return {
        "src_json_records": "SELECT *, cast(year(o_orderdate) AS int) AS season FROM orders",
        "src_json_documents": "SELECT conv_id, role, turn, text FROM conversations",
        "src_documents_rejected": """SELECT o_custkey // 100 AS code, (o_custkey // 100) % 3 = 0 AS rejected,
            CASE WHEN (o_custkey // 100) % 3 <> 0 THEN count(*) END AS n_rows FROM orders GROUP BY o_custkey // 100""",
        "src_csv_headers": """SELECT p_partkey, p_name, p_brand, CASE WHEN p_partkey % 3 < 2 THEN p_size END AS p_size, p_retailprice FROM part""",
        "src_csv": "SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part",
        "src_parquet_partitioned": "SELECT * FROM orders WHERE o_orderstatus = 'F'",
        "envelope_decode": f"SELECT doc_id, lang, source, n_chars FROM {ENVELOPES} WHERE NOT failed AND NOT empty",
        "envelope_rejected": f"""SELECT doc_id, CASE WHEN failed THEN 'errors' ELSE 'empty' END AS reason
            FROM {ENVELOPES} WHERE failed OR empty""",
        "flatten_groups": """SELECT doc_id, unnest(string_split(line, '. ')) AS sentence
            FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)""",
        "league_slice": """
            WITH kept AS (SELECT n_nationkey, lower(r_name) AS league FROM nation JOIN region ON n_regionkey = r_regionkey
                          WHERE r_name IN ('AFRICA', 'ASIA', 'EUROPE')),
                 player AS (SELECT c_custkey, league FROM customer JOIN kept ON c_nationkey = n_nationkey)
            SELECT 'clubs' AS dataset, league, cast(n_nationkey AS bigint) AS id FROM kept
            UNION ALL SELECT 'players', league, c_custkey FROM player
            UNION ALL SELECT 'player_valuations', league, o_orderkey FROM orders JOIN player ON o_custkey = c_custkey""",
        "sink_partitioned_roundtrip": using("fact", "SELECT * FROM fact"),
        "sink_json_roundtrip": using("prediction", "SELECT * FROM prediction"),
        "sink_dated_landing": """SELECT event_type AS league, cast(year(ts) AS int) AS season,
            '2025-01-01' AS ingest_date, count(*) AS count FROM events GROUP BY 1, 2""",
        "flatten_struct": using("match", TEAM_A_ROWS),
        "explode_one_level": """SELECT * FROM (SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS line
            FROM documents) WHERE length(line) > 0""",
        "explode_two_level": using(
            "standing",
            f"""SELECT team_id, team_name, rank, points, goal_difference, cast(NULL AS varchar) AS recent_form,
                       {CODES.format("upper(substr(league, 1, 2))")} AS league, season
                FROM standing WHERE source = 'football_data_org'""",
        ),
        "src_json_rejected": """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_custkey,
            o_orderstatus = 'P' AS rejected FROM orders""",
        "parse_timestamp": """SELECT event_id,
            CASE WHEN event_type <> 'error' THEN ts END AS ts FROM events""",
        "season_of": """SELECT o_orderkey, CASE WHEN o_orderpriority <> '4-NOT SPECIFIED'
            THEN cast(year(o_orderdate) AS int) END AS season FROM orders""",
        "league_map": f"""
            SELECT *, CASE league WHEN 'africa' THEN 'Africa' WHEN 'america' THEN 'The Americas'
                                  WHEN 'asia' THEN 'Asia' ELSE league END AS label
            FROM (SELECT c_custkey, code, {CODES.format("code")} AS league
                  FROM (SELECT c_custkey, upper(substr(r_name, 1, 2)) AS code FROM customer
                        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey))""",
        "outcome_from_score": using(
            "match", "SELECT league, season, result, count(*) AS count FROM match GROUP BY 1, 2, 3"
        ),
        "outcome_from_code": using(
            "match",
            """SELECT season, CASE result WHEN 'HOME_WIN' THEN 'HOME_TEAM' WHEN 'AWAY_WIN' THEN 'AWAY_TEAM'
                      WHEN 'DRAW' THEN 'DRAW' END AS winner_raw, result, count(*) AS count
               FROM match WHERE source = 'football_data_org' GROUP BY 1, 2, 3""",
        ),
        "name_key_simple": f"SELECT kind, id, {simple_key('name')} AS name_key FROM {NAMES}",
        "name_key_club": f"SELECT kind, id, {word_key('name')} AS name_key FROM {NAMES}",
        "fact_matches_score": using(
            "match",
            """SELECT match_id, match_date_raw,
                      cast(date_diff('day', DATE '1970-01-01', cast(match_date AS date)) AS bigint) * 86400 AS match_timestamp,
                      'UTC' AS timezone, o_orderpriority AS referee, league, season, l_suppkey AS venue_id,
                      s_name AS venue_name, away_team_name AS venue_city, home_team_id, home_team_name,
                      home_team_logo, home_goals > away_goals AS home_winner, away_team_id, away_team_name,
                      away_team_logo, away_goals > home_goals AS away_winner, home_goals, away_goals,
                      home_goals_halftime, away_goals_halftime, home_goals AS home_goals_fulltime,
                      away_goals AS away_goals_fulltime, match_status,
                      CASE WHEN home_goals IS NULL THEN 'NS' ELSE 'FT' END AS match_status_short,
                      CASE WHEN home_goals IS NOT NULL THEN cast(90 AS bigint) END AS elapsed, match_date, result
               FROM match WHERE source = 'api_football'""",
        ),
        "fact_matches_code": using(
            "match",
            """SELECT match_id, match_date_raw, code AS competition_code, r_name AS competition_name,
                      season || '-01-01' AS season_start_date, season || '-12-31' AS season_end_date,
                      cast(month(match_date) AS bigint) AS matchday, o_orderpriority AS stage, match_status,
                      home_team_id, home_team_name, lower(home_team_name) AS home_team_short_name,
                      substr(home_team_name, 1, 3) AS home_team_tla, home_team_logo, away_team_id,
                      away_team_name, lower(away_team_name) AS away_team_short_name,
                      substr(away_team_name, 1, 3) AS away_team_tla, away_team_logo, home_goals, away_goals,
                      home_goals_halftime, away_goals_halftime,
                      CASE result WHEN 'HOME_WIN' THEN 'HOME_TEAM' WHEN 'AWAY_WIN' THEN 'AWAY_TEAM'
                           WHEN 'DRAW' THEN 'DRAW' END AS winner_raw, match_date, league, season, source
               FROM match WHERE source = 'football_data_org'""",
        ),
        "union_sources": using("fact", "SELECT * FROM fact"),
        "dim_teams_unified": using(
            "match",
            f"""SELECT *, {simple_key("team_name")} AS team_name_normalized FROM (
                SELECT team_id, team_name, cast(NULL AS varchar) AS team_short_name, team_code AS team_tla, team_logo,
                       country, founded, venue_name, venue_city, venue_capacity, league, season,
                       'api_football' AS source FROM ({first_per("team_id, league, season", TEAM_A, TEAM_A_ROWS)})
                UNION ALL
                SELECT team_id, team_name, team_short_name, team_tla, team_logo, country, founded, venue_name,
                       NULL, NULL, league, season, source
                FROM ({first_per("team_id, league, season", TEAM_B, TEAM_B_ROWS)}))""",
        ),
        "fact_standings": using(
            "standing",
            """SELECT team_id, team_name, lower(team_name) || '.png' AS team_logo, rank, points, goal_difference,
                      cast(NULL AS varchar) AS recent_form, CASE WHEN rank = 1 THEN 'Champion' END AS description,
                      'same' AS status, league AS group_name, * EXCLUDE (team_id, team_name, rank, points,
                      goal_difference, source), season || '-12-31' AS last_updated
               FROM standing WHERE source = 'api_football'""",
        ),
        "standings_relanded": using(
            "standing",
            """SELECT team_id, team_name, lower(team_name) || '.png' AS team_logo, rank, points, goal_difference,
                      cast(NULL AS varchar) AS recent_form, CASE WHEN rank = 1 THEN 'Champion' END AS description,
                      'same' AS status, league AS group_name, * EXCLUDE (team_id, team_name, rank, points,
                      goal_difference, source), season || '-12-31' AS last_updated
               FROM standing WHERE source = 'api_football'""",
        ),
        "standings_upserted": using(
            "standing",
            """SELECT team_id, team_name, lower(team_name) || '.png' AS team_logo, rank, points, goal_difference,
                      cast(NULL AS varchar) AS recent_form, CASE WHEN rank = 1 THEN 'Champion' END AS description,
                      'same' AS status, league AS group_name, * EXCLUDE (team_id, team_name, rank, points,
                      goal_difference, source), season || '-12-31' AS last_updated
               FROM standing WHERE source = 'api_football'""",
        ),
        "union_standings": using(
            "standing",
            f"""SELECT team_id, CASE WHEN source = 'api_football' THEN league
                       ELSE {CODES.format("upper(substr(league, 1, 2))")} END AS league,
                       season, rank, points, goal_difference, source FROM standing""",
        ),
        "dedupe_keys": first_per(
            "l_orderkey, l_linenumber",
            """l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
               l_returnflag, l_linestatus, l_shipdate""",
            "SELECT * FROM lineitem",
        ),
        "dim_clubs": first_per(
            "club_id, league",
            CLUB_COLUMNS,
            f"""SELECT *, {simple_key("club_name")} AS club_name_normalized FROM (
                SELECT p_size AS club_id, p_brand AS club_code, p_name || ' & ' || p_type AS club_name,
                       p_type AS domestic_competition_id, p_size AS squad_size, p_retailprice AS average_age,
                       cast(NULL AS int) AS foreigners_number, cast(NULL AS double) AS foreigners_percentage,
                       cast(NULL AS int) AS national_team_players, p_brand AS stadium_name,
                       p_partkey AS stadium_seats, cast(NULL AS varchar) AS net_transfer_record,
                       p_name AS coach_name, cast(2025 AS int) AS last_season, '/' || p_name AS url,
                       lower(p_type) AS league FROM part)""",
        ),
        "team_values": using("squad", "SELECT * FROM squad"),
        "top_teams": using(
            "squad",
            """SELECT * FROM squad ORDER BY squad_market_value_eur DESC, current_club_id, current_club_name LIMIT 20""",
        ),
        "candidates_levenshtein": using(
            "team club",
            """SELECT * FROM (
                SELECT team_id, team_name, team_name_normalized, league, season, source, transfermarkt_club_id,
                       transfermarkt_club_name, squad_market_value_eur, avg_player_market_value_eur, players_count,
                       simple_name AS transfermarkt_name_normalized,
                       cast(levenshtein(team_name_normalized, simple_name) AS int) AS name_distance
                FROM team CROSS JOIN club) WHERE name_distance <= 4""",
        ),
        "resolve_auto": using("auto", f"SELECT {RESOLVED} FROM auto"),
        "resolve_manual": using("manual", f"SELECT {RESOLVED} FROM manual"),
        "resolve_final": using(
            "auto manual",
            f"""SELECT {RESOLVED} FROM manual UNION ALL
                SELECT {RESOLVED} FROM auto a WHERE NOT EXISTS (
                    SELECT 1 FROM manual m WHERE m.team_id = a.team_id AND m.league = a.league
                    AND m.season = a.season AND m.source = a.source)""",
        ),
        "enrich_two_sided": using("enriched", "SELECT * FROM enriched"),
        "enrich_compat": using(
            "fact link",
            """SELECT f.source, f.league, h.transfermarkt_club_name AS home_transfermarkt_club_name,
                      a.transfermarkt_club_id AS away_transfermarkt_club_id, count(*) AS count
               FROM fact f
               LEFT JOIN (SELECT * FROM link l WHERE season = (SELECT max(season) FROM link x WHERE x.source = l.source)) h
                 ON f.league = h.league AND f.home_team_id = h.team_id
               LEFT JOIN (SELECT * FROM link l WHERE season = (SELECT max(season) FROM link x WHERE x.source = l.source)) a
                 ON f.league = a.league AND f.away_team_id = a.team_id
               GROUP BY 1, 2, 3, 4""",
        ),
        "standings_join": using(
            "fact standing",
            """SELECT f.*, h.rank AS home_rank, h.points AS home_points, h.goal_difference AS home_goal_diff,
                      a.rank AS away_rank, a.points AS away_points, a.goal_difference AS away_goal_diff
               FROM fact f
               LEFT JOIN standing h ON f.source = h.source AND f.league = h.league AND f.season = h.season
                                    AND f.home_team_id = h.team_id
               LEFT JOIN standing a ON f.source = a.source AND f.league = a.league AND f.season = a.season
                                    AND f.away_team_id = a.team_id""",
        ),
        "training_dataset": using("training", "SELECT * FROM training"),
        "future_dataset": using("with_table", "SELECT * FROM with_table WHERE home_goals IS NULL"),
        "undecided_matches": using(
            "match",
            """SELECT league, season, 'UNKNOWN' AS result, count(*) AS count FROM match WHERE home_goals = 4
               GROUP BY 1, 2""",
        ),
        "unpivot_roles": using(
            "fact",
            " UNION ALL ".join(
                f"""SELECT match_id, league, season, source, {role}_team_id AS team_id, {role}_team_name AS team_name,
                           {role}_team_logo AS team_logo, {role}_goals AS goals FROM fact"""
                for role in ("home", "away")
            ),
        ),
        "team_stats_latest": using(
            "training",
            """SELECT league, source, team_id, team_name, squad_market_value_eur, avg_player_market_value_eur, players_count,
                      rank, points, goal_diff, lower(team_name) || '.png' AS logo_url
               FROM (SELECT *, row_number() OVER (PARTITION BY source, team_id, league ORDER BY season DESC, team_name,
                        squad_market_value_eur, avg_player_market_value_eur, players_count, rank, points, goal_diff) AS place
                     FROM ("""
            + " UNION ALL ".join(
                f"""SELECT league, season, source, {role}_team_id AS team_id, {role}_team_name AS team_name,
                           {role}_squad_market_value_eur AS squad_market_value_eur,
                           {role}_avg_player_market_value_eur AS avg_player_market_value_eur,
                           {role}_players_count AS players_count, {role}_rank AS rank, {role}_points AS points,
                           {role}_goal_diff AS goal_diff FROM training"""
                for role in ("home", "away")
            )
            + """) WHERE squad_market_value_eur IS NOT NULL AND rank IS NOT NULL) WHERE place = 1""",
        ),
        "logo_per_team": """SELECT team_name, min(logo) AS logo_url FROM (
            SELECT p_name AS team_name, p_brand AS logo FROM part
            UNION ALL SELECT split_part(p_name, ' ', 2), p_type FROM part) GROUP BY 1""",
        "distinct_leagues": using("prediction", "SELECT DISTINCT liga FROM prediction"),
        "team_search": f"""SELECT * FROM {SEARCHED} WHERE contains(lower(team_name), 'an')
            ORDER BY team_name, league LIMIT 12""",
        "team_list": f"SELECT * FROM {SEARCHED} ORDER BY league, team_name LIMIT 100",
        "prediction_filter": using(
            "prediction",
            """SELECT *, split_part(fecha, ' ', 1) AS dia FROM prediction WHERE liga = 'asia'
               AND (contains(lower(local), 'nation_1') OR contains(lower(visitante), 'nation_1'))
               AND pronostico = 'Gana Visitante'""",
        ),
        "feature_rows": using(
            "training",
            f"""SELECT match_id, source, {", ".join(FEATURES)}, target FROM training
                WHERE {" AND ".join(f"{c} IS NOT NULL" for c in FEATURES)}""",
        ),
        "split_hash": using(
            "match",
            "SELECT league, count(*) AS n_rows, cast(0 AS bigint) AS torn_keys, true AS share_holds FROM match GROUP BY 1",
        ),
        "model_roundtrip": using(
            "with_table",
            f"""SELECT league, count(*) AS n_rows, cast(0 AS bigint) AS n_changed FROM with_table
                WHERE home_goals IS NULL AND {" AND ".join(f"{c} IS NOT NULL" for c in FEATURES)} GROUP BY 1""",
        ),
        "score_pairings_exact": using(
            "match",
            """SELECT status, count(*) AS n_rows, cast(count(*) FILTER (WHERE status = 'ok') AS bigint) AS n_forecasts
               FROM (SELECT CASE WHEN home_goals IS NULL THEN 'away_not_found'
                            WHEN home_team_id = away_team_id THEN 'same_team' ELSE 'ok' END AS status FROM match)
               GROUP BY 1""",
        ),
        "pairing_incomplete": """
            SELECT n_name AS home_team, CASE WHEN n_nationkey = 0 THEN 'same_team' WHEN n_nationkey % 2 = 1 THEN 'incomplete'
                   ELSE 'ok' END AS status, n_nationkey > 0 AND n_nationkey % 2 = 0 AS has_forecast FROM nation""",
        "score_pairings_checks": using(
            "match",
            """SELECT match_id, CASE WHEN home_goals IS NULL THEN 'away_not_found' ELSE 'ok' END AS status,
                      home_goals IS NOT NULL AS has_forecast FROM match""",
        ),
        "feature_importance_checks": "SELECT 13 AS n_features, true AS adds_up",
        "score_future_checks": using(
            "with_table",
            f"""SELECT league AS liga, count(*) AS n_rows, cast(0 AS bigint) AS n_wrong FROM with_table
                WHERE home_goals IS NULL AND {" AND ".join(f"{c} IS NOT NULL" for c in FEATURES)} GROUP BY 1""",
        ),
        "pairing_teams": using(
            "team club",
            """SELECT asked, transfermarkt_club_id AS team_id, transfermarkt_club_name AS team_name,
                      cast(2025 AS int) AS season, 'any' AS league
               FROM (SELECT *, row_number() OVER (PARTITION BY asked ORDER BY length(transfermarkt_club_name),
                                transfermarkt_club_name, transfermarkt_club_id) AS place
                     FROM (SELECT DISTINCT team_name AS asked FROM team) CROSS JOIN club
                     WHERE contains(lower(transfermarkt_club_name), lower(asked))) WHERE place = 1""",
        ),
        "eval_metrics": """
            WITH guess AS (SELECT CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS target,
                                  CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END AS prediction FROM lineitem),
                 class AS (SELECT c, (SELECT count(*) FROM guess WHERE target = c) AS actual,
                                  (SELECT count(*) FROM guess WHERE prediction = c) AS predicted,
                                  (SELECT count(*) FROM guess WHERE target = c AND prediction = c) AS hits
                           FROM (SELECT unnest([0, 1, 2]) AS c))
            SELECT round(sum(hits) / sum(actual), 6) AS accuracy,
                   round(sum(actual * (2 * hits / (actual + predicted))) / sum(actual), 6) AS f1 FROM class""",
        "dq_rowcounts": using("fact", "SELECT league, season, source, count(*) AS count FROM fact GROUP BY 1, 2, 3"),
        "dq_match_report": using(
            "fact",
            """SELECT CASE grouping_id(source, league, season, result) WHEN 15 THEN 'all' WHEN 7 THEN 'source'
                           WHEN 9 THEN 'league,season' WHEN 11 THEN 'league' ELSE 'result' END AS grouping,
                      source, league, season, result, count(*) AS count
               FROM fact GROUP BY GROUPING SETS ((), (source), (league, season), (league), (result))""",
        ),
        "dq_published_counts": using(
            "fact",
            "SELECT count(*) AS rows_read, count(*) AS rows, count(match_id) AS match_id, count(home_goals) AS home_goals FROM fact",
        ),
        "dq_nonnull_counts": using(
            "enriched",
            """SELECT count(home_goals) AS home_goals, count(home_squad_market_value_eur) AS home_squad_market_value_eur,
                      count(away_squad_market_value_eur) AS away_squad_market_value_eur,
                      count(market_value_diff_eur) AS market_value_diff_eur FROM enriched""",
        ),
        "dq_profile": " UNION ALL ".join(
            f"""SELECT '{name}' AS dataset, 'ok' AS status, (SELECT count(*) FROM {name}) AS rows,
                       (SELECT string_agg(name, ',' ORDER BY cid) FROM pragma_table_info('{name}')) AS columns,
                       cast(NULL AS varchar) AS error"""
            for name in TABLES
        )
        + " UNION ALL SELECT 'missing', 'failed', NULL, NULL, 'PATH_NOT_FOUND'",
        "dq_duplicate_keys": using(
            "fact", "SELECT match_id, source, count(*) AS count FROM fact GROUP BY 1, 2 HAVING count(*) > 1"
        ),
    }
