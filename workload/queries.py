"""One query per operator, over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake import functions, ml, operators, sources
from matchlake.functions.columns import forecast_label, target_of
from matchlake.ml.pairings import find_teams
from matchlake.operators.enrich import TRAINING_COLUMNS
from matchlake.plans import fields, tables
from matchlake.session import shared_folder
from workload import views
from workload.views import LEAGUES, TABLES, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LEAGUE_LABELS = {"africa": "Africa", "america": "The Americas", "asia": "Asia"}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- sources and sinks ---------------------------------------------------------


@query
def src_json_records(spark, sf_dir):
    """Orders landed as JSON below season folders, read back under a declared schema."""
    landed = shared_folder(spark, "json-records")
    orders = table(spark, sf_dir, "orders").withColumn("season", F.year("o_orderdate"))
    sources.write_files(orders, landed, "json", ("season",))
    schema = """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
                o_orderdate timestamp_ntz, o_orderpriority string, season int"""
    return sources.read_json_records(spark, landed, schema)


@query
def src_json_rejected(spark, sf_dir):
    """Orders as JSON lines, of which the pending ones are cut off; the lines that are no records, by order."""
    landed = shared_folder(spark, "json-rejected")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    line = F.to_json(F.struct("*"))
    broken = F.when(F.col("o_orderstatus") == "P", F.substr(line, F.lit(1), F.length(line) - 1)).otherwise(line)
    orders.select(broken.alias("value")).write.text(landed)
    good, rejected = sources.split_json_records(spark, landed, "o_orderkey bigint, o_custkey bigint, o_orderstatus string")
    key = F.regexp_extract("value", r'"o_orderkey":(\d+)', 1).cast("bigint")
    lost = rejected.select(key.alias("o_orderkey"), F.lit(None).cast("bigint").alias("o_custkey"), F.lit(True).alias("rejected"))
    return good.select("o_orderkey", "o_custkey", F.lit(False).alias("rejected")).unionByName(lost)


@query
def src_documents_rejected(spark, sf_dir):
    """Orders of a hundred customers each as one document, in files read whole; every third document is cut off."""
    landed = shared_folder(spark, "documents-rejected")
    orders = table(spark, sf_dir, "orders").withColumn("code", F.expr("o_custkey div 100"))
    rows = F.collect_list(F.struct("o_orderkey", "o_custkey")).alias("rows")
    document = F.to_json(F.struct("code", "rows"))
    cut = F.when(F.col("code") % 3 == 0, F.substr(document, F.lit(1), F.length(document) - 1)).otherwise(document)
    documents = orders.groupBy("code").agg(rows).select(cut.alias("value"), F.expr("code div 16").alias("folder"))
    sources.write_files(documents, landed, "text", ("folder",), maxRecordsPerFile="1")
    schema = "code bigint, rows array<struct<o_orderkey:bigint,o_custkey:bigint>>"
    good, rejected = sources.split_json_documents(spark, landed, schema, files="*.txt")
    whole = good.select("code", F.size("rows").cast("bigint").alias("n_rows"), F.lit(False).alias("rejected"))
    code = F.regexp_extract("value", r'"code":(\d+)', 1).cast("bigint")
    return whole.unionByName(rejected.select(code.alias("code"), F.lit(None).cast("bigint").alias("n_rows"), F.lit(True).alias("rejected")))


@query
def src_json_documents(spark, sf_dir):
    """Conversations as arrays of documents of sixteen turns, in files in nested folders, read whole."""
    landed = shared_folder(spark, "json-documents")
    page = F.floor(F.col("turn") / 16)
    documents = (
        table(spark, sf_dir, "conversations")
        .groupBy("conv_id", page.alias("page"))
        .agg(F.collect_list(F.struct("turn", "role", "text")).alias("rows"))
        .select(F.to_json(F.struct(F.struct(F.col("conv_id").alias("code")).alias("competition"), "rows")).alias("document"), "page", "conv_id")
    )
    # A file that is read whole holds one array, here of the documents of up to a thousand ids.
    arrays = documents.groupBy("page", F.expr("conv_id div 1000").alias("ids")).agg(
        F.concat(F.lit("["), F.array_join(F.collect_list("document"), ","), F.lit("]")).alias("value")
    )
    sources.write_files(arrays.drop("ids"), landed, "text", ("page",), maxRecordsPerFile="1")
    schema = "competition struct<code:bigint>, rows array<struct<turn:bigint,role:string,text:string>>"
    back = sources.read_json_documents(spark, landed, schema, files="*.txt")
    rows = operators.explode_rows(back, "rows", "row", [("competition.code", "conv_id")])
    return operators.flatten(rows, "conv_id\nrow.turn turn\nrow.role role\nrow.text text")


@query
def src_csv(spark, sf_dir):
    """Parts as gzip CSV with a header, read back by column name."""
    landed = shared_folder(spark, "csv")
    sources.write_files(table(spark, sf_dir, "part"), landed, "csv", header="true", compression="gzip")
    schema = "p_partkey bigint, p_name string, p_brand string, p_size int, p_retailprice double"
    return sources.read_csv(spark, landed, schema)


@query
def src_csv_headers(spark, sf_dir):
    """Parts as CSV files of one folder with three headers: two orders of the columns, and one without the size."""
    landed = shared_folder(spark, "csv-headers")
    parts = table(spark, sf_dir, "part")
    orders = [list(parts.columns), list(reversed(parts.columns)), [c for c in parts.columns if c != "p_size"]]
    for n, columns in enumerate(orders):
        some = parts.where(F.pmod("p_partkey", F.lit(3)) == n).select(*columns)
        sources.write_files(some, landed, "csv", mode="append", header="true")
    schema = "p_partkey bigint, p_name string, p_brand string, p_size int, p_retailprice double"
    return sources.split_csv(spark, landed, schema)[0]


@query
def src_parquet_partitioned(spark, sf_dir):
    """Orders laid out by status; the read of one status touches only its folder."""
    landed = shared_folder(spark, "parquet")
    sources.write_files(table(spark, sf_dir, "orders"), landed, "parquet", ("o_orderstatus",))
    orders = sources.require_rows(sources.read_parquet(spark, landed), "orders")
    return orders.filter(F.col("o_orderstatus") == "F")


def envelopes(spark, sf_dir):
    """Documents as vendor responses: toxic ones report an error, poor ones are empty."""
    documents = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    element = F.struct("lang", "source", "n_chars")
    return documents.select(
        "doc_id",
        F.when(F.col("toxic") == 1, '["toxic"]').when(F.col("toxic") == 0, "[ ]").alias("errors"),
        F.when(F.col("quality") == 0, F.array().cast("array<struct<lang:string,source:string,n_chars:bigint>>"))
        .otherwise(F.array(element))
        .alias("response"),
    )


@query
def envelope_decode(spark, sf_dir):
    return sources.decode_envelopes(envelopes(spark, sf_dir))[0]


@query
def envelope_rejected(spark, sf_dir):
    return sources.split_envelopes(envelopes(spark, sf_dir))[1].select("doc_id", "reason")


@query
def flatten_groups(spark, sf_dir):
    """Documents as grouped tables: lines are groups, their sentences rows."""
    groups = F.transform(
        F.split("text", "\n"),
        lambda line: F.transform(F.split(line, r"\. "), lambda sentence: F.struct(sentence.alias("sentence"))),
    )
    response = F.array(F.struct(F.struct(groups.alias("standings")).alias("league")))
    landed = table(spark, sf_dir, "documents").select("doc_id", response.alias("response"))
    return sources.flatten_groups(landed)


@query
def league_slice(spark, sf_dir):
    """Nations, their customers and those customers' orders, for three regions."""
    region, nation = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    clubs = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("club_id"),
        F.upper(F.substring("r_name", 1, 2)).alias("domestic_competition_id"),
    )
    players = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("player_id"), F.col("c_nationkey").alias("current_club_id")
    )
    valuations = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("player_id"), "o_orderkey")
    wanted = {"AF": "africa", "AS": "asia", "EU": "europe"}
    sliced = sources.slice_by_league(clubs, players, valuations, wanted)
    ids = {"clubs": "club_id", "players": "player_id", "player_valuations": "o_orderkey"}
    parts = [
        sliced[name].select(F.lit(name).alias("dataset"), "league", F.col(key).cast("bigint").alias("id"))
        for name, key in ids.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def sink_partitioned_roundtrip(spark, sf_dir):
    """Unified matches written by league and season, then read back."""
    landed = shared_folder(spark, "matches")
    sources.write_files(views.matches(spark, sf_dir), landed, "parquet", ("league", "season"))
    return sources.read_parquet(spark, landed)


@query
def sink_json_roundtrip(spark, sf_dir):
    """Matches as prediction records in JSON lines, NULLs included, then read back."""
    landed = shared_folder(spark, "predictions")
    sources.write_files(predictions(spark, sf_dir), landed, "json", ignoreNullFields="false")
    schema = "fecha string, liga string, local string, visitante string, goles bigint, pronostico string"
    return sources.read_json_records(spark, landed, schema)


@query
def sink_dated_landing(spark, sf_dir):
    """Events landed day by day below league, season and day, then counted per folder."""
    landed = shared_folder(spark, "landing")
    events = table(spark, sf_dir, "events").select(
        "event_id", F.col("event_type").alias("league"), F.year("ts").alias("season")
    )
    sources.land_records(events, landed, "2025-01-01")
    back = sources.read_json_records(spark, landed, "event_id bigint, league string, season int, ingest_date string")
    return operators.row_counts(back, "league", "season", "ingest_date")


# --- nested data ---------------------------------------------------------------


@query
def flatten_struct(spark, sf_dir):
    """Vendor A's team records, every match's, made flat."""
    return operators.flatten(views.raw_teams_a(spark, sf_dir), fields.TEAM_FIELDS_A)


@query
def explode_one_level(spark, sf_dir):
    """The lines of every document, with the document's header."""
    lines = F.transform(F.split("text", "\n"), lambda line: F.struct(line.alias("line")))
    filled = F.when(F.length("text") > 0, F.filter(lines, lambda x: F.length(x["line"]) > 0))
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", F.struct("lang", "source").alias("header"), filled.alias("lines")
    )
    rows = operators.explode_rows(documents, "lines", "row", [("doc_id", "doc_id"), ("header.lang", "lang")])
    return operators.flatten(rows, [("doc_id", "doc_id"), ("lang", "lang"), ("row.line", "line")])


@query
def explode_two_level(spark, sf_dir):
    """Vendor B's standings: groups, then the rows of the overall ones."""
    documents = views.raw_standings_b(spark, sf_dir)
    return tables.fact_standings_b(documents, leagues=LEAGUES)


# --- scalar expressions --------------------------------------------------------


@query
def parse_timestamp(spark, sf_dir):
    """Event times as ISO text, with their fractions; those of errors are damaged and give NULL."""
    written = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    text = F.when(F.col("event_type") == "error", F.concat(F.lit("x"), written)).otherwise(written)
    events = table(spark, sf_dir, "events").select("event_id", text.alias("raw"))
    return events.select("event_id", functions.parse_timestamp(F.col("raw")).cast("timestamp_ntz").alias("ts"))


@query
def season_of(spark, sf_dir):
    """Season of every order's date text; unspecified priorities have damaged dates."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.concat(F.lit("x"), day)).otherwise(day)
    return table(spark, sf_dir, "orders").select("o_orderkey", functions.season_of(text).alias("season"))


@query
def league_map(spark, sf_dir):
    """Every customer's league by its code, one code being unknown, and its label."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    codes = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("c_nationkey"), F.upper(F.substring("r_name", 1, 2)).alias("code")
    )
    customers = table(spark, sf_dir, "customer").join(codes, "c_nationkey")
    league = functions.league_name(F.col("code"), LEAGUES)
    return customers.select(
        "c_custkey", "code", league.alias("league"), functions.league_label(league, LEAGUE_LABELS).alias("label")
    )


@query
def outcome_from_score(spark, sf_dir):
    """Matches per league, season and outcome by goals."""
    result = functions.outcome_from_score(F.col("home_goals"), F.col("away_goals"))
    matches = views.lines(spark, sf_dir).select("league", "season", result.alias("result"))
    return operators.row_counts(matches, "league", "season", "result")


@query
def outcome_from_code(spark, sf_dir):
    """Vendor B's matches per season, winner code and outcome."""
    matches = views.fact_matches_b(spark, sf_dir)
    decoded = matches.select("season", "winner_raw", functions.outcome_from_code(F.col("winner_raw")).alias("result"))
    return operators.row_counts(decoded, "season", "winner_raw", "result")


def _names(spark, sf_dir):
    team = F.concat(F.lit("Club "), "p_name", F.lit(" F.C. Fc #"), "p_brand")
    parts = table(spark, sf_dir, "part").select(
        F.lit("part").alias("kind"), F.col("p_partkey").alias("id"), team.alias("name")
    )
    documents = table(spark, sf_dir, "documents").select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.col("text").alias("name")
    )
    return parts.unionByName(documents)


@query
def name_key_simple(spark, sf_dir):
    return _names(spark, sf_dir).select("kind", "id", functions.name_key(F.col("name")).alias("name_key"))


@query
def name_key_club(spark, sf_dir):
    return _names(spark, sf_dir).select("kind", "id", functions.club_key(F.col("name")).alias("name_key"))


# --- published tables ----------------------------------------------------------


@query
def fact_matches_score(spark, sf_dir):
    matches = views.fact_matches_a(spark, sf_dir)
    return matches.withColumn("match_date", F.col("match_date").cast("timestamp_ntz"))


@query
def fact_matches_code(spark, sf_dir):
    matches = views.fact_matches_b(spark, sf_dir)
    return matches.withColumn("match_date", F.col("match_date").cast("timestamp_ntz"))


@query
def union_sources(spark, sf_dir):
    return views.fact_matches(spark, sf_dir)


@query
def dim_teams_unified(spark, sf_dir):
    teams_a = tables.dim_teams_a(views.raw_teams_a(spark, sf_dir))
    teams_b = tables.dim_teams_b(views.raw_teams_b(spark, sf_dir), leagues=LEAGUES)
    return tables.dim_teams(teams_a, teams_b)


@query
def fact_standings(spark, sf_dir):
    """Vendor A's standings through its nested records."""
    return tables.fact_standings_a(views.raw_standings_a(spark, sf_dir))


@query
def standings_relanded(spark, sf_dir):
    """Vendor A's standings landed on two days with different figures, the later day twice: its figures hold."""
    landed = shared_folder(spark, "standings")
    raw = views.raw_standings_a(spark, sf_dir)
    early = raw.withColumns({"rank": F.col("rank") - 100, "points": F.lit(0).cast("bigint"), "goalsDiff": F.lit(-999).cast("bigint")})
    for rows, day in ((raw, "2025-05-30"), (early, "2024-09-01"), (raw, "2025-05-30")):
        sources.land_records(rows, landed, day)
    back = sources.with_landing(sources.read_json_records(spark, landed, raw.schema))
    return tables.fact_standings_a(back)


@query
def standings_upserted(spark, sf_dir):
    """Vendor A's standings in a table that three landings are merged into: all, wrong ones of some leagues, right ones.

    The second landing is of an earlier day and so changes nothing; the third replaces the
    figures of the leagues it has.
    """
    target, raw = shared_folder(spark, "standings-table"), views.raw_standings_a(spark, sf_dir)
    wrong = raw.withColumns({"points": F.lit(0).cast("bigint"), "goalsDiff": F.lit(-999).cast("bigint")})
    asia = F.col("league") == "asia"
    landings = ((raw.where(~asia).unionByName(wrong.where(asia)), "2025-01-31"), (wrong.where(~asia), "2024-09-01"), (raw.where(asia), "2025-05-30"))
    for rows, day in landings:
        landed = shared_folder(spark, "standings-landing")
        sources.land_records(rows, landed, day)
        back = sources.with_landing(sources.read_json_records(spark, landed, raw.schema))
        table_rows = tables.fact_standings_a(back, keep_landed=True)
        sources.upsert(table_rows, target, tables.TEAM_SEASON, tables.LANDED, ("league", "season"))
    return sources.read_parquet(spark, target).drop(tables.LANDED)


@query
def union_standings(spark, sf_dir):
    """Both vendors' standings, through their shapes, stacked."""
    b = tables.fact_standings_b(views.raw_standings_b(spark, sf_dir), leagues=LEAGUES)
    return tables.standings(tables.fact_standings_a(views.raw_standings_a(spark, sf_dir)), b)


@query
def dedupe_keys(spark, sf_dir):
    """One order line per order and line number, the smallest by its other columns."""
    return operators.keep_one(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dim_clubs(spark, sf_dir):
    """Parts as clubs: one per size and type, with its simple key."""
    clubs = table(spark, sf_dir, "part").select(
        F.concat_ws(" & ", "p_name", "p_type").alias("name"),
        F.col("p_size").alias("club_id"),
        F.col("p_brand").alias("club_code"),
        F.col("p_type").alias("domestic_competition_id"),
        F.col("p_size").alias("squad_size"),
        F.col("p_retailprice").alias("average_age"),
        F.lit(None).cast("int").alias("foreigners_number"),
        F.lit(None).cast("double").alias("foreigners_percentage"),
        F.lit(None).cast("int").alias("national_team_players"),
        F.col("p_brand").alias("stadium_name"),
        F.col("p_partkey").alias("stadium_seats"),
        F.lit(None).cast("string").alias("net_transfer_record"),
        F.col("p_name").alias("coach_name"),
        F.lit(2025).alias("last_season"),
        F.concat(F.lit("/"), "p_name").alias("url"),
        F.lower("p_type").alias("league"),
    )
    return tables.dim_clubs(clubs)


@query
def team_values(spark, sf_dir):
    return views.squad_values(spark, sf_dir)


@query
def top_teams(spark, sf_dir):
    return operators.top_teams(views.squad_values(spark, sf_dir))


# --- name resolution -----------------------------------------------------------


@query
def candidates_levenshtein(spark, sf_dir):
    """Teams and clubs whose names are at most four edits apart, in report order."""
    teams, clubs = views.named_teams(spark, sf_dir), views.named_clubs(spark, sf_dir)
    return operators.name_candidates(teams, clubs, max_distance=4, season=2025, ordered=True)


@query
def resolve_auto(spark, sf_dir):
    teams = operators.teams_of_season(views.named_teams(spark, sf_dir), None)
    return operators.automatic_matches(teams, views.named_clubs(spark, sf_dir))


@query
def resolve_manual(spark, sf_dir):
    teams, clubs = views.named_teams(spark, sf_dir), views.named_clubs(spark, sf_dir)
    return operators.manual_matches(teams, clubs, views.overrides(spark, sf_dir))


@query
def resolve_final(spark, sf_dir):
    teams, clubs = views.named_teams(spark, sf_dir), views.named_clubs(spark, sf_dir)
    return operators.resolve_teams(teams, clubs, views.overrides(spark, sf_dir), season=2025)


# --- enrichment and datasets ---------------------------------------------------


def enriched(spark, sf_dir):
    return operators.enrich(views.matches(spark, sf_dir), views.club_links(spark, sf_dir))


def training_sets(spark, sf_dir):
    return operators.training_sets(enriched(spark, sf_dir), views.standings(spark, sf_dir))


@query
def enrich_two_sided(spark, sf_dir):
    return enriched(spark, sf_dir)


@query
def enrich_compat(spark, sf_dir):
    """The same with the earlier jobs' keys: teams of both vendors cross over, per season."""
    matches = views.matches(spark, sf_dir).select("match_id", "source", "league", "home_team_id", "away_team_id")
    links = operators.teams_of_season(views.club_links(spark, sf_dir), None)
    both = operators.enrich(matches, links, compat=True)
    return operators.row_counts(both, "source", "league", "home_transfermarkt_club_name", "away_transfermarkt_club_id")


@query
def standings_join(spark, sf_dir):
    matches = views.matches(spark, sf_dir)
    return operators.with_standings(matches, views.standings(spark, sf_dir))


@query
def training_dataset(spark, sf_dir):
    return training_sets(spark, sf_dir)[0]


@query
def future_dataset(spark, sf_dir):
    return training_sets(spark, sf_dir)[1]


@query
def undecided_matches(spark, sf_dir):
    """Matches outside both datasets, per outcome: those whose away goals alone are missing."""
    matches = views.matches(spark, sf_dir)
    away = F.when(F.col("home_goals") != 4, F.col("away_goals"))
    damaged = matches.withColumns(
        {"away_goals": away, "result": functions.outcome_from_score(F.col("home_goals"), away)}
    )
    links, table_ = views.club_links(spark, sf_dir), views.standings(spark, sf_dir)
    undecided = operators.training_sets(operators.enrich(damaged, links), table_)[2]
    return operators.row_counts(undecided, "league", "season", "result")


@query
def unpivot_roles(spark, sf_dir):
    roles = ["team_id", "team_name", "team_logo", "goals"]
    return operators.stack_roles(views.matches(spark, sf_dir), ["match_id", "league", "season", "source"], roles)


@query
def team_stats_latest(spark, sf_dir):
    logos = operators.logo_per_team(views.matches(spark, sf_dir))
    return operators.latest_team_stats(training_sets(spark, sf_dir)[0], logos)


@query
def logo_per_team(spark, sf_dir):
    """The smallest of the brands and types seen with each part name, on either side of a row."""
    part = table(spark, sf_dir, "part")
    seen = part.select(
        F.col("p_name").alias("home_team_name"),
        F.col("p_brand").alias("home_team_logo"),
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("away_team_name"),
        F.col("p_type").alias("away_team_logo"),
    )
    return operators.logo_per_team(seen)


# --- lookups -------------------------------------------------------------------


def predictions(spark, sf_dir):
    """Matches as prediction records, the outcome standing in for the forecast."""
    matches = views.matches(spark, sf_dir)
    forecast = forecast_label(target_of(F.col("result")))
    return matches.select(
        F.date_format("match_date", "yyyy-MM-dd HH:mm:ss").alias("fecha"),
        F.col("league").alias("liga"),
        F.col("home_team_name").alias("local"),
        F.col("away_team_name").alias("visitante"),
        F.col("home_goals").alias("goles"),
        forecast.alias("pronostico"),
    )


@query
def distinct_leagues(spark, sf_dir):
    return operators.distinct_leagues(predictions(spark, sf_dir))


@query
def team_search(spark, sf_dir):
    """The first twelve part names that contain a text."""
    teams = table(spark, sf_dir, "part").select(F.col("p_name").alias("team_name"), F.lower("p_type").alias("league"))
    return operators.search_teams(teams.distinct(), "AN")


@query
def team_list(spark, sf_dir):
    """The first hundred teams by league and name."""
    teams = table(spark, sf_dir, "part").select(F.col("p_name").alias("team_name"), F.lower("p_type").alias("league"))
    return operators.search_teams(teams.distinct(), limit=100, by_league=True)


@query
def prediction_filter(spark, sf_dir):
    return operators.filter_predictions(
        predictions(spark, sf_dir), league="asia", team="Nation_1", forecast="Gana Visitante"
    )


# --- model ---------------------------------------------------------------------


@query
def feature_rows(spark, sf_dir):
    training = training_sets(spark, sf_dir)[0]
    return ml.feature_rows(training, target="target").select("match_id", "source", *ml.FEATURES, "target")


@query
def split_hash(spark, sf_dir):
    """Rows per league on both sides of the split, and whether the shares and keys hold."""
    matches = views.lines(spark, sf_dir).select("match_id", "source", "league")
    training, test = ml.split(matches)
    both = training.withColumn("training", F.lit(1)).unionByName(test.withColumn("training", F.lit(0)))
    per_key = both.groupBy("match_id", "source", "league").agg(
        F.count(F.lit(1)).alias("n"), F.sum("training").alias("n_training")
    )
    torn = F.count_if((F.col("n_training") != 0) & (F.col("n_training") != F.col("n")))
    share = F.sum("n_training") / F.sum("n")
    return per_key.groupBy("league").agg(
        F.sum("n").alias("n_rows"), torn.alias("torn_keys"), (F.abs(share - 0.8) < 0.03).alias("share_holds")
    )


@cache
def team_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Squad values and standings, made from all matches once per session for the fit and the pairings' profiles."""
    links, table_ = views.club_links(spark, sf_dir), views.standings(spark, sf_dir)
    return sources.intermediate(links, "club-links"), sources.intermediate(table_, "standings")


@cache
def model_sets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """What the model reads of the two datasets, joined once per session for the fit and the forecasts."""
    links, table_ = team_tables(spark, sf_dir)
    matches = operators.with_standings(operators.enrich(views.matches(spark, sf_dir), links), table_)
    return operators.split_matches(sources.intermediate(matches.select(*TRAINING_COLUMNS), "model-matches"))[:2]


@cache
def fitted(spark: SparkSession, sf_dir: str) -> PipelineModel:
    """The forest on the training part, fitted once per session."""
    training = ml.feature_rows(ml.split(model_sets(spark, sf_dir)[0])[0], target="target")
    return ml.fit_forest(training, tasks=ml.fit_tasks(training.count()))


@query
def train_forest(spark, sf_dir):
    """Accuracy and F1 of the forest on the held-out matches."""
    model = fitted(spark, sf_dir)
    test = ml.split(ml.feature_rows(model_sets(spark, sf_dir)[0], target="target"))[1]
    return ml.evaluate(model.transform(test))


@query
def feature_importance(spark, sf_dir):
    return ml.importances(spark, fitted(spark, sf_dir))


@query
def score_future(spark, sf_dir):
    return ml.score(fitted(spark, sf_dir), model_sets(spark, sf_dir)[1])


@query
def score_future_checks(spark, sf_dir):
    """Forecasts per league, and those whose shares or label can't be right."""
    scored = ml.score(fitted(spark, sf_dir), model_sets(spark, sf_dir)[1])
    shares = [F.col(name) for name in ml.scoring.PERCENTAGES]
    largest = F.greatest(*shares)
    named = F.when(F.col("pronostico") == forecast_label(F.lit(0.0)), shares[0])
    named = named.when(F.col("pronostico") == forecast_label(F.lit(1.0)), shares[1])
    named = named.when(F.col("pronostico") == forecast_label(F.lit(2.0)), shares[2])
    wrong = F.coalesce((F.abs(sum(shares[1:], shares[0]) - 100) > 0.05) | (largest - named > 0.011), F.lit(True))
    return scored.groupBy("liga").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(wrong).alias("n_wrong"))


@query
def feature_importance_checks(spark, sf_dir):
    """How many features the forest weighs, and whether their importances add up."""
    found = ml.importances(spark, fitted(spark, sf_dir))
    total = F.sum(F.col("importance"))
    return found.agg(F.count(F.lit(1)).alias("n_features"), (F.abs(total - 1) < 1e-6).alias("adds_up"))


@query
def model_roundtrip(spark, sf_dir):
    """Forecasts of a saved and loaded model that differ from the fitted one's, per league."""
    model, path = fitted(spark, sf_dir), shared_folder(spark, "model")
    ml.save_model(model, path)
    rows = ml.feature_rows(model_sets(spark, sf_dir)[1])
    fresh = ml.with_forecast(model, rows).select("league", *ml.FEATURES, F.col("pronostico").alias("fresh"))
    both = ml.with_forecast(ml.load_model(path), fresh)
    return both.groupBy("league").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("fresh") != F.col("pronostico")).alias("n_changed")
    )


def asked_pairings(spark, sf_dir):
    """Every match as a pairing asked for by lower-case names, one of them unknown before kick-off."""
    away = F.when(F.col("away_goals").isNull(), "no such club").otherwise(F.lower("away_team_name"))
    return views.lines(spark, sf_dir).select(
        "match_id", F.lower("home_team_name").alias("home_team"), away.alias("away_team")
    )


def profiles(spark, sf_dir):
    return operators.team_profiles(*team_tables(spark, sf_dir))


@query
def pairing_teams(spark, sf_dir):
    """The club meant by each customer's number and by each part name."""
    clubs = views.named_clubs(spark, sf_dir).select(
        F.col("current_club_id").alias("team_id"),
        F.col("current_club_name").alias("team_name"),
        F.lit(2025).alias("season"),
        F.lit("any").alias("league"),
    )
    texts = views.named_teams(spark, sf_dir).select(F.col("team_name").alias("asked"))
    return find_teams(texts, clubs)


@query
def score_pairings(spark, sf_dir):
    return ml.score_pairings(asked_pairings(spark, sf_dir), profiles(spark, sf_dir), fitted(spark, sf_dir))


@query
def score_pairings_exact(spark, sf_dir):
    """Pairings per status when names must be equal and missing figures count as zero."""
    pairings = asked_pairings(spark, sf_dir).withColumns(
        {"home_team": F.upper("home_team"), "away_team": F.upper("away_team")}
    )
    scored = ml.score_pairings(
        pairings, profiles(spark, sf_dir), fitted(spark, sf_dir), lookup="exact", null_fill=0.0
    )
    return scored.groupBy("status").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("pronostico").alias("n_forecasts")
    )


@query
def pairing_incomplete(spark, sf_dir):
    """Every nation against nation 0, where nations of odd numbers have a squad and no table."""
    links = views.club_links(spark, sf_dir)
    table_ = views.standings(spark, sf_dir).filter(F.col("team_id") % 2 == 0)
    away = F.regexp_replace("n_name", "[0-9]+$", "0")
    pairings = table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("home_team"), away.alias("away_team"), F.lit(None).cast("string").alias("league")
    )
    scored = ml.score_pairings(pairings, operators.team_profiles(links, table_), fitted(spark, sf_dir), lookup="exact")
    return scored.select("home_team", "status", F.col("pronostico").isNotNull().alias("has_forecast"))


@query
def score_pairings_checks(spark, sf_dir):
    """Status of every pairing, and whether it has a forecast."""
    scored = ml.score_pairings(asked_pairings(spark, sf_dir), profiles(spark, sf_dir), fitted(spark, sf_dir))
    return scored.select("match_id", "status", F.col("pronostico").isNotNull().alias("has_forecast"))


@query
def eval_metrics(spark, sf_dir):
    """Accuracy and weighted F1 of the line status as a forecast of the return flag."""
    flag = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    guess = F.when(F.col("l_linestatus") == "F", 0.0).otherwise(1.0)
    guesses = table(spark, sf_dir, "lineitem").select(flag.alias("target"), guess.alias("prediction"))
    return ml.evaluate(guesses).select(F.round("accuracy", 6).alias("accuracy"), F.round("f1", 6).alias("f1"))


# --- data quality --------------------------------------------------------------


@query
def dq_rowcounts(spark, sf_dir):
    return operators.row_counts(views.matches(spark, sf_dir), "league", "season", "source")


@query
def dq_match_report(spark, sf_dir):
    """Matches in all, by source, by league and season, by league and by result, from one scan."""
    groupings = [[], ["source"], ["league", "season"], ["league"], ["result"]]
    return operators.grouped_counts(views.matches(spark, sf_dir), groupings)


@query
def dq_published_counts(spark, sf_dir):
    """Rows and non-null goals that were counted while matches were written as a published table."""
    matches, seen = sources.counted(views.matches(spark, sf_dir).select("match_id", "league", "home_goals"))
    path = shared_folder(spark, "published")
    sources.publish(matches, path, partition_by=("league",))
    read = sources.read_parquet(spark, path).agg(F.count(F.lit(1)).alias("rows_read"))
    return read.select("rows_read", *[F.lit(seen.get[k]).alias(k.replace("nonnull.", "")) for k in ("rows", "nonnull.match_id", "nonnull.home_goals")])


@query
def dq_nonnull_counts(spark, sf_dir):
    matches = enriched(spark, sf_dir)
    return operators.nonnull_counts(
        matches,
        ["home_goals", "home_squad_market_value_eur", "away_squad_market_value_eur", "market_value_diff_eur"],
    )


@query
def dq_duplicate_keys(spark, sf_dir):
    return operators.duplicate_keys(views.matches(spark, sf_dir), ["match_id", "source"])


@query
def dq_profile(spark, sf_dir):
    """All tables and one that does not exist."""
    return operators.profile(
        spark, {name: lambda name=name: table(spark, sf_dir, name) for name in (*TABLES, "missing")}
    )
