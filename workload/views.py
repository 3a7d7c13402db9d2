"""Match-analytics tables derived from the star-schema tables.

Order lines are matches between the customer's and the supplier's nation: the
line status tells the vendor, the order date the season, the customer's region
the league. Customers are also players of their nation's club.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchlake.functions import name_key, outcome_from_score
from matchlake.operators import stack_roles, team_values
from matchlake.plans import tables
from matchlake.plans.fields import SOURCE_A, SOURCE_B

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
LEAGUES = {"AF": "africa", "AM": "america", "AS": "asia", "EU": "europe"}
FIRST_VALUED_SEASON = 1999
#: Range of match numbers whose matches of a league and season are one document.
DOCUMENT_MATCHES = 20_000


@cache
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its footer is read once per session."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def iso(day: Column, zone: str) -> Column:
    return F.concat(F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(zone))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line with both nations, before any vendor's shape is put on it.

    Each dimension is joined as the file it is, so that Spark sees its true size:
    the estimate of a joined dimension is a product, and above some size the
    facts would be broadcast in its place.
    """
    nation = table(spark, sf_dir, "nation")
    home = nation.select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("home_team_name"), "n_regionkey"
    )
    away = nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("away_team_name"))
    region = table(spark, sf_dir, "region")
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    orders = table(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    lineitem = table(spark, sf_dir, "lineitem").join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    joined = (
        lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(home, "c_nationkey")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(away, "s_nationkey")
    )
    played = F.col("o_orderstatus") != "P"
    home_goals = F.when(played, F.col("l_quantity").cast("bigint") % 5)
    away_goals = F.when(played, (F.col("l_linenumber") % 4).cast("bigint"))
    return joined.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("match_id"),
        F.col("o_orderdate").alias("match_date"),
        F.lower("r_name").alias("league"),
        "r_name",
        F.upper(F.substring("r_name", 1, 2)).alias("code"),
        F.year("o_orderdate").alias("season"),
        F.when(F.col("l_linestatus") == "F", SOURCE_A).otherwise(SOURCE_B).alias("source"),
        F.col("c_nationkey").cast("bigint").alias("home_team_id"),
        "home_team_name",
        F.col("s_nationkey").cast("bigint").alias("away_team_id"),
        "away_team_name",
        home_goals.alias("home_goals"),
        away_goals.alias("away_goals"),
        F.floor(home_goals / 2).alias("home_goals_halftime"),
        F.floor(away_goals / 2).alias("away_goals_halftime"),
        F.when(played, "Match Finished").otherwise("Not Started").alias("match_status"),
        "o_orderpriority",
        "l_partkey",
        "l_suppkey",
        "s_name",
    )


def lines_of(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    return lines(spark, sf_dir).filter(F.col("source") == source)


def logo(name: Column) -> Column:
    return F.concat(F.lower(name), F.lit(".png"))


def raw_fixtures_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendor A's fixture records."""
    home, away = F.col("home_goals"), F.col("away_goals")
    finished = home.isNotNull()

    def side(role: str, winner: Column) -> Column:
        name = F.col(f"{role}_team_name")
        return F.struct(
            F.col(f"{role}_team_id").alias("id"),
            name.alias("name"),
            logo(name).alias("logo"),
            winner.alias("winner"),
        )

    def goals(suffix: str = "") -> Column:
        return F.struct(F.col(f"home_goals{suffix}").alias("home"), F.col(f"away_goals{suffix}").alias("away"))

    days = F.date_diff(F.col("match_date").cast("date"), F.lit("1970-01-01").cast("date"))
    return lines_of(spark, sf_dir, SOURCE_A).select(
        F.struct(
            F.col("match_id").alias("id"),
            iso(F.col("match_date"), "+00:00").alias("date"),
            (days.cast("bigint") * 86400).alias("timestamp"),
            F.lit("UTC").alias("timezone"),
            F.col("o_orderpriority").alias("referee"),
            F.struct(
                F.col("l_suppkey").alias("id"),
                F.col("s_name").alias("name"),
                F.col("away_team_name").alias("city"),
            ).alias("venue"),
            F.struct(
                F.col("match_status").alias("long"),
                F.when(finished, "FT").otherwise("NS").alias("short"),
                F.when(finished, F.lit(90)).cast("bigint").alias("elapsed"),
            ).alias("status"),
        ).alias("fixture"),
        F.struct(side("home", home > away).alias("home"), side("away", away > home).alias("away")).alias("teams"),
        goals().alias("goals"),
        F.struct(goals("_halftime").alias("halftime"), goals().alias("fulltime")).alias("score"),
        "league",
        "season",
    )


def raw_matches_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendor B's match documents: some matches of a league and season each."""
    home, away = F.col("home_goals"), F.col("away_goals")

    def side(role: str) -> Column:
        name = F.col(f"{role}_team_name")
        return F.struct(
            F.col(f"{role}_team_id").alias("id"),
            name.alias("name"),
            F.lower(name).alias("shortName"),
            F.substring(name, 1, 3).alias("tla"),
            logo(name).alias("crest"),
        )

    winner = F.when(home > away, "HOME_TEAM").when(home < away, "AWAY_TEAM").when(home == away, "DRAW")
    match = F.struct(
        F.col("match_id").alias("id"),
        iso(F.col("match_date"), "Z").alias("utcDate"),
        F.month("match_date").cast("bigint").alias("matchday"),
        F.col("o_orderpriority").alias("stage"),
        F.col("match_status").alias("status"),
        F.struct(
            F.concat(F.col("season").cast("string"), F.lit("-01-01")).alias("startDate"),
            F.concat(F.col("season").cast("string"), F.lit("-12-31")).alias("endDate"),
        ).alias("season"),
        side("home").alias("homeTeam"),
        side("away").alias("awayTeam"),
        F.struct(
            winner.alias("winner"),
            F.struct(home.alias("home"), away.alias("away")).alias("fullTime"),
            F.struct(
                F.col("home_goals_halftime").alias("home"), F.col("away_goals_halftime").alias("away")
            ).alias("halfTime"),
        ).alias("score"),
    )
    chunk = F.expr(f"match_id div {DOCUMENT_MATCHES}").alias("chunk")
    documents = lines_of(spark, sf_dir, SOURCE_B).groupBy("code", "r_name", "season", chunk)
    return documents.agg(F.collect_list(match).alias("matches")).select(competition().alias("competition"), "matches")


def competition() -> Column:
    return F.struct(F.col("code"), F.col("r_name").alias("name"))


def raw_teams_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendor A's team records: the home side of every match, so teams repeat."""
    name = F.col("home_team_name")
    return lines_of(spark, sf_dir, SOURCE_A).select(
        F.struct(
            F.col("home_team_id").alias("id"),
            name.alias("name"),
            F.substring(name, 1, 3).alias("code"),
            F.col("r_name").alias("country"),
            F.col("l_suppkey").alias("founded"),
            logo(name).alias("logo"),
            F.lit(False).alias("national"),
        ).alias("team"),
        F.struct(
            F.col("l_partkey").alias("id"),
            F.col("s_name").alias("name"),
            F.col("away_team_name").alias("city"),
            F.col("o_orderpriority").alias("address"),
            F.col("l_partkey").alias("capacity"),
            F.col("match_status").alias("surface"),
            logo(F.col("s_name")).alias("image"),
        ).alias("venue"),
        "league",
        "season",
    )


def raw_teams_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendor B's team documents: both sides of every match."""

    def side(role: str) -> Column:
        name = F.col(f"{role}_team_name")
        return F.struct(
            F.col(f"{role}_team_id").alias("id"),
            name.alias("name"),
            F.lower(name).alias("shortName"),
            F.substring(name, 1, 3).alias("tla"),
            logo(name).alias("crest"),
            F.col("l_suppkey").alias("founded"),
            F.col("s_name").alias("venue"),
            F.concat(F.lower(name), F.lit(".example")).alias("website"),
            F.col("o_orderpriority").alias("clubColors"),
            F.struct(
                F.col("l_suppkey").alias("id"),
                F.col("r_name").alias("name"),
                F.col("code").alias("code"),
                logo(F.col("r_name")).alias("flag"),
            ).alias("area"),
            F.struct(
                F.col("l_partkey").alias("id"), F.col("s_name").alias("name"), F.col("r_name").alias("nationality")
            ).alias("coach"),
        )

    start = F.struct(F.concat(F.col("season").cast("string"), F.lit("-01-01")).alias("startDate"))
    return lines_of(spark, sf_dir, SOURCE_B).select(
        competition().alias("competition"), start.alias("season"), F.array(side("home"), side("away")).alias("teams")
    )


def records(matches: DataFrame) -> DataFrame:
    """Results of each team, league, season and vendor: overall, at home and away."""

    def side(role: str, other: str) -> Column:
        return F.struct(
            F.lit(role).alias("role"),
            F.col(f"{role}_team_id").alias("team_id"),
            F.col(f"{role}_team_name").alias("team_name"),
            F.col(f"{role}_goals").alias("scored"),
            F.col(f"{other}_goals").alias("conceded"),
        )

    both = F.explode(F.array(side("home", "away"), side("away", "home"))).alias("side")
    sides = matches.select("source", "league", "season", both).select("source", "league", "season", "side.*")
    counted = []
    for suffix, chosen in (("all", F.lit(True)), ("home", F.col("role") == "home"), ("away", F.col("role") == "away")):
        scored, conceded = F.col("scored"), F.col("conceded")
        counted += [
            F.count_if(chosen & scored.isNotNull()).alias(f"played_{suffix}"),
            F.count_if(chosen & (scored > conceded)).alias(f"wins_{suffix}"),
            F.count_if(chosen & (scored == conceded)).alias(f"draws_{suffix}"),
            F.count_if(chosen & (scored < conceded)).alias(f"losses_{suffix}"),
            F.coalesce(F.sum(F.when(chosen, scored)), F.lit(0)).alias(f"goals_for_{suffix}"),
            F.coalesce(F.sum(F.when(chosen, conceded)), F.lit(0)).alias(f"goals_against_{suffix}"),
        ]
    results = sides.groupBy("source", "league", "season", "team_id", "team_name").agg(*counted)
    table_order = Window.partitionBy("source", "league", "season").orderBy(
        F.desc("points"), F.desc("goal_difference"), "team_id"
    )
    return results.withColumns(
        {
            "points": F.col("wins_all") * 3 + F.col("draws_all"),
            "goal_difference": F.col("goals_for_all") - F.col("goals_against_all"),
        }
    ).withColumn("rank", F.row_number().over(table_order).cast("bigint"))


def raw_standings_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendor A's standing rows."""

    def record(suffix: str) -> Column:
        return F.struct(
            F.col(f"played_{suffix}").alias("played"),
            F.col(f"wins_{suffix}").alias("win"),
            F.col(f"draws_{suffix}").alias("draw"),
            F.col(f"losses_{suffix}").alias("lose"),
            F.struct(
                F.col(f"goals_for_{suffix}").alias("for"), F.col(f"goals_against_{suffix}").alias("against")
            ).alias("goals"),
        ).alias(suffix)

    name = F.col("team_name")
    return records(lines_of(spark, sf_dir, SOURCE_A)).select(
        F.struct(F.col("team_id").alias("id"), name.alias("name"), logo(name).alias("logo")).alias("team"),
        "rank",
        "points",
        F.col("goal_difference").alias("goalsDiff"),
        F.lit(None).cast("string").alias("form"),
        F.when(F.col("rank") == 1, "Champion").alias("description"),
        F.lit("same").alias("status"),
        F.col("league").alias("group"),
        F.concat(F.col("season").cast("string"), F.lit("-12-31")).alias("update"),
        record("all"),
        record("home"),
        record("away"),
        "league",
        "season",
    )


def raw_standings_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendor B's standing documents, one for each league and season: an overall and a home table."""

    def group(kind: str, points: Column) -> Column:
        row = F.struct(
            F.col("rank").alias("position"),
            F.struct(F.col("team_id").alias("id"), F.col("team_name").alias("name")).alias("team"),
            points.alias("points"),
            F.col("goal_difference").alias("goalDifference"),
            F.lit(None).cast("string").alias("form"),
        )
        return F.struct(F.lit(kind).alias("type"), F.collect_list(row).alias("table"))

    overall = group("TOTAL", F.col("points"))
    at_home = group("HOME", F.col("wins_home") * 3 + F.col("draws_home"))
    documents = records(lines_of(spark, sf_dir, SOURCE_B)).groupBy("league", F.col("season").alias("year"))
    return documents.agg(F.array(overall, at_home).alias("standings")).select(
        F.struct(F.upper(F.substring("league", 1, 2)).alias("code")).alias("competition"),
        F.struct(F.concat(F.col("year").cast("string"), F.lit("-01-01")).alias("startDate")).alias("season"),
        "standings",
    )


def fact_matches_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.fact_matches_a(raw_fixtures_a(spark, sf_dir))


def fact_matches_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.fact_matches_b(raw_matches_b(spark, sf_dir), LEAGUES | {"MI": "middle east"})


def fact_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both vendors' matches, taken through the vendors' shapes and unified."""
    unified = tables.fact_matches(fact_matches_a(spark, sf_dir), fact_matches_b(spark, sf_dir))
    return unified.withColumn("match_date", F.col("match_date").cast("timestamp_ntz"))


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table straight from the order lines, as the later jobs read it from storage."""
    written = F.when(F.col("source") == SOURCE_A, iso(F.col("match_date"), "+00:00")).otherwise(
        iso(F.col("match_date"), "Z")
    )
    return lines(spark, sf_dir).select(
        "match_id",
        written.alias("match_date_raw"),
        "match_date",
        "league",
        "season",
        "home_team_id",
        "home_team_name",
        logo(F.col("home_team_name")).alias("home_team_logo"),
        "away_team_id",
        "away_team_name",
        logo(F.col("away_team_name")).alias("away_team_logo"),
        "home_goals",
        "away_goals",
        "home_goals_halftime",
        "away_goals_halftime",
        "match_status",
        outcome_from_score(F.col("home_goals"), F.col("away_goals")).alias("result"),
        "source",
    )


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as players of their nation's club; the last order tells the last season."""
    last = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.max(F.year("o_orderdate")).alias("last_season"))
    )
    nation = table(spark, sf_dir, "nation")
    customer = table(spark, sf_dir, "customer")
    joined = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        last, F.col("c_custkey") == F.col("o_custkey"), "left"
    )
    balance = F.col("c_acctbal")
    return joined.select(
        F.col("c_custkey").alias("player_id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("current_club_id"),
        F.col("n_name").alias("current_club_name"),
        F.when(balance >= 0, balance).alias("market_value_in_eur"),
        (balance + 1000).alias("highest_market_value_in_eur"),
        "last_season",
    )


def squad_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return team_values(players(spark, sf_dir), min_season=FIRST_VALUED_SEASON)


def club_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The club and its value of every team, league, season and vendor."""
    roles = stack_roles(lines(spark, sf_dir), ["league", "season", "source"], ["team_id", "team_name"])
    values = squad_values(spark, sf_dir).drop("avg_highest_market_value_eur")
    teams = roles.distinct()
    return teams.join(values, F.col("team_id") == F.col("current_club_id")).select(
        *teams.columns,
        F.col("current_club_id").alias("transfermarkt_club_id"),
        F.col("current_club_name").alias("transfermarkt_club_name"),
        "squad_market_value_eur",
        "avg_player_market_value_eur",
        "players_count",
    )


def standings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank, points and goal difference of every team, league, season and vendor."""
    columns = ("team_id", "league", "season", "source", "rank", "points", "goal_difference")
    return records(lines(spark, sf_dir)).select(*columns)


def named_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts and customers as teams; the part's type decides how its name is written."""
    name = F.col("p_name")
    kind = F.col("p_type")
    written = (
        F.when(kind == "ECONOMY", name)
        .when(kind == "LARGE", F.concat(F.lit("Club "), name, F.lit(" F.C.")))
        .when(kind == "PROMO", F.concat(name, F.lit(" "), F.col("p_brand")))
        .when(kind == "SMALL", F.split_part(name, F.lit(" "), F.lit(2)))
        .when(kind == "MEDIUM", F.concat(F.lit("FC "), name, F.lit(" Calcio")))
        .otherwise(F.reverse(name))
    )
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("team_id"),
        written.alias("team_name"),
        F.lower(kind).alias("league"),
        F.lit("parts").alias("source"),
    )
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("team_id"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("team_name"),
        F.lower("c_mktsegment").alias("league"),
        F.lit("customers").alias("source"),
    )
    return parts.unionByName(customers).withColumns(
        {"season": F.lit(2025), "team_name_normalized": name_key(F.col("team_name"))}
    )


def named_clubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names and suppliers as clubs, in the shape of the squad values."""
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("player_id"),
        F.col("p_name").alias("current_club_name"),
        F.col("p_retailprice").alias("market_value_in_eur"),
    )
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("player_id"),
        F.col("s_name").alias("current_club_name"),
        F.col("s_acctbal").alias("market_value_in_eur"),
    )
    ids = part.groupBy("current_club_name").agg(F.min("player_id").alias("current_club_id"))
    squads = part.join(ids, "current_club_name").unionByName(
        supplier.withColumn("current_club_id", F.col("player_id") + 1_000_000_000)
    )
    return team_values(
        squads.withColumns(
            {"highest_market_value_in_eur": F.col("market_value_in_eur"), "last_season": F.lit(2025)}
        )
    )


def overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reversed names are sent to the club they spell; the others are marked to be skipped."""
    kind, name = F.col("p_type"), F.col("p_name")
    return (
        table(spark, sf_dir, "part")
        .filter(kind.isin("STANDARD", "LARGE"))
        .select(
            F.lower(kind).alias("league"),
            F.when(kind == "STANDARD", F.reverse(name))
            .otherwise(F.concat(F.lit("Club "), name, F.lit(" F.C.")))
            .alias("team_name"),
            name.alias("transfermarkt_club_name"),
            F.when(kind == "STANDARD", "fix").otherwise("skip").alias("action"),
        )
        .distinct()
    )
