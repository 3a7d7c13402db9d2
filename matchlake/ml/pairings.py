"""Forecasts for pairings a user chose by team name."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.ml.forest import FEATURES
from matchlake.ml.scoring import PERCENTAGES, with_forecast
from matchlake.operators.containment import best_holder
from matchlake.operators.dedupe import keep_one
from matchlake.operators.roles import ROLES

PROFILE = ("squad_market_value_eur", "avg_player_market_value_eur", "players_count", "rank", "points", "goal_diff")
ASKED = ("home_team", "away_team")


def _preference(stats: DataFrame) -> list[Column]:
    """Latest season first where there is one, then a total order over equal names."""
    latest = [F.col("season").desc_nulls_last()] if "season" in stats.columns else []
    ties = [F.col(c).asc_nulls_last() for c in ("league", "source", "team_id") if c in stats.columns]
    return [*latest, F.length("team_name").asc_nulls_last(), F.col("team_name").asc_nulls_last(), *ties]


def find_teams(names: DataFrame, stats: DataFrame, lookup: str = "search") -> DataFrame:
    """The team meant by each distinct ``asked`` text: ``asked`` and the columns of ``stats``.

    ``search`` takes the team whose name contains the text, ignoring case: of its
    latest season, an equal name before a longer one. ``exact`` takes the equal name.
    Texts without a team are absent. Where ``names`` has ``asked_league``, an exact
    lookup looks in that league alone, or in all where it is NULL.
    """
    by_league = "asked_league" in names.columns
    if by_league and lookup != "exact":
        raise ValueError("a league can be asked for in exact lookups only")
    keys = ["asked", "asked_league"] if by_league else ["asked"]
    asked = names.select(*keys).filter(F.lower("asked").isNotNull()).distinct()
    if lookup == "exact":
        found = asked.join(stats, F.col("asked") == F.col("team_name"))
        if by_league:
            found = found.filter(F.col("asked_league").isNull() | (F.col("asked_league") == F.col("league")))
        return keep_one(found, keys, _preference(stats))
    if lookup != "search":
        raise ValueError(f"unknown lookup {lookup!r}")
    lowered = asked.withColumn("_wanted", F.lower("asked"))
    named = stats.withColumn("_name", F.lower("team_name"))
    found = best_holder(lowered, "_wanted", named, "_name", _preference(stats), min_length=0)
    return found.drop("_wanted", "_name")


def score_pairings(
    pairings: DataFrame,
    stats: DataFrame,
    model: PipelineModel,
    lookup: str = "search",
    null_fill: float | None = None,
) -> DataFrame:
    """Forecast every (``home_team``, ``away_team``) row of ``pairings``.

    ``stats`` holds one row of ``PROFILE`` figures per team, as ``team_profiles`` and
    ``latest_team_stats`` give them. No pairing is dropped: ``status`` is ``ok`` or
    ``home_not_found``, ``away_not_found``, ``same_team`` (refused when looked up
    exactly), ``incomplete`` (a figure is missing and ``null_fill`` is not given), and
    only ``ok`` rows carry a forecast.
    ``cross_league`` tells that the teams play in different leagues, ``liga`` is the
    home team's. A column ``league`` of ``pairings`` says which league both names are
    looked up in, exactly; NULL means any.
    """
    leagues = ["league"] if "league" in pairings.columns else []
    texts = pairings.select(F.explode(F.array(*ASKED)).alias("asked"), *(F.col(c).alias("asked_league") for c in leagues))
    teams = find_teams(texts, stats, lookup).select(
        F.col("asked").alias("team"),
        *(F.col("asked_league") for _ in leagues),
        F.col("team_name").alias("found"),
        "league",
        "team_id",
        *(F.col(name).cast("double").alias(name) for name in PROFILE),
    )
    paired = _both_teams(pairings, teams, leagues)

    same = F.lit(lookup == "exact") & (F.col("home_team") == F.col("away_team"))
    if null_fill is not None:
        paired = paired.fillna(null_fill, [f"{role}_{name}" for role in ROLES for name in PROFILE])
    paired = paired.withColumn(
        "market_value_diff_eur", F.col("home_squad_market_value_eur") - F.col("away_squad_market_value_eur")
    )
    missing = F.lit(False)
    for feature in FEATURES:
        missing = missing | F.col(feature).isNull() | F.isnan(F.col(feature).cast("double"))
    status = (
        F.when(F.col("home_found").isNull(), "home_not_found")
        .when(F.col("away_found").isNull(), "away_not_found")
        .when(same, "same_team")
        .when(missing, "incomplete")
        .otherwise("ok")
    )
    judged = paired.withColumn("status", status).withColumn(
        "cross_league", F.col("home_league") != F.col("away_league")
    )
    # The assembler refuses NULL, so rows without a forecast go through it with zeros.
    scored = with_forecast(model, judged.fillna(0.0, list(FEATURES)))
    answered = F.col("status") == "ok"
    return scored.select(
        *pairings.columns,
        F.col("home_league").alias("liga"),
        F.col("away_league").alias("liga_visitante"),
        F.col("home_found").alias("local"),
        F.col("away_found").alias("visitante"),
        *(F.when(answered, F.col(name)).alias(name) for name in (*PERCENTAGES, "pronostico")),
        "status",
        "cross_league",
    )


def _both_teams(pairings: DataFrame, teams: DataFrame, leagues: list[str]) -> DataFrame:
    columns = ("found", "league", "team_id", *PROFILE)
    paired = pairings
    for role in ROLES:
        side = teams.select(
            F.col("team").alias("_team"),
            *(F.col("asked_league").alias("_league") for _ in leagues),
            *(F.col(name).alias(f"{role}_{name}") for name in columns),
        )
        same = F.col(f"{role}_team") == F.col("_team")
        for league in leagues:
            same = same & F.col(league).eqNullSafe(F.col("_league"))
        paired = paired.join(side, same, "left").drop("_team", "_league")
    return paired
