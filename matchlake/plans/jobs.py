"""Runnable jobs: read named datasets, build a table, write it under its name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake import ml
from matchlake.catalog import DATASETS, model_path
from matchlake.operators import (
    enrich,
    latest_team_stats,
    logo_per_team,
    name_candidates,
    profile,
    resolve_teams,
    row_counts,
    team_profiles,
    split_matches,
    team_values,
    with_standings,
)
from matchlake.plans import tables
from matchlake.sources import counted, intermediate, read_dataset, require_rows, rows_frame, slice_by_league, write_dataset

Job = Callable[..., dict[str, DataFrame]]


def _builds(target: str, build: Callable[..., DataFrame], *inputs: str) -> Job:
    """A job that builds one dataset from others; extra arguments go to ``build``."""

    def job(spark: SparkSession, base: str, **options) -> dict[str, DataFrame]:
        return {target: build(*(read_dataset(spark, name, base) for name in inputs), **options)}

    job.__doc__ = f"{target} from {', '.join(inputs)}"
    return job


def training_job(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """training_dataset and future_dataset from the enriched matches and both standings, joined once."""
    enriched = read_dataset(spark, "enriched_fact_matches", base)
    training, future, _ = split_matches(intermediate(with_standings(enriched, _standings(spark, base)), "training"))
    return {"training_dataset": training, "future_dataset": future}


def _standings(spark: SparkSession, base: str) -> DataFrame:
    return tables.standings(
        read_dataset(spark, "fact_standings_a", base), read_dataset(spark, "fact_standings_b", base)
    )


def slices_job(spark: SparkSession, base: str, dumps: str) -> dict[str, DataFrame]:
    """League slices of the registry's full dumps ``<dumps>/{clubs,players,player_valuations}.csv.gz``."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))  # a gzip file is read by one
    full = {
        name: spark.read.option("header", True).csv(f"{dumps.rstrip('/')}/{name}.csv.gz").repartition(tasks)
        for name in ("clubs", "players", "player_valuations")
    }
    sliced = slice_by_league(full["clubs"], full["players"], full["player_valuations"])
    names = {"clubs": "raw_clubs_c", "players": "raw_players_c", "player_valuations": "raw_valuations_c"}
    return {names[name]: df for name, df in sliced.items()}


def model_job(spark: SparkSession, base: str, tasks: int | None = None) -> dict[str, DataFrame]:
    """Fit, evaluate and save the forest, then predict the matches to come.

    ``model_fit`` records the rows and the tasks of the fit; with its ``tasks`` the same rows
    give the same forest, whatever the defaults are by then.
    """
    training, test = ml.split(ml.feature_rows(read_dataset(spark, "training_dataset", base), target=ml.forest.TARGET))
    rows = training.count()
    tasks = tasks or ml.fit_tasks(rows)
    model = ml.fit_forest(training, tasks=tasks)
    ml.save_model(model, model_path(base))
    ml.evaluate(model.transform(test)).show()
    ml.importances(spark, model).show(truncate=False)
    fit = rows_frame(spark, [{"rows": rows, "tasks": tasks}], "rows bigint, tasks int")
    return {"predictions": ml.score(model, read_dataset(spark, "future_dataset", base)), "model_fit": fit}


def stats_job(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """Latest figures per team, and a snapshot of the training dataset."""
    training = require_rows(read_dataset(spark, "training_dataset", base), "training_dataset")
    logos = logo_per_team(read_dataset(spark, "fact_matches", base))
    return {"training_snapshot": training, "team_stats": latest_team_stats(training, logos)}


JOBS: dict[str, Job] = {
    "slices": slices_job,
    "fact_matches_a": _builds("fact_matches_a", tables.fact_matches_a, "raw_fixtures_a"),
    "fact_matches_b": _builds("fact_matches_b", tables.fact_matches_b, "raw_matches_b"),
    "dim_teams_a": _builds("dim_teams_a", tables.dim_teams_a, "raw_teams_a"),
    "dim_teams_b": _builds("dim_teams_b", tables.dim_teams_b, "raw_teams_b"),
    "fact_standings_a": _builds("fact_standings_a", tables.fact_standings_a, "raw_standings_a"),
    "fact_standings_b": _builds("fact_standings_b", tables.fact_standings_b, "raw_standings_b"),
    "dim_clubs": _builds("dim_clubs", tables.dim_clubs, "raw_clubs_c"),
    "team_market_values": _builds("team_market_values", team_values, "raw_players_c"),
    "fact_matches": _builds("fact_matches", tables.fact_matches, "fact_matches_a", "fact_matches_b"),
    "dim_teams": _builds("dim_teams", tables.dim_teams, "dim_teams_a", "dim_teams_b"),
    "candidates": _builds("team_matching_candidates", name_candidates, "dim_teams", "team_market_values"),
    "resolve": _builds("team_club_matches", resolve_teams, "dim_teams", "team_market_values", "team_overrides"),
    "enrich": _builds("enriched_fact_matches", enrich, "fact_matches", "team_club_matches"),
    "training": training_job,
    "model": model_job,
    "team_stats": stats_job,
}


def run_job(spark: SparkSession, name: str, base: str, overwrite: str = "static", **options) -> dict[str, str]:
    """Run one job and write its datasets; returns their paths by name."""
    built = JOBS[name](spark, base, **options)
    return {target: write_dataset(df, target, base, overwrite) for target, df in built.items()}


def run_job_counted(spark: SparkSession, name: str, base: str, overwrite: str = "static", **options) -> DataFrame:
    """Run one job like ``run_job``; returns rows and non-nulls by column of what it wrote.

    The counts are taken while the tables are written, without another scan.
    """
    report = []
    for target, df in JOBS[name](spark, base, **options).items():
        df, observation = counted(df)
        write_dataset(df, target, base, overwrite)
        found = observation.get
        report.append((target, found["rows"], {c: found[f"nonnull.{c}"] for c in df.columns}))
    return spark.createDataFrame(report, "dataset string, rows bigint, nonnull map<string,bigint>")


def profile_sources(spark: SparkSession, base: str, prefix: str = "raw_") -> DataFrame:
    """Profile of every dataset whose name starts with ``prefix``."""
    names = [name for name in DATASETS if name.startswith(prefix)]
    return profile(spark, {name: lambda name=name: read_dataset(spark, name, base) for name in names})


def count_by_partition(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Rows of a dataset per league and season, as far as it is laid out by them."""
    keys = DATASETS[name].partition_by
    return row_counts(read_dataset(spark, name, base), *keys).orderBy(*keys)


def predict_pairing(
    spark: SparkSession, base: str, pairings: DataFrame, lookup: str = "search", null_fill: float | None = None
) -> DataFrame:
    """Score pairings with the saved model and the latest figures of every resolved team."""
    profiles = team_profiles(read_dataset(spark, "team_club_matches", base), _standings(spark, base))
    model = ml.load_model(model_path(base))
    return ml.score_pairings(pairings, profiles, model, lookup, null_fill)


def list_teams(spark: SparkSession, base: str, limit: int = 100) -> DataFrame:
    """Resolved teams by league and name, to choose pairings from."""
    teams = read_dataset(spark, "team_club_matches", base)
    return teams.select("team_name", "league", "season").orderBy("league", "team_name", F.desc("season")).limit(limit)
