"""All jobs in order on a small league, from raw files to predictions."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from matchlake.catalog import DATASETS, dataset_path
from matchlake.plans.jobs import count_by_partition, list_teams, predict_pairing, profile_sources, run_job, run_job_counted
from matchlake.sources import published, read_dataset, rows_frame

NAMES = ["Alpha FC", "Beta Club", "Gamma", "Delta United", "Epsilon 04", "Zeta SA"]


def put(base, path, value):
    target = base / path
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text(json.dumps(value), encoding="utf-8")


def fixture(i, home, away, goals):
    side = lambda t: {"id": t, "name": NAMES[t], "logo": f"{t}.png", "winner": None}
    scored = {"home": goals[0], "away": goals[1]}
    return {
        "fixture": {
            "id": i, "date": "2025-03-01T15:00:00+00:00", "timestamp": 1, "timezone": "UTC", "referee": None,
            "venue": {"id": 1, "name": "v", "city": "c"}, "status": {"long": "l", "short": "s", "elapsed": 90},
        },
        "teams": {"home": side(home), "away": side(away)}, "goals": scored,
        "score": {"halftime": scored, "fulltime": scored},
    }


def document(i, home, away, goals):
    side = lambda t: {"id": 100 + t, "name": NAMES[t], "shortName": "s", "tla": "t", "crest": "u"}
    winner = None if goals[0] is None else "HOME_TEAM" if goals[0] > goals[1] else "AWAY_TEAM" if goals[0] < goals[1] else "DRAW"
    scored = {"home": goals[0], "away": goals[1]}
    return {
        "id": i, "utcDate": "2025-03-01T15:00:00Z", "matchday": 1, "stage": "R", "status": "FINISHED",
        "season": {"startDate": "2025-01-01", "endDate": "2025-12-01"}, "homeTeam": side(home),
        "awayTeam": side(away), "score": {"winner": winner, "fullTime": scored, "halfTime": scored},
    }


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("lake")
    games = [(h, a) for h in range(6) for a in range(6) if h != a]
    goals = lambda h, a: (None, None) if (h, a) == (0, 5) else (max(0, a - h), max(0, h - a))
    day = "league=premier_league/season=2025/2025-03-01.json"
    put(base, f"raw/api_football/fixtures/{day}", [fixture(i, h, a, goals(h, a)) for i, (h, a) in enumerate(games)])
    team = lambda t: {"team": {"id": t, "name": NAMES[t], "code": "C"}, "venue": {"id": 1, "capacity": 5}}
    put(base, f"raw/api_football/teams/{day}", [team(t) for t in (*range(6), 0)])
    record = {"played": 1, "win": 1, "draw": 0, "lose": 0, "goals": {"for": 1, "against": 0}}
    row = lambda t: {"team": {"id": t, "name": NAMES[t]}, "rank": t + 1, "points": 30 - t, "goalsDiff": -t, "all": record}
    put(base, f"raw/api_football/standings/{day}", [row(t) for t in range(6)])

    head = {"competition": {"code": "PL", "name": "Premier"}, "season": {"startDate": "2025-01-01"}}
    put(base, "raw/football_data_org/matches/2025/a.json", {**head, "matches": [document(i, h, a, goals(h, a)) for i, (h, a) in enumerate(games)]})
    put(base, "raw/football_data_org/matches/2025/b.json", {**head, "matches": []})
    put(base, "raw/football_data_org/teams/a.json", {**head, "teams": [{"id": 100 + t, "name": NAMES[t]} for t in range(6)]})
    table = [{"position": t + 1, "team": {"id": 100 + t}, "points": 30 - t, "goalDifference": -t} for t in range(6)]
    put(base, "raw/football_data_org/standings/a.json", {**head, "standings": [{"type": "TOTAL", "table": table}, {"type": "HOME", "table": table}]})

    dumps = base / "dumps"
    dumps.mkdir()

    def dump(name, lines):
        with gzip.open(dumps / f"{name}.csv.gz", "wt") as out:
            out.write("\n".join(lines) + "\n")

    dump("clubs", ["club_id,name,domestic_competition_id", *(f"{t},{n} Football Club,GB1" for t, n in enumerate(NAMES)), "77,Elsewhere,ZZ"])
    players = [f"{10 * t + p},p,{t},{n} Football Club,{1000 - 100 * t},2000,2025" for t, n in enumerate(NAMES) for p in range(3)]
    dump("players", ["player_id,name,current_club_id,current_club_name,market_value_in_eur,highest_market_value_in_eur,last_season", *players])
    dump("player_valuations", ["player_id,date,market_value_in_eur", "0,2024-01-01,5", "999,2024-01-01,5"])
    overrides = base / DATASETS["team_overrides"].path
    overrides.parent.mkdir(parents=True)
    overrides.write_text("league,team_name,transfermarkt_club_name,action\npremier_league,Gamma,Epsilon 04 Football Club,fix\n")

    root = str(base)
    run_job(spark, "slices", root, dumps=str(dumps))
    for job in (
        "fact_matches_a", "fact_matches_b", "dim_teams_a", "dim_teams_b", "fact_standings_a", "fact_standings_b",
        "dim_clubs", "team_market_values", "fact_matches", "dim_teams",
    ):
        run_job(spark, job, root)
    run_job(spark, "candidates", root, season=2025, max_distance=4)
    run_job(spark, "resolve", root)
    for job in ("enrich", "training", "model", "team_stats"):
        run_job(spark, job, root)
    return root


def test_both_vendors_share_one_table(spark, base, rows):
    matches = read_dataset(spark, "fact_matches", base)
    counts = matches.groupBy("source", "league", "season", "result").count()
    per = {("HOME_WIN", 14), ("AWAY_WIN", 15), ("UNKNOWN", 1)}
    assert {(r.source, r.result, r["count"]) for r in counts.collect()} == {
        (s, *p) for s in ("api_football", "football_data_org") for p in per
    }
    assert rows(matches.select("league", "season").distinct()) == [("premier_league", 2025)]
    assert rows(count_by_partition(spark, base, "fact_matches")) == [("premier_league", 2025, 60)]


def test_dimensions_are_unique(spark, base):
    teams = read_dataset(spark, "dim_teams", base)
    assert teams.count() == 12
    assert {r.team_name_normalized for r in teams.collect()} == {n.lower() for n in NAMES}
    assert read_dataset(spark, "dim_clubs", base).count() == 6
    assert read_dataset(spark, "raw_valuations_c", base).count() == 1


def test_teams_are_resolved_and_overridden(spark, base, rows):
    found = read_dataset(spark, "team_club_matches", base)
    kinds = found.groupBy("match_type").count()
    assert rows(kinds) == [("exact", 10), ("manual", 2)]
    assert {r[0] for r in found.filter("team_name = 'Gamma'").select("transfermarkt_club_id").collect()} == {4}


def test_training_and_future_sets(spark, base):
    training = read_dataset(spark, "training_dataset", base)
    future = read_dataset(spark, "future_dataset", base)
    assert (training.count(), future.count()) == (58, 2)
    assert training.filter(F.col("market_value_diff_eur").isNull() | F.col("home_rank").isNull()).isEmpty()


def test_predictions_and_stats_are_published(spark, base):
    predictions = read_dataset(spark, "predictions", base).collect()
    assert len(predictions) == 2 and predictions[0].local == "Alpha FC" and predictions[0].pronostico
    stats = read_dataset(spark, "team_stats", base)
    assert stats.count() == 12
    assert {r.logo_url for r in stats.filter("team_name = 'Alpha FC'").collect()} == {"0.png"}
    assert read_dataset(spark, "training_snapshot", base).count() == 58


def test_saved_model_answers_pairings(spark, base):
    asked = rows_frame(spark, [{"home_team": "alpha", "away_team": "zeta"}], "home_team string, away_team string")
    (answer,) = predict_pairing(spark, base, asked).collect()
    assert (answer.status, answer.local, answer.visitante) == ("ok", "Alpha FC", "Zeta SA")
    assert [r.team_name for r in list_teams(spark, base, 2).collect()] == ["Alpha FC", "Alpha FC"]


def test_source_profile_reports_every_source(spark, base):
    report = {r.dataset: r for r in profile_sources(spark, base).collect()}
    assert {r.status for r in report.values()} == {"ok"} and len(report) == 9
    assert report["raw_fixtures_a"].rows == 30


def test_every_dataset_has_its_own_path(base):
    paths = [dataset_path(base, name) for name in DATASETS]
    assert len(set(paths)) == len(paths)


def test_published_jobs_report_what_they_wrote(spark, base):
    first = run_job_counted(spark, "dim_clubs", base, overwrite="publish").collect()
    assert [(r.dataset, r.rows, r.nonnull["club_name"]) for r in first] == [("dim_clubs", 6, 6)]
    assert published(spark, dataset_path(base, "dim_clubs")) != dataset_path(base, "dim_clubs")
    assert read_dataset(spark, "dim_clubs", base).count() == 6


def test_the_fit_is_recorded(spark, base):
    assert [r["tasks"] for r in read_dataset(spark, "model_fit", base).collect()] == [16]
