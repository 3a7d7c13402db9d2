import pytest
from pyspark.sql import functions as F

from matchlake import operators
from matchlake.operators.enrich import TRAINING_COLUMNS
from matchlake.plans import tables

PLAYERS = (
    "player_id int, current_club_id int, current_club_name string, market_value_in_eur double, "
    "highest_market_value_in_eur double, last_season int"
)
MATCHES = (
    "match_id bigint, match_date_raw string, match_date string, league string, season int, "
    "home_team_id bigint, home_team_name string, away_team_id bigint, away_team_name string, "
    "home_goals bigint, away_goals bigint, result string, source string"
)
LINKS = (
    "team_id bigint, league string, season int, source string, transfermarkt_club_id int, "
    "transfermarkt_club_name string, squad_market_value_eur double, avg_player_market_value_eur double, "
    "players_count bigint"
)
STANDINGS = "team_id bigint, league string, season int, source string, rank int, points int, goal_difference int"


def match(match_id, home, away, home_goals=1, away_goals=0, result="HOME_WIN", source="a", season=2024):
    return (
        match_id, "d", "d", "x", season, home, f"t{home}", away, f"t{away}", home_goals, away_goals, result, source
    )


def link(team, value, source="a", season=2024, club=None):
    return (team, "x", season, source, club or team, f"c{team}", value, value / 2, 20)


def test_team_values_skip_missing_values_and_old_seasons(frame, rows):
    players = frame(
        [
            (1, 7, "c", 10.0, 30.0, 2024),
            (2, 7, "c", 20.005, None, 2023),
            (3, 7, "c", None, 99.0, 2024),
            (4, 7, "c", 50.0, 50.0, 2022),
            (5, None, "d", 50.0, 50.0, 2024),
            (None, 7, "c", 0.0, 0.0, 2024),
        ],
        PLAYERS,
    )
    assert rows(operators.team_values(players)) == [(7, "c", 30.005, 10.0, 2, 15.0)]


def test_top_teams_breaks_ties_by_id(frame):
    values = frame([(2, "b", 5.0), (1, "a", 5.0), (3, "c", 9.0), (4, "d", None)],
                   "current_club_id int, current_club_name string, squad_market_value_eur double")
    assert [r[0] for r in operators.top_teams(values, 3).collect()] == [3, 1, 2]


def test_keep_one_is_deterministic_with_and_without_order(frame, rows):
    df = frame([(1, "b", 2), (1, "a", 3), (1, None, 1), (2, None, 4)], "k int, s string, n int").repartition(4)
    assert rows(operators.keep_one(df, ["k"])) == [(1, "a", 3), (2, None, 4)]
    assert rows(operators.keep_one(df, ["k"], [F.desc("n")])) == [(1, "a", 3), (2, None, 4)]
    assert rows(operators.keep_one(df.select("k"), ["k"])) == [(1,), (2,)]


def test_explode_drops_empty_and_null_arrays(frame, rows):
    df = frame([(1, []), (2, None), (3, [5])], "id int, xs array<int>")
    assert rows(operators.explode_rows(df, "xs", "x", [("id", "id")])) == [(3, 5)]
    wide = frame([(1, [4, 5, 6])], "id int, xs array<int>")
    assert rows(operators.explode_rows(wide, "xs", "x", where=F.col("x") > 4)) == [(5,), (6,)]


def test_flatten_names_columns_by_path(frame):
    df = frame([((1, ("n",)),)], "a struct<id:int,b:struct<c:string>>")
    flat = operators.flatten(df, "a.id   key\na.b.c  name")
    assert flat.columns == ["key", "name"] and tuple(flat.first()) == (1, "n")


def test_unify_aligns_types_and_keeps_duplicates(frame, rows):
    a = frame([(1, "x"), (1, "x")], "id int, name string")
    b = frame([(1,)], "id bigint")
    both = operators.unify({"a": a, "b": b}, {"id": "bigint", "name": "string"})
    assert dict(both.dtypes) == {"id": "bigint", "name": "string", "source": "string"}
    assert rows(both) == [(1, "x", "a"), (1, "x", "a"), (1, None, "b")]
    assert operators.unify({"a": a, "b": b}, {"id": "bigint", "name": "string"}, ["id", "source"]).count() == 2


def test_enrichment_keeps_vendors_apart_unless_asked(frame):
    matches = frame([match(1, 1, 2), match(2, 1, 2, source="b"), match(3, None, 9)], MATCHES)
    links = frame([link(1, 10.0), link(2, 4.0), link(1, 99.0, source="b")], LINKS)
    values = ("match_id", "home_squad_market_value_eur", "away_squad_market_value_eur", "market_value_diff_eur")
    apart = operators.enrich(matches, links).select(*values).orderBy("match_id")
    assert [tuple(r) for r in apart.collect()] == [
        (1, 10.0, 4.0, 6.0),
        (2, 99.0, None, None),
        (3, None, None, None),
    ]
    crossed = operators.enrich(matches, links, compat=True)
    assert crossed.count() == 5
    assert crossed.filter("match_id = 2").agg(F.max("market_value_diff_eur")).first()[0] == 95.0


def test_enrichment_takes_the_latest_season_and_keeps_the_number_of_matches(frame):
    matches = frame([match(1, 1, 2)], MATCHES)
    links = frame([link(1, 10.0, season=2023), link(1, 30.0, season=2025), link(1, 20.0, season=2025)], LINKS)
    enriched = operators.enrich(matches, links)
    assert [r.home_squad_market_value_eur for r in enriched.collect()] == [20.0]
    assert enriched.columns[: len(matches.columns)] == matches.columns


def test_training_sets_cover_every_match_once(frame):
    decided = [
        match(1, 1, 2, 2, 1, "HOME_WIN"),
        match(2, 1, 2, 1, 1, "DRAW"),
        match(3, 1, 2, 0, 1, "AWAY_WIN"),
        match(4, 1, 2, None, None, "UNKNOWN"),
        match(5, 1, 2, 1, 0, "UNKNOWN"),
        match(6, 1, 2, 1, None, "UNKNOWN"),
        match(7, 1, 2, 1, 0, None),
        match(8, 1, 2, None, 3, "HOME_WIN"),
    ]
    enriched = operators.enrich(frame(decided, MATCHES), frame([link(1, 10.0)], LINKS))
    table = frame([(1, "x", 2024, "a", 1, 9, 3), (1, "x", 2023, "a", 5, 1, 0)], STANDINGS)
    training, future, undecided = operators.training_sets(enriched, table)
    assert training.columns == [*TRAINING_COLUMNS, "target"]
    assert [(r.match_id, r.target, r.home_rank, r.away_rank) for r in training.orderBy("match_id").collect()] == [
        (1, 0, 1, None),
        (2, 1, 1, None),
        (3, 2, 1, None),
    ]
    assert sorted(r.match_id for r in future.collect()) == [4, 8]
    assert sorted(r.match_id for r in undecided.collect()) == [5, 6, 7]


def test_roles_rename_and_stack(frame, rows):
    df = frame([(1, "x")], "team_id int, league string")
    assert operators.as_role(df, "home", ["team_id"]).columns == ["home_team_id", "league"]
    both = frame([(5, 1, 2)], "m int, home_id int, away_id int")
    assert rows(operators.stack_roles(both, ["m"], ["id"])) == [(5, 1), (5, 2)]


def test_latest_stats_need_every_figure(frame, rows):
    columns = (
        "league string, season int, source string, "
        + ", ".join(
            f"{r}_team_id int, {r}_team_name string, {r}_squad_market_value_eur double, "
            f"{r}_avg_player_market_value_eur double, {r}_players_count int, {r}_rank int, {r}_points int, "
            f"{r}_goal_diff int"
            for r in ("home", "away")
        )
    )
    old, new = (1, "one", 5.0, 1.0, 20, 3, 30, 1), (1, "one", 6.0, 1.0, 20, 2, 40, 9)
    partial = (2, "two", None, 1.0, 20, 2, 40, 9)
    df = frame([("x", 2023, "a", *old, *partial), ("x", 2024, "a", *partial, *new)], columns)
    logos = frame([("two", "l")], "team_name string, logo_url string")
    assert rows(operators.latest_team_stats(df, logos)) == [("x", "a", *new, "")]
    assert rows(operators.latest_team_stats(df, logos, ("team_id", "league"))) == [("x", *new, "")]


def test_vendors_share_team_ids(frame, rows):
    sides = ("home", "away")
    figures = [f"{r}_{c}" for r in sides for c in operators.stats.STAT_COLUMNS]
    one, two = (1, "Alpha", 1.0, 1.0, 1, 1, 1, 1), (1, "Gamma", 2.0, 1.0, 1, 1, 1, 1)
    kinds = {"team_name": "string", "squad_market_value_eur": "double", "avg_player_market_value_eur": "double"}
    schema = "league string, season int, source string, " + ", ".join(f"{c} {kinds.get(c.split('_', 1)[1], 'int')}" for c in figures)
    df = frame([("x", 2024, "a", *one, *one), ("x", 2024, "b", *two, *two)], schema)
    logos = frame([], "team_name string, logo_url string")
    assert [r[:4] for r in rows(operators.latest_team_stats(df, logos))] == [("x", "a", 1, "Alpha"), ("x", "b", 1, "Gamma")]


def test_logo_is_the_smallest_seen(frame, rows):
    df = frame([("a", "z", "b", None), ("b", "q", "a", "y")],
               "home_team_name string, home_team_logo string, away_team_name string, away_team_logo string")
    assert rows(operators.logo_per_team(df)) == [("a", "y"), ("b", "q")]


def test_search_is_literal_and_ignores_case(frame):
    teams = frame([("AC 100%", "x"), ("Ac Milan", "x"), ("Roma", "w")], "team_name string, league string")
    assert [r[0] for r in operators.search_teams(teams, "ac").collect()] == ["AC 100%", "Ac Milan"]
    assert [r[0] for r in operators.search_teams(teams, "%").collect()] == ["AC 100%"]
    assert [r[0] for r in operators.search_teams(teams, by_league=True, limit=1).collect()] == ["Roma"]


@pytest.mark.parametrize(
    ("asked", "found"),
    [
        ({}, [1, 2, 3]),
        ({"league": "x"}, [1, 2]),
        ({"team": "ROM"}, [1, 3]),
        ({"team": "rom", "forecast": "Empate"}, [3]),
        ({"league": "x", "team": "zzz"}, []),
    ],
)
def test_prediction_filters_combine(frame, asked, found):
    df = frame(
        [(1, "2024-08-17 14:00:00", "x", "Roma", "B", "Gana Local"), (2, None, "x", "C", "D", "Empate"),
         (3, "2024-08-18 14:00:00", "w", "E", "Roma", "Empate")],
        "id int, fecha string, liga string, local string, visitante string, pronostico string",
    )
    kept = operators.filter_predictions(df, **asked).orderBy("id").collect()
    assert [r.id for r in kept] == found
    assert all(r.dia == (r.fecha or "").split(" ")[0] for r in kept)


def test_quality_reports(spark, frame, rows):
    df = frame([(1, "x"), (1, None), (2, "y")], "k int, v string")
    assert rows(operators.row_counts(df, "k")) == [(1, 2), (2, 1)]
    assert rows(operators.row_counts(df)) == [(3,)]
    assert rows(operators.nonnull_counts(df, ["k", "v"])) == [(3, 2)]
    assert rows(operators.duplicate_keys(df, ["k"])) == [(1, 2)]
    report = operators.profile(spark, {"good": lambda: df, "bad": lambda: spark.read.parquet("/no/such/path")})
    assert rows(report) == [("bad", "failed", None, None, "PATH_NOT_FOUND"), ("good", "ok", 3, "k,v", None)]


def test_profile_goes_on_when_a_source_fails_while_it_is_read(spark):
    broken = spark.range(5).selectExpr("IF(id = 3, raise_error('bad row'), id) AS id").where("id >= 0")
    report = operators.profile(spark, {"good": lambda: spark.range(7), "broken": lambda: broken})
    assert [(r.dataset, r.status, r.rows) for r in report.collect()] == [("good", "ok", 7), ("broken", "failed", None)]


def test_groupings_tell_null_keys_from_left_out_ones(frame, rows):
    df = frame([("a", 1), ("a", None), (None, 1)], "k string, n int")
    got = operators.grouped_counts(df, [[], ["k"], ["k", "n"]])
    assert got._jdf.queryExecution().executedPlan().toString().count("Scan") == 1
    expected = [("all", None, None, 3), ("k", "a", None, 2), ("k", None, None, 1)]
    expected += [("k,n", "a", 1, 1), ("k,n", "a", None, 1), ("k,n", None, 1, 1)]
    assert rows(got) == sorted(expected, key=repr)


def test_logos_are_made_distinct_before_anything_is_sorted(frame, rows, capsys):
    df = frame([("a", f"l{n % 3}", "b", "x") for n in range(300)], "home_team_name string, home_team_logo string, away_team_name string, away_team_logo string")
    logos = operators.logo_per_team(df)
    assert rows(logos) == [("a", "l0"), ("b", "x")]
    logos.explain()
    plan = capsys.readouterr().out
    below_sorts = plan[plan.rindex("Sort ") :]
    assert "SortAggregate" not in plan and "HashAggregate" in below_sorts


def test_wide_team_rows_are_dealt_out_evenly_before_they_are_sorted(frame, capsys):
    team = "struct<id:bigint,name:string,code:string,country:string,founded:bigint,logo:string,national:boolean>"
    venue = "struct<id:bigint,name:string,city:string,address:string,capacity:bigint,surface:string,image:string>"
    teams = [((n % 2, f"t{n}", "c", "x", 1, "l", False), (n, "v", "c", "a", 1, "s", "i"), "asia", 2024) for n in range(40)]
    unique = tables.dim_teams_a(frame(teams, f"team {team}, venue {venue}, league string, season int"))
    assert sorted((r.team_id, r.team_name) for r in unique.collect()) == [(0, "t0"), (1, "t1")]
    unique.explain()
    plan = capsys.readouterr().out
    assert "REBALANCE" in plan[plan.rindex("Sort ") :]
