"""Name resolution against brute force over all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from matchlake import operators
from matchlake.functions import club_key, name_key
from matchlake.ml.pairings import find_teams
from matchlake.operators.candidates import meetings, near_names
from matchlake.operators.containment import best_holder

TEAMS = "team_id bigint, team_name string, league string, season int, source string"
VALUES = (
    "current_club_id int, current_club_name string, squad_market_value_eur double, "
    "avg_player_market_value_eur double, players_count bigint"
)
OVERRIDES = "league string, team_name string, transfermarkt_club_name string, action string"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            above, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, above + (x != y))
    return row[-1]


def edited(rng, word, edits, letters):
    word = list(word)
    for _ in range(edits):
        at = rng.randint(0, len(word))
        kind = rng.choice("ids")
        if kind == "i":
            word.insert(at, rng.choice(letters))
        elif at < len(word):
            word[at : at + 1] = [] if kind == "d" else [rng.choice(letters)]
    return "".join(word)


@pytest.fixture(scope="module")
def teams(frame):
    def build(rows):
        named = frame(rows, TEAMS)
        return named.withColumn("team_name_normalized", name_key(F.col("team_name")))

    return build


@pytest.mark.parametrize("k", [0, 1, 2, 4, 12])
def test_near_names_equal_all_pairs(frame, k):
    rng = random.Random(k)
    letters = "ab c"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 24))) for _ in range(30)]
    left = {edited(rng, w, rng.randint(0, k + 2), letters) for w in base}
    right = {edited(rng, w, rng.randint(0, k + 2), letters) for w in base} | {"", "a"}
    got = near_names(
        frame([(w,) for w in left], "name string"), frame([(w,) for w in right], "name string"), k
    ).collect()
    expected = {(a, b, distance(a, b)) for a in left for b in right if distance(a, b) <= k}
    assert len(got) == len(expected) and {tuple(r) for r in got} == expected


@pytest.mark.parametrize("k", [1, 2, 4, 7])
def test_names_with_a_common_segment_equal_all_pairs(frame, k):
    rng = random.Random(100 + k)
    letters = "ab "
    base = ["sporting " + "".join(rng.choice(letters) for _ in range(rng.randint(0, 12))) for _ in range(25)]
    left = {edited(rng, w, rng.randint(0, k + 1), letters) for w in base}
    right = {edited(rng, w, rng.randint(0, k + 1), letters) for w in base} | {"", "ab"}
    got = near_names(
        frame([(w,) for w in left], "name string"), frame([(w,) for w in right], "name string"), k
    ).collect()
    assert {tuple(r) for r in got} == {(a, b, distance(a, b)) for a in left for b in right if distance(a, b) <= k}


def test_a_word_that_all_names_share_is_none_they_meet_on(frame):
    rng = random.Random(7)
    letters = "abcdefghijklmnopqrstuvwxyz"
    base = ["".join(rng.choices(letters, k=9)) + " " + "".join(rng.choices(letters, k=7)) for _ in range(2500)]
    left, right = ({edited(rng, w, rng.randint(0, 1), letters) + " united" for w in base} for _ in range(2))
    left, right = (frame([(w,) for w in names], "name string") for names in (left, right))
    found = near_names(left, right, 2).count()
    assert found >= 2400 and meetings(left, right, 2).count() <= 5 * found
    assert meetings(left, right, 2, spare=0).count() > 50 * found


def test_hot_signatures_lose_no_pairs(frame):
    words = [f"club {chr(97 + i)}{chr(97 + j)}" for i in range(6) for j in range(6)]
    names = frame([(w,) for w in words], "name string")
    got = {tuple(r)[:2] for r in near_names(names, names, 1).collect()}
    assert got == {(a, b) for a in words for b in words if distance(a, b) <= 1}


def test_candidates_repeat_for_every_team_of_a_name(teams, frame, rows):
    current = teams([(1, "Roma", "x", 2025, "a"), (2, "ROMA", "y", 2025, "a"), (3, "Roma", "x", 2024, "a"), (4, None, "x", 2025, "a")])
    values = frame([(7, "Romo", 5.0, 1.0, 3), (8, "Milan", 9.0, 1.0, 3)], VALUES)
    found = operators.name_candidates(current, values, max_distance=1, season=2025)
    assert rows(found.select("team_id", "transfermarkt_club_id", "name_distance")) == [(1, 7, 1), (2, 7, 1)]


def test_priority_of_kinds_and_values(teams, frame, rows):
    current = teams(
        [
            (1, "Arsenal FC", "x", 2025, "a"),
            (2, "Real Madrid CF", "x", 2025, "a"),
            (3, "Inter Milano Calcio", "x", 2025, "a"),
            (4, "Nobody", "x", 2025, "a"),
            (5, "FC", "x", 2025, "a"),
            (6, None, "x", 2025, "a"),
            (7, "United", "x", 2025, "a"),
        ]
    )
    values = frame(
        [
            (10, "Arsenal Football Club", 1.0, 1.0, 1),
            (11, "Arsenal Women", 50.0, 1.0, 1),
            (12, "Real Madrid Club de Fútbol", 3.0, 1.0, 1),
            (13, "Real Madrid Castilla", 2.0, 1.0, 1),
            (14, "Inter", 8.0, 1.0, 1),
            (15, "Milano", 8.0, 1.0, 1),
            (16, "FC", 99.0, 1.0, 1),
            (17, "West United", None, 1.0, 1),
            (18, "East United", None, 1.0, 1),
        ],
        VALUES,
    )
    best = operators.automatic_matches(current, values)
    assert rows(best.select("team_id", "transfermarkt_club_id", "match_type")) == [
        (1, 10, "exact"),
        (2, 12, "contains_transfermarkt"),
        (3, 14, "contains_team"),
        (7, 17, "contains_transfermarkt"),
    ]


def test_automatic_matches_equal_all_pairs(teams, frame):
    rng = random.Random(5)
    words = ["real", "inter", "union", "fc", "club", "sa", "ab", "rea", "al", "realreal"]
    names = lambda n: [" ".join(rng.choice(words) for _ in range(rng.randint(1, 3))) for _ in range(n)]
    current = teams([(i, n, "x", 2025, "a") for i, n in enumerate(names(60))])
    values = frame([(i, n, float(rng.randint(1, 5)), 1.0, 1) for i, n in enumerate(names(40))], VALUES)
    got = operators.automatic_matches(current, values).select("team_id", "transfermarkt_club_id", "match_type")

    keyed = current.select("team_id", club_key(F.col("team_name")).alias("t")).collect()
    clubs = values.select("current_club_id", "squad_market_value_eur", club_key(F.col("current_club_name")).alias("c")).collect()
    expected = []
    for team in keyed:
        ranked = []
        for club in clubs:
            if len(team.t) < 4 or len(club.c) < 4:
                continue
            kind = (1, "exact") if team.t == club.c else (2, "contains_transfermarkt") if team.t in club.c else (3, "contains_team") if club.c in team.t else None
            if kind:
                ranked.append((kind[0], -club.squad_market_value_eur, club.current_club_id, kind[1]))
        if ranked:
            best = min(ranked)
            expected.append((team.team_id, best[2], best[3]))
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected)


def test_manual_rows_replace_automatic_ones(teams, frame, rows):
    current = teams([(1, "AC Milan", "s", 2025, "a"), (2, "AS Roma", "s", 2025, "a"), (3, "Milan", "s", 2025, "a")])
    values = frame(
        [
            (10, "Associazione Calcio Milan", 5.0, 1.0, 1),
            (11, "Milan", 9.0, 1.0, 1),
            (12, "Associazione Milan", 7.0, 1.0, 1),
            (13, "Roma Nord", 1.0, 1.0, 1),
        ],
        VALUES,
    )
    fixes = frame(
        [("s", "AC Milan", "Associazione Calcio Milan", "fix"), ("s", "AS Roma", "Roma Nord", "skip")], OVERRIDES
    )
    final = operators.resolve_teams(current, values, fixes, season=2025)
    assert rows(final.select("team_id", "transfermarkt_club_id", "match_type")) == [
        (1, 12, "manual"),
        (3, 11, "exact"),
    ]
    every = operators.manual_matches(current, values, fixes, unique=False)
    assert rows(every.select("team_id", "transfermarkt_club_id")) == [(1, 10), (1, 12)]


def test_season_defaults_to_each_vendors_latest(teams, rows):
    current = teams([(1, "a", "x", 2025, "b"), (2, "a", "x", 2024, "b"), (3, "a", "x", 2024, "a"), (4, "a", "x", 2023, "a")])
    assert rows(operators.teams_of_season(current, None).select("team_id")) == [(1,), (3,)]
    assert rows(operators.teams_of_season(current, 2024).select("team_id")) == [(2,), (3,)]


def test_short_and_empty_texts_are_found(frame):
    texts = frame([("abcdef", 1), ("xab", 2), ("", 3)], "t string, n int")
    sought = frame([("a",), ("ab",), ("bcdef",), ("zz",), ("",), ("cde",)], "k string")
    found = best_holder(sought, "k", texts, "t", [F.desc("n")], min_length=0)
    assert {r.k: r.n for r in found.collect()} == {"a": 2, "ab": 2, "bcdef": 1, "": 3, "cde": 1}


def test_search_prefers_the_latest_season_then_the_closest_name(frame):
    stats = frame(
        [(1, "Inter", 2023, "x"), (2, "Inter Miami", 2025, "x"), (3, "Inter Turku", 2025, "x"), (4, "PSG", 2025, "x")],
        "team_id int, team_name string, season int, league string",
    )
    asked = frame([("INTER",), ("psg",), ("Inter",), ("nobody",), (None,)], "asked string")
    assert {r.asked: r.team_id for r in find_teams(asked, stats).collect()} == {"INTER": 2, "Inter": 2, "psg": 4}
    assert {r.asked: r.team_id for r in find_teams(asked, stats, "exact").collect()} == {"Inter": 1}
