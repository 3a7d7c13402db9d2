import datetime
import random
import re

import pytest
from pyspark.sql import functions as F

from matchlake.functions import (
    club_key,
    forecast_label,
    league_label,
    league_name,
    name_key,
    outcome_from_code,
    outcome_from_score,
    parse_timestamp,
    percentage,
    season_of,
    target_of,
)
from matchlake.functions.names import CLUB_WORDS


@pytest.mark.parametrize(
    ("name", "simple", "club"),
    [
        ("1. FC Köln", "1 fc kln", "1 k ln"),
        ("Getafe Club de Fútbol S. A. D.", "getafe club de ftbol s a d", "getafe de f tbol s a d"),
        ("Brighton & Hove Albion FC", "brighton  hove albion fc", "brighton hove albion"),
        ("Arsenal FC", "arsenal fc", "arsenal"),
        ("Arsenal Football Club", "arsenal football club", "arsenal"),
        ("Real Madrid CF", "real madrid cf", "real madrid"),
        ("Real Madrid Club de Fútbol", "real madrid club de ftbol", "real madrid de f tbol"),
        ("Club de Futbol Club", "club de futbol club", "de"),
        ("FC", "fc", ""),
        ("  Juventus  ", "juventus", "juventus"),
        (None, None, None),
    ],
)
def test_name_keys(frame, name, simple, club):
    df = frame([(name,)], "name string").select(name_key(F.col("name")), club_key(F.col("name")))
    assert tuple(df.first()) == (simple, club)


def test_club_words_go_as_if_one_after_the_other(frame):
    rng = random.Random(3)
    words = ["club", "de", "futbol", "football", "fc", "sa", "calcio", "clubs", "xfc", "c", " "]
    names = [rng.choice([" ", "-"]).join(rng.choice(words) for _ in range(rng.randint(1, 9))) for _ in range(3000)]

    def expected(name):
        key = re.sub("[^a-z0-9 ]", " ", name.strip(" ").lower())
        for phrase in CLUB_WORDS:
            key = re.sub(rf"\b{phrase}\b", "", key)
        return re.sub(r"\s+", " ", key).strip(" ")

    df = frame([(n,) for n in names], "name string").select("name", club_key(F.col("name")).alias("key"))
    assert all(r.key == expected(r.name) for r in df.collect())


def test_accents_can_be_folded(frame):
    df = frame([("Fútbol Club Köln",)], "name string")
    assert df.select(club_key(F.col("name"), fold_accents=True)).first()[0] == "koln"


def test_outcomes_and_targets(frame):
    scores = [(2, 1), (0, 3), (1, 1), (None, 1), (1, None), (None, None)]
    outcome = outcome_from_score(F.col("h"), F.col("a"))
    df = frame(scores, "h bigint, a bigint").select(outcome.alias("r")).withColumn("t", target_of(F.col("r")))
    assert [tuple(r) for r in df.collect()] == [
        ("HOME_WIN", 0),
        ("AWAY_WIN", 2),
        ("DRAW", 1),
        ("UNKNOWN", None),
        ("UNKNOWN", None),
        ("UNKNOWN", None),
    ]


def test_decoded_codes(frame):
    df = frame([("HOME_TEAM",), ("AWAY_TEAM",), ("DRAW",), ("other",), (None,)], "c string")
    decoded = [r[0] for r in df.select(outcome_from_code(F.col("c"))).collect()]
    assert decoded == ["HOME_WIN", "AWAY_WIN", "DRAW", "UNKNOWN", "UNKNOWN"]
    leagues = frame([("PL",), ("FL1",), ("XX",), (None,)], "c string")
    named = leagues.select(league_name(F.col("c")).alias("l"))
    assert [r[0] for r in named.collect()] == ["premier_league", "ligue_1", "XX", None]
    assert [r[0] for r in named.select(league_label(F.col("l"))).collect()] == ["Premier League", "Ligue 1", "XX", None]
    forecasts = frame([(0.0,), (1.0,), (2.0,), (3.0,)], "p double").select(forecast_label(F.col("p")))
    assert [r[0] for r in forecasts.collect()] == ["Gana Local", "Empate", "Gana Visitante", None]


def test_seasons_and_times(frame):
    df = frame([("2024-08-17",), ("20x4-01-01",), (None,)], "d string").select(season_of(F.col("d")))
    assert [r[0] for r in df.collect()] == [2024, None, None]
    texts = [("2024-08-17T14:00:00Z",), ("2024-08-17T16:00:00+02:00",), ("soon",), (None,)]
    times = frame(texts, "t string").select(parse_timestamp(F.col("t")).cast("timestamp_ntz"))
    kickoff = datetime.datetime(2024, 8, 17, 14)
    assert [r[0] for r in times.collect()] == [kickoff, kickoff, None, None]


def test_missing_class_has_no_share(frame):
    df = frame([([0.25, 0.75],)], "p array<double>")
    shares = df.select(*(percentage(F.col("p"), i).alias(str(i)) for i in range(3)))
    assert tuple(shares.first()) == (25.0, 75.0, 0.0)
