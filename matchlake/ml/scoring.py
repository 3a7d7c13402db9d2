"""Forecasts for matches to come."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.functions.columns import forecast_label, percentage
from matchlake.ml.forest import FEATURES, feature_rows

# The published percentage column of each class.
PERCENTAGES = {"prob_gana_local": 0, "prob_empate": 1, "prob_gana_visitante": 2}


def with_forecast(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with the three class percentages and the forecast label."""
    predicted = model.transform(df)
    shares = vector_to_array("probability")
    return predicted.select(
        *df.columns,
        *(percentage(shares, target).alias(name) for name, target in PERCENTAGES.items()),
        forecast_label(F.col("prediction")).alias("pronostico"),
    )


def score(model: PipelineModel, future: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Published predictions of all matches that have every feature."""
    wanted = ("match_date", "league", "home_team_name", "away_team_name", *features)
    scored = with_forecast(model, feature_rows(future, features).select(*dict.fromkeys(wanted)))
    return scored.select(
        F.col("match_date").cast("string").alias("fecha"),
        F.col("league").alias("liga"),
        F.col("home_team_name").alias("local"),
        F.col("away_team_name").alias("visitante"),
        *PERCENTAGES,
        "pronostico",
    )
