"""Deterministic choice of one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK = "_rank"


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """The first row per key under ``order``; without one, all other columns in turn.

    ``order`` must tell any two different rows of a key apart. Spark ranks each
    task's rows before the shuffle as well, so a key that holds much of the table
    reaches its reducer as one row per map task.
    """
    if order is None:
        order = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys] or [F.lit(0)]
    ranked = df.withColumn(RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(RANK) == 1).drop(RANK)
