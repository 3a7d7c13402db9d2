"""Home and away: one table seen in two roles, and two roles stacked into one table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROLES = ("home", "away")


def as_role(df: DataFrame, role: str, columns: Sequence[str]) -> DataFrame:
    """``df`` with ``columns`` renamed to ``<role>_<column>``."""
    return df.withColumnsRenamed({name: f"{role}_{name}" for name in columns})


def stack_roles(
    df: DataFrame, shared: Sequence[str], columns: Sequence[str], roles: Sequence[str] = ROLES
) -> DataFrame:
    """One row per role: the ``shared`` columns and ``<role>_<column>`` under its neutral name.

    The table is scanned once, where a union would scan it once per role.
    """
    sides = [F.struct(*(F.col(f"{role}_{name}").alias(name) for name in columns)) for role in roles]
    stacked = df.select(*shared, F.explode(F.array(*sides)).alias("side"))
    return stacked.select(*shared, "side.*")
