"""Bringing the vendors' tables into one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.operators.dedupe import keep_one


def tag_source(df: DataFrame, source: str) -> DataFrame:
    """``df`` with the constant provenance column ``source``."""
    return df.withColumn("source", F.lit(source))


def unify(
    sources: Mapping[str, DataFrame],
    columns: Mapping[str, str] | Sequence[str],
    dedupe: Sequence[str] | None = None,
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """Stack the sources by column name, each tagged with its name.

    ``columns`` lists the common columns, with their types when given as a mapping;
    a source without one of them gets typed NULLs. Duplicates stay unless
    ``dedupe`` names the key to keep one row of.
    """
    types = columns if isinstance(columns, Mapping) else dict.fromkeys(columns)

    def aligned(df: DataFrame, source: str) -> DataFrame:
        present = set(df.columns)
        picked = []
        for name, kind in types.items():
            column = F.col(name) if name in present else F.lit(None)
            picked.append((column.cast(kind) if kind else column).alias(name))
        return tag_source(df.select(*picked), source)

    stacked = reduce(DataFrame.unionByName, (aligned(df, source) for source, df in sources.items()))
    return keep_one(stacked, dedupe, order) if dedupe else stacked
