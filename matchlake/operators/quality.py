"""Data-quality reports."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PROFILE_SCHEMA = "dataset string, status string, rows bigint, columns string, error string"


def row_counts(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per key combination; without keys, of the whole table."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def grouped_counts(df: DataFrame, groupings: Sequence[Sequence[str]]) -> DataFrame:
    """Rows per key combination of several groupings at once, from one scan.

    ``grouping`` names the keys of a row, joined by commas, or is ``all``; keys of other groupings
    are NULL. A key that is NULL itself is a group of its own.
    """
    keys = list(dict.fromkeys(key for grouping in groupings for key in grouping))
    used = [F.when(F.grouping(key) == 0, F.lit(key)) for key in keys]
    name = F.coalesce(F.nullif(F.concat_ws(",", *used), F.lit("")), F.lit("all"))
    counted = df.groupingSets([[F.col(k) for k in g] for g in groupings], *keys)
    return counted.agg(name.alias("grouping"), F.count(F.lit(1)).alias("count")).select("grouping", *keys, "count")


def nonnull_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row holding the number of non-null values of each column."""
    return df.agg(*(F.count(name).alias(name) for name in columns))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their number of rows."""
    return row_counts(df, *keys).filter(F.col("count") > 1)


def profile(spark: SparkSession, sources: Mapping[str, Callable[[], DataFrame]]) -> DataFrame:
    """One row per source: its number of rows and its columns, or why it cannot be read.

    All sources are counted by one job. If that fails, they are counted one by one, so that a
    failing source is reported and the others are still counted.
    """
    frames: dict[str, DataFrame] = {}
    failed: dict[str, str] = {}
    for name, read in sources.items():
        try:
            frames[name] = read()
        except (PySparkException, Py4JJavaError) as failure:
            failed[name] = _condition(failure)
    try:
        rows = _counts(frames)
    except (PySparkException, Py4JJavaError):
        rows = {}
        for name, df in frames.items():
            try:
                rows |= _counts({name: df})
            except (PySparkException, Py4JJavaError) as failure:
                failed[name] = _condition(failure)
    report = [
        (name, "failed", None, None, failed[name]) if name in failed else (name, "ok", rows[name], ",".join(frames[name].columns), None)
        for name in sources
    ]
    return spark.createDataFrame(report, PROFILE_SCHEMA)


def _counts(frames: Mapping[str, DataFrame]) -> dict[str, int]:
    counts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name"), "rows") for name, df in frames.items()]
    return {row["name"]: row["rows"] for row in reduce(DataFrame.unionByName, counts).collect()} if counts else {}


def _condition(failure: Exception) -> str:
    condition = failure.getCondition() if isinstance(failure, PySparkException) else None
    return condition or type(failure).__name__
