"""Flattening nested vendor rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_fields(text: str) -> list[tuple[str, str]]:
    """``path alias`` lines to pairs; a line holding one word keeps its name."""
    pairs = []
    for line in text.strip().splitlines():
        path, *alias = line.split()
        pairs.append((path, alias[0] if alias else path))
    return pairs


def flatten(df: DataFrame, fields: str | Sequence[tuple[str, str]]) -> DataFrame:
    """One flat column per (path, alias); Parquet scans then read only those leaves."""
    pairs = parse_fields(fields) if isinstance(fields, str) else fields
    return df.select(*(F.col(path).alias(alias) for path, alias in pairs))


def explode_rows(
    df: DataFrame,
    array: str,
    alias: str,
    keep: Sequence[tuple[str, str]] = (),
    where: Column | None = None,
) -> DataFrame:
    """One row per element of ``array``, with the (path, alias) columns of ``keep`` repeated.

    NULL and empty arrays give no row. ``where`` is a predicate on the element;
    call the function again on the result for a second level.
    """
    carried = [F.col(path).alias(name) for path, name in keep]
    rows = df.select(*carried, F.explode(array).alias(alias))
    return rows if where is None else rows.filter(where)
