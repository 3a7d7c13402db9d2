"""Vendor response envelopes: ``{errors, response[]}`` as landed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EMPTY_ERRORS = ("", "[]", "{}", "null")


def _has_errors(errors: Column) -> Column:
    compact = F.regexp_replace(errors, r"\s", "")
    return errors.isNotNull() & ~compact.isin(*EMPTY_ERRORS)


def split_envelopes(
    envelopes: DataFrame, payload: str = "response", errors: str = "errors"
) -> tuple[DataFrame, DataFrame]:
    """Usable envelopes, and the rejected ones with a ``reason``.

    ``errors`` is declared as text, because vendors send it as a list or as an
    object; NULL, ``[]`` and ``{}`` mean there are none.
    """
    reason = F.when(_has_errors(F.col(errors)), "errors").when(
        F.coalesce(F.size(payload), F.lit(0)) <= 0, "empty"
    )
    judged = envelopes.withColumn("reason", reason)
    return judged.filter(F.col("reason").isNull()).drop("reason"), judged.filter(F.col("reason").isNotNull())


def decode_envelopes(
    envelopes: DataFrame, payload: str = "response", errors: str = "errors"
) -> tuple[DataFrame, DataFrame]:
    """One row per payload element of the usable envelopes, and the rejected envelopes."""
    accepted, rejected = split_envelopes(envelopes, payload, errors)
    carried = [c for c in accepted.columns if c not in (payload, errors)]
    rows = accepted.select(*carried, F.explode(payload).alias("element"))
    return rows.select(*carried, "element.*"), rejected


def flatten_groups(envelopes: DataFrame, groups: str = "league.standings", payload: str = "response") -> DataFrame:
    """Rows of the grouped table held by the first payload element of each envelope."""
    table = F.get(F.col(payload), F.lit(0))
    for step in groups.split("."):
        table = table.getField(step)
    carried = [c for c in envelopes.columns if c not in (payload, "errors")]
    rows = envelopes.select(*carried, F.explode(F.flatten(table)).alias("element"))
    return rows.select(*carried, "element.*")
