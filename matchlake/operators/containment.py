"""Which strings occur inside which others, without comparing all pairs.

Comparing every name with every other is a nested loop over both tables. Here a
small directory maps the first characters of each sought string to the lengths
found under them; every position of a searched string asks the directory once and
cuts out only substrings of those lengths. Whether a cut substring is a sought
string is then an equality, so rows grow with the text and not with the pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.operators.dedupe import keep_one

GRAM = 4


def cut_substrings(texts: DataFrame, text: str, sought: DataFrame, key: str, min_length: int = GRAM) -> DataFrame:
    """Rows of ``texts`` times the substrings of ``text`` that may equal a ``key`` of ``sought``.

    The substring is the new column ``key``. Each key of at least ``min_length``
    characters that occurs in a text is among that text's rows, possibly repeated.
    """
    shortest = min(min_length, GRAM)
    wanted = F.length(key)
    # One row per leading gram; its list is bounded by the longest key, not by the table.
    allowed = sought.filter(wanted >= min_length) if min_length else sought
    directory = (
        allowed
        .select(F.substring(key, 1, GRAM).alias("_gram"), wanted.alias("_length"))
        .groupBy("_gram")
        .agg(F.collect_set("_length").alias("_lengths"))
    )
    # Shorter grams are whole keys, so they are only cut when such keys are allowed.
    positions = texts.filter(F.length(text) >= shortest).select(
        "*",
        F.explode(F.sequence(F.lit(1), F.length(text) + 1 - shortest)).alias("_at"),
    )
    grams = positions.select(
        "*",
        F.explode(
            F.array_distinct(
                F.array(*(F.substring(F.col(text), F.col("_at"), F.lit(n)) for n in range(shortest, GRAM + 1)))
            )
        ).alias("_gram"),
    )
    hits = grams.join(directory, "_gram").select(
        *texts.columns, "_at", F.explode("_lengths").alias("_length")
    )
    inside = hits.filter(F.col("_at") + F.col("_length") <= F.length(text) + 1)
    return inside.select(*texts.columns, F.substring(F.col(text), F.col("_at"), F.col("_length")).alias(key))


def best_holder(
    sought: DataFrame,
    key: str,
    texts: DataFrame,
    text: str,
    order: Sequence[Column],
    min_length: int = GRAM,
) -> DataFrame:
    """Rows of ``sought`` with the first row of ``texts`` whose ``text`` contains their ``key``.

    ``order`` may use ``key``. The candidates are ranked per substring inside each
    task before the shuffle, so a word that most texts contain stays cheap.
    """
    found = keep_one(cut_substrings(texts, text, sought, key, min_length), [key], order)
    return sought.join(found, key)


def best_held(
    texts: DataFrame,
    text: str,
    sought: DataFrame,
    key: str,
    order: Sequence[Column],
    min_length: int = GRAM,
) -> DataFrame:
    """Rows of ``texts`` with the first row of ``sought`` whose ``key`` occurs in their ``text``.

    Both hold each string once, so a text gains one row per key inside it.
    """
    found = cut_substrings(texts, text, sought, key, min_length)
    return keep_one(found.join(sought, key), [text], order)
