"""Mixes sources to target weights by systematic sampling.

A source's documents stand in a row, longest first. Each is expected in the mix as often
as the source's target demands, so the expected copies, summed from the row's start, are a
staircase; with one random offset for the source, a document is emitted once for each whole
number that its step crosses. The steps are whole multiples of 2**-24, so nothing is rounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.llm.common import WORD, fresh, placed, stored

#: Steps are counted in units of one over this.
UNIT_BITS = 24


def words(text: Column) -> Column:
    """Number of words; 0 for NULL and empty texts."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """``sizes`` (source, source_size) with each source's target in words.

    Sources in the order of their code points, NULL last, get the weights in turn and share
    the sum of all sizes by them. No target exceeds ``most`` times its source; the excess
    goes to the others by weight until none is above. One row for each source is moved.
    """
    turn = placed(sizes, [F.col("source").asc_nulls_last()], "turn")
    in_turn = F.array(*[F.lit(float(w)) for w in weights])
    weight = F.element_at(in_turn, (F.col("turn") % len(weights) + 1).cast("int")).alias("weight")
    cap = (most * F.col("source_size")).alias("cap")
    sources = stored(turn.select("source", "source_size", weight, cap), "sources")
    share, capped = None, -1
    while True:
        above = F.lit(False) if share is None else F.col("weight") * share > F.col("cap")
        row = sources.agg(
            F.sum("source_size").alias("total"),
            F.sum(F.when(above, F.col("cap"))).alias("fixed"),
            F.sum(F.when(~above, F.col("weight"))).alias("open"),
            F.count_if(above).alias("capped"),
        ).first()
        if row["capped"] == capped or not row["open"]:
            break
        share, capped = (row["total"] - (row["fixed"] or 0)) / row["open"], row["capped"]
    target = F.least(F.col("weight") * F.lit(share or 0.0), F.col("cap").cast("double"))
    return sources.select("source", "source_size", target.alias("target"))


def offset(source: Column, seed: int) -> Column:
    """The source's random offset in units: 24 bits of a digest of the seed and its name."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit(""))))
    return F.conv(F.substring(digest, 1, UNIT_BITS // 4), 16, 10).cast("long")


def copies(
    docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: int = 3, seed: int = 0, size: Column | None = None
) -> DataFrame:
    """``docs`` with size, source_size, target and the number of copies that the mix takes.

    Needs doc_id, source and, unless ``size`` gives the words, text; other columns stay, and
    those of the same names are replaced. NULL texts have size 0; NULL is a source of its own,
    which comes last. Equal rows are taken one by one. A source without words takes nothing.
    """
    docs = docs.withColumn("size", words(F.col("text")) if size is None else size).drop("source_size", "target", "copies")
    place, first, same = (fresh(docs, x) for x in ("place", "first_place", "same_source"))
    order = [F.col("source").asc_nulls_last(), F.col("size").desc(), F.col("doc_id").asc_nulls_last()]
    row = placed(docs, order, place)
    per_source = row.groupBy("source").agg(F.sum("size").alias("source_size"), F.min(place).alias(first))
    per_source = stored(per_source, "source_sizes")
    shares = targets(per_source.select("source", "source_size"), weights, most)
    per_source = per_source.alias("a").join(shares.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")))
    per_source = per_source.select(F.col("a.source").alias(same), "a.source_size", first, "target")
    rate = F.floor(F.col("target") / F.col("source_size") * 2**UNIT_BITS)
    rate = F.when(F.col("source_size") > 0, rate).otherwise(0).cast("long")
    k = F.col(place) - F.col(first)
    stairs = [F.shiftright((k + i) * rate + offset(F.col("source"), seed), UNIT_BITS) for i in (0, 1)]
    mixed = row.join(per_source, F.col("source").eqNullSafe(F.col(same)))
    return mixed.withColumn("copies", stairs[1] - stairs[0]).select(
        *[F.col(f"`{c}`") for c in docs.columns], "source_size", "target", "copies"
    )


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: int = 3, seed: int = 0) -> DataFrame:
    """The mix itself: rows of ``docs`` with all its columns, each as often as it is taken."""
    rows = docs.select("doc_id", "source", words(F.col("text")).alias("size"), F.struct("*").alias("row"))
    taken = copies(rows, weights, most, seed, F.col("size")).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")
