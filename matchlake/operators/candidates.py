"""Pairs of team and club names within an edit distance.

The filter cuts the longer of two strings into segments, as Pass-Join does (Li, Deng, Wang
and Feng, VLDB 2011). An edit spoils at most one of them, so of ``k + 1 + s`` segments at
least ``s + 1`` survive ``k`` edits and occur in the shorter string, near their own
positions. Whichever ``s`` segments are left out, a pair still meets on one of the others:
each name leaves out those that most strings have, so a word that very many names share is
none that they meet on. Names meet on a segment and a length, and each pair that meets is
verified, so the result equals that of comparing all pairs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from matchlake.functions.names import name_key
from matchlake.operators.resolve import TEAM_COLUMNS, club_columns, teams_of_season

TEAM_LONGER, CLUB_LONGER, BOTH_SHORT = 0, 1, 2


#: Segments that a name can leave out.
SPARE = 2


def _pieces(length: str, k: int, spare: int) -> Column:
    """How many segments a name of ``length`` is cut into; none is empty."""
    return F.least(F.col(length), F.lit(k + 1 + spare))


def _with_segment(df: DataFrame, length: str, index: str, pieces: Column) -> DataFrame:
    """Adds ``start`` (from 1) and ``size`` of one of ``pieces`` near-equal segments, longer ones last."""
    base, shorter, i = F.col("_base"), F.col("_shorter"), F.col(index)
    halved = df.withColumns(
        {"_base": F.floor(F.col(length) / pieces).cast("int"), "_shorter": pieces - F.pmod(F.col(length), pieces)}
    )
    return halved.withColumns(
        {
            "start": F.lit(1) + i * base + F.greatest(F.lit(0), i - shorter),
            "size": base + F.when(i >= shorter, 1).otherwise(0),
        }
    ).drop("_base", "_shorter")


def _window(k: int, gap: Column, length: Column) -> Column:
    """Positions a segment can have in a string ``gap`` shorter.

    A shift by s takes at least ``|s|`` edits before the segment and ``|gap + s|`` after it.
    """
    start, size = F.col("start"), F.col("size")
    first = F.greatest(F.lit(1), start - F.floor((F.lit(k) + gap) / 2).cast("int"))
    last = F.least(length - size + 1, start + F.floor((F.lit(k) - gap) / 2).cast("int"))
    return F.when(first <= last, F.sequence(first, last))


def _placed(df: DataFrame, role: int) -> DataFrame:
    """The signature of the piece of ``name`` at ``at``, for the segment ``index`` of a name ``longer`` long."""
    piece = F.substring(F.col("name"), F.col("at"), F.col("size"))
    return df.select("name", F.lit(role).alias("role"), F.xxhash64(F.lit(role), "longer", "index", piece).alias("signature"))


def _segments(names: DataFrame, role: int, k: int, spare: int) -> DataFrame:
    """The longer side: its segments, in their own places."""
    pieces = _pieces("longer", k, spare)
    cut = names.select("name", F.length("name").alias("longer")).filter(F.col("longer") > k)
    cut = cut.select("name", "longer", F.explode(F.sequence(F.lit(0), pieces - 1)).alias("index"))
    return _placed(_with_segment(cut, "longer", "index", pieces).withColumn("at", F.col("start")), role)


def _windows(names: DataFrame, role: int, k: int, spare: int, min_gap: int) -> DataFrame:
    """The shorter side: wherever a segment of a name up to ``k`` longer can have moved to."""
    length, pieces = F.length("name"), _pieces("longer", k, spare)
    cut = names.select("name", F.explode(F.sequence(length + min_gap, length + k)).alias("longer")).filter(F.col("longer") > k)
    cut = cut.select("name", "longer", F.explode(F.sequence(F.lit(0), pieces - 1)).alias("index"))
    window = _window(k, F.col("longer") - length, length)
    return _placed(_with_segment(cut, "longer", "index", pieces).select("*", F.explode(window).alias("at")), role)


def _rarest(segments: DataFrame, windows: DataFrame, k: int) -> DataFrame:
    """For each name its ``k + 1`` segments that the fewest windows have."""
    common = windows.groupBy("signature").agg(F.count(F.lit(1)).alias("common"))
    rarest = Window.partitionBy("name", "role").orderBy(F.col("common").asc_nulls_first(), "signature")
    ranked = segments.join(common, "signature", "left").withColumn("place", F.row_number().over(rarest))
    return ranked.filter((F.col("place") <= k + 1) & F.col("common").isNotNull()).select(*segments.columns)


def _short(names: DataFrame, k: int) -> DataFrame:
    """Names of at most ``k`` characters are all within ``k`` edits of one another."""
    whole = {column: F.lit(0) for column in ("at", "size", "longer", "index")}
    return _placed(names.filter(F.length("name") <= k).withColumns(whole), BOTH_SHORT)


def meetings(teams: DataFrame, clubs: DataFrame, k: int, spare: int = SPARE) -> DataFrame:
    """``(team_key, club_key)`` of names that share a kept segment, once for each that they share."""
    # Every name becomes many signatures, which asks for more tasks than its bytes do.
    tasks = int(teams.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    teams, clubs = teams.repartition(tasks), clubs.repartition(tasks)
    moved = _windows(clubs, TEAM_LONGER, k, spare, 0)
    team_places = [_rarest(_segments(teams, TEAM_LONGER, k, spare), moved, k), _short(teams, k)]
    club_places = [moved, _short(clubs, k)]
    if k > 0:
        moved = _windows(teams, CLUB_LONGER, k, spare, 1)
        team_places.append(moved)
        club_places.append(_rarest(_segments(clubs, CLUB_LONGER, k, spare), moved, k))
    left = reduce(DataFrame.unionByName, team_places).select(F.col("name").alias("team_key"), "signature")
    right = reduce(DataFrame.unionByName, club_places).select(F.col("name").alias("club_key"), "signature")
    return left.join(right, "signature").select("team_key", "club_key")


def near_names(teams: DataFrame, clubs: DataFrame, k: int, spare: int = SPARE) -> DataFrame:
    """Distinct ``(team_key, club_key, name_distance)`` with a distance of at most ``k``.

    Both inputs hold distinct strings in ``name``. Pairs that meet on several segments are one
    before they are verified, in the task that joins them already. A larger ``spare`` leaves
    out more common segments, but makes all of them shorter.
    """
    met = meetings(teams, clubs, k, spare).distinct()
    distance = F.levenshtein("team_key", "club_key", k)
    return met.select("*", distance.alias("name_distance")).filter(F.col("name_distance") >= 0)


def name_candidates(
    teams: DataFrame,
    values: DataFrame,
    max_distance: int,
    season: int | None = None,
    ordered: bool = False,
) -> DataFrame:
    """Every (team, club) whose simple keys are at most ``max_distance`` edits apart.

    Names of at most ``max_distance`` characters are all within it of one another, so
    the distance should be well below the usual name's length.
    Names are compared once per distinct key; ``ordered`` sorts the result for a
    report, which a table does not need.
    """
    current = teams_of_season(teams, season).select(*TEAM_COLUMNS)
    clubs = club_columns(values).withColumn(
        "transfermarkt_name_normalized", name_key(F.col("transfermarkt_club_name"))
    )
    pairs = near_names(
        current.select(F.col("team_name_normalized").alias("name")).dropna().distinct(),
        clubs.select(F.col("transfermarkt_name_normalized").alias("name")).dropna().distinct(),
        max_distance,
    )
    found = (
        current.join(pairs.withColumnRenamed("team_key", "team_name_normalized"), "team_name_normalized")
        .join(clubs, F.col("club_key") == F.col("transfermarkt_name_normalized"))
        .select(*TEAM_COLUMNS, *clubs.columns, "name_distance")
    )
    report_order = ("league", "team_name", "name_distance", "team_id", "season", "source", "transfermarkt_club_id")
    return found.orderBy(*report_order) if ordered else found
