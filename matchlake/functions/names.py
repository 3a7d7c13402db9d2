"""Name keys: the two normal forms names are compared in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words and phrases that say nothing about a club, in order of removal.
CLUB_WORDS = (
    "football club",
    "futbol club",
    "club de futbol",
    "club",
    "fc",
    "cf",
    "sad",
    "calcio",
    "spvgg",
    "sa",
)
# Removing a word leaves its spaces, so no phrase arises from its neighbours and one
# pass does for all. Only one pair of phrases overlaps against the order: "futbol
# club" goes first, so "club de futbol" must leave its end to a following "club".
CLUB_PATTERN = rf"\b(?:{'|'.join(CLUB_WORDS)})\b".replace("de futbol", r"de futbol(?! club\b)")

ACCENTED = "áàâäãåéèêëíìîïóòôöõúùûüñçýÿ"
PLAIN = "aaaaaaeeeeiiiiooooouuuuncyy"


def _lowered(name: Column, fold_accents: bool) -> Column:
    lowered = F.lower(F.trim(name))
    return F.translate(lowered, ACCENTED, PLAIN) if fold_accents else lowered


def name_key(name: Column, fold_accents: bool = False) -> Column:
    """Simple key: lower case, everything but ``a-z 0-9`` and spaces deleted."""
    return F.regexp_replace(_lowered(name, fold_accents), "[^a-z0-9 ]", "")


def club_key(name: Column, fold_accents: bool = False) -> Column:
    """Club key: as the simple key, but punctuation separates words and club words go."""
    key = F.regexp_replace(_lowered(name, fold_accents), "[^a-z0-9 ]", " ")
    key = F.regexp_replace(key, CLUB_PATTERN, "")
    return F.trim(F.regexp_replace(key, " +", " "))
