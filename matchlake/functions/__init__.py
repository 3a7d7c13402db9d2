"""Pure ``Column -> Column`` expressions."""

from matchlake.functions.columns import (
    decode,
    forecast_label,
    league_label,
    league_name,
    outcome_from_code,
    outcome_from_score,
    parse_timestamp,
    percentage,
    season_of,
    target_of,
)
from matchlake.functions.names import club_key, name_key

__all__ = [
    "club_key",
    "decode",
    "forecast_label",
    "league_label",
    "league_name",
    "name_key",
    "outcome_from_code",
    "outcome_from_score",
    "parse_timestamp",
    "percentage",
    "season_of",
    "target_of",
]
