"""Table operators; each takes and returns DataFrames and runs no action."""

from matchlake.operators.candidates import name_candidates
from matchlake.operators.dedupe import keep_one
from matchlake.operators.enrich import enrich, split_matches, training_sets, with_standings
from matchlake.operators.nested import explode_rows, flatten, parse_fields
from matchlake.operators.quality import duplicate_keys, grouped_counts, nonnull_counts, profile, row_counts
from matchlake.operators.resolve import automatic_matches, manual_matches, resolve_teams, teams_of_season
from matchlake.operators.roles import as_role, stack_roles
from matchlake.operators.search import distinct_leagues, filter_predictions, search_teams
from matchlake.operators.stats import latest_team_stats, logo_per_team, team_profiles
from matchlake.operators.unify import tag_source, unify
from matchlake.operators.values import team_values, top_teams

__all__ = [
    "as_role",
    "automatic_matches",
    "distinct_leagues",
    "duplicate_keys",
    "enrich",
    "explode_rows",
    "filter_predictions",
    "flatten",
    "grouped_counts",
    "keep_one",
    "latest_team_stats",
    "logo_per_team",
    "manual_matches",
    "name_candidates",
    "nonnull_counts",
    "parse_fields",
    "profile",
    "resolve_teams",
    "row_counts",
    "search_teams",
    "stack_roles",
    "tag_source",
    "team_profiles",
    "team_values",
    "teams_of_season",
    "top_teams",
    "split_matches",
    "training_sets",
    "unify",
    "with_standings",
]
