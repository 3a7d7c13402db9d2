"""The engine's operators bound to the star-schema test tables, each with its SQL counterpart."""
