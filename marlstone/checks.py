"""Violations as rows; an explicit action turns them into an error before data is used."""

from __future__ import annotations

from pyspark.sql import DataFrame


class ConstraintError(ValueError):
    """A dataset breaks its rules; the first broken rows are in the message."""


def require_none(violations: DataFrame, what: str, show: int = 5) -> None:
    """Raise if there is any violation (a column that nobody selects would never be checked)."""
    rows = violations.limit(show).collect()
    if rows:
        raise ConstraintError(f"{what}: " + "; ".join(str(r.asDict()) for r in rows))
