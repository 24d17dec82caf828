"""Guarded arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marlstone.functions.text import stripped


def number(text: Column) -> Column:
    """A float, or null where the text isn't one."""
    return stripped(text).try_cast("double")


def ratio(top: Column, bottom: Column, empty: float | None = 0.0) -> Column:
    """top / bottom, or ``empty`` where the denominator is zero or null."""
    value = F.when((bottom != 0), top / bottom)
    return value if empty is None else F.coalesce(value, F.lit(empty))


def percent(top: Column, bottom: Column) -> Column:
    """A percentage; null without a denominator."""
    return F.when(bottom != 0, top / bottom * 100)
