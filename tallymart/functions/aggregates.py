"""Conditional aggregates: several measures from one pass instead of several joins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_where(condition: Column) -> Column:
    """Rows for which the condition is true; null does not count. Zero on no rows."""
    return F.count_if(condition)


def sum_where(value: Column, condition: Column) -> Column:
    """Null when no row passes."""
    return F.sum(F.when(condition, value))


def max_where(value: Column, condition: Column) -> Column:
    """Null when no row passes; on unique rows this turns long rows into columns."""
    return F.max(F.when(condition, value))


def any_where(condition: Column) -> Column:
    """True when at least one row passes, false otherwise, never null."""
    return F.count_if(condition) > F.lit(0)


def weighted_median(value: Column, frequency: Column) -> Column:
    """Exact median of pre-counted values; null values are skipped, an even count is averaged."""
    return F.percentile(value, F.lit(0.5), frequency)


def joined_names(name: str, separator: str = ", ") -> Column:
    """Names in alphabetical order as one text."""
    escaped = separator.replace("'", "''")
    return F.expr(f"listagg(`{name}`, '{escaped}') WITHIN GROUP (ORDER BY `{name}`)")
