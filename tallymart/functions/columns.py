"""Scalar expressions. All are built-in functions, so they stay inside generated code."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The en dash as published, and the control character it is in a file that was read
# as Latin-1 elsewhere.
DASHES = ("–", "\u0096")


def yes_flag(name: str) -> Column:
    """'Yes' is true, other text false, null stays null."""
    return F.col(name) == F.lit("Yes")


def fy_end_year(name: str) -> Column:
    """'2017-18' -> 2018."""
    return F.substring(F.col(name), 1, 4).cast("int") + F.lit(1)


def lenient_double(name: str) -> Column:
    """Number, or null for text such as 'n.p.' or '-'."""
    return F.col(name).try_cast("double")


def blank_to_null(name: str) -> Column:
    return F.nullif(F.col(name), F.lit(""))


def code_map(name: str, mapping: Mapping[str, str]) -> Column:
    """Exact code lookup; an unknown code gives null."""
    return first_match((F.col(name) == F.lit(code), F.lit(label)) for code, label in mapping.items())


def like_map(name: str, patterns: Iterable[tuple[str, str]]) -> Column:
    """Label of the first LIKE pattern that matches; none gives null."""
    return first_match((F.col(name).like(pattern), F.lit(label)) for pattern, label in patterns)


def first_match(branches: Iterable[tuple[Column, Column]], otherwise: Column | None = None) -> Column:
    branches = list(branches)
    if not branches:
        raise ValueError("at least one branch is needed")
    expression = F.when(*branches[0])
    for condition, value in branches[1:]:
        expression = expression.when(condition, value)
    return expression if otherwise is None else expression.otherwise(otherwise)


def plain_dashes(name: str) -> Column:
    """Published dashes become hyphens."""
    return F.translate(F.col(name), "".join(DASHES), "-" * len(DASHES))


def with_dash_forms(values: Iterable[str]) -> list[str]:
    """Each value as written and with its hyphens in published form.

    Filtering the raw column on these forms keeps the predicate on a bare column, which the
    Parquet reader can push down; filtering the normalised expression could not be.
    """
    forms = []
    for value in values:
        forms.append(value)
        forms.extend(value.replace("-", dash) for dash in DASHES if "-" in value)
    return forms


def quarter_start(name: str) -> Column:
    return F.trunc(F.col(name), "QUARTER")


def quarter_label(name: str) -> Column:
    """2025-04-01 -> '2025-Q2'."""
    return F.concat(F.date_format(F.col(name), "yyyy"), F.lit("-Q"), F.quarter(F.col(name)).cast("string"))


def days_between(earlier: str, later: str) -> Column:
    return F.date_diff(F.col(later), F.col(earlier)).cast("long")


def within(name: str, start: dt.date, end: dt.date) -> Column:
    """Both ends included."""
    return F.col(name).between(F.lit(start), F.lit(end))


def ratio(numerator: Column, denominator: Column) -> Column:
    """True division; a zero or null denominator gives null."""
    return F.try_divide(numerator.cast("double"), denominator)


def half_away(value: Column, digits: int) -> Column:
    """Round half away from zero on the scaled binary value.

    ``F.round(x, n)`` rounds the decimal text of x instead and differs for numbers such as 8.325;
    verdicts compare rounded percentages, so the rule has to be one rule.
    """
    scale = F.lit(float(10**digits))
    return F.round(value * scale, 0) / scale


def pct_change(now: Column, before: Column) -> Column:
    """Percent change to one decimal; null when the earlier value is null or zero."""
    return half_away(F.lit(100.0) * (ratio(now, before) - F.lit(1.0)), 1)


def target_status(condition: Column) -> Column:
    """A null metric does not meet its target."""
    return F.when(condition, F.lit("On target")).otherwise(F.lit("Below target"))
