"""Aggregates to episode or area grain, taken before any join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions.aggregates import max_where

# Both rollups are views of a layer too, so they are written as SQL: {source} is a frame or a table of the catalog.
CONTACT_ROLLUP = """
SELECT episode_id, count(1) AS contacts_booked, count_if(is_attended) AS contacts_attended,
       sum(CASE WHEN is_attended THEN duration_minutes END) AS minutes_attended, max(contact_date) AS last_contact_date
FROM {source} GROUP BY episode_id"""
OUTCOME_PIVOT = """
SELECT episode_id, min(measure) AS outcome_measure,
       max(CASE WHEN collection_occasion = 'start' THEN score END) AS start_score,
       max(CASE WHEN collection_occasion = 'end' THEN score END) AS end_score,
       count_if(collection_occasion = 'start') > 0 AS has_start_measure,
       count_if(collection_occasion = 'end') > 0 AS has_end_measure
FROM {source} GROUP BY episode_id"""


def rollup_contacts(contacts: DataFrame) -> DataFrame:
    """Activity per episode; minutes stay null when nothing was attended."""
    return contacts.sparkSession.sql(CONTACT_ROLLUP, source=contacts)


def pivot_outcomes(measures: DataFrame) -> DataFrame:
    """Start and end score per episode side by side; the alphabetically first instrument names it."""
    return measures.sparkSession.sql(OUTCOME_PIVOT, source=measures)


def pivot_measures(
    long: DataFrame, keys: Sequence[str], columns: Mapping[str, str], flag: str = "is_flagged"
) -> DataFrame:
    """Long measures to one row per ``keys``: ``columns`` maps output names to measure names.

    ``flag`` is true when any of the group's rows carries it, whatever its measure.
    """
    return long.groupBy(*keys).agg(
        *[
            max_where(F.col("measure_value"), F.col("measure_name") == measure).alias(name)
            for name, measure in columns.items()
        ],
        F.bool_or(flag).alias(flag),
    )


def area_table(
    indicator: DataFrame, area_map: DataFrame, columns: Mapping[str, str], level: str, triage: str
) -> DataFrame:
    """Area by year: the rows of ``level`` whose name is in the area map, measures as columns.

    The rows of an area become one before its name is looked up.
    """
    rows = indicator.filter((F.col("geography_level") == level) & (F.col("triage_category") == triage)).select(
        "financial_year",
        "fy_end_year",
        F.col("geography_code").alias("area_code"),
        F.col("geography_name").alias("area_name"),
        "measure_name",
        "measure_value",
        "is_flagged",
    )
    wide = pivot_measures(rows, ["financial_year", "fy_end_year", "area_code", "area_name"], columns)
    return wide.join(area_map, "area_name").select(
        "financial_year", "fy_end_year", "area_code", "area_name", "subregion", *columns, "is_flagged"
    )
