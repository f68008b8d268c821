"""Report feeds: small reads over the marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def scorecard_feed(scorecard: DataFrame) -> DataFrame:
    """Provider statuses, last provider code first."""
    return scorecard.orderBy(F.desc("provider_code")).select(
        "provider_label",
        F.col("median_days_to_first_contact").alias("wait"),
        "followup_7day_rate",
        "outcome_collection_rate",
        "wait_status",
        "followup_status",
        "outcome_collection_status",
    )


def collection_feed(quarterly: DataFrame, since: dt.date, min_completed: int = 20) -> DataFrame:
    """Outcome collection by quarter for cells with enough completed episodes."""
    return (
        quarterly.filter((F.col("quarter") >= F.lit(since)) & (F.col("episodes_completed") >= min_completed))
        .select("provider_code", "quarter", "quarter_label", F.col("outcome_collection_rate").alias("rate"))
        .orderBy(F.asc_nulls_last("quarter"))
    )


def benchmark_feed(benchmark: DataFrame) -> DataFrame:
    return benchmark.orderBy(F.asc_nulls_last("fy_end_year")).select("financial_year", "unit_rate", "national_rate")


def latest_national_rate(benchmark: DataFrame) -> DataFrame:
    return benchmark.orderBy(F.desc("fy_end_year")).limit(1).select("national_rate")


def latest_area_feed(areas: DataFrame) -> DataFrame:
    """Areas of the latest year, lowest rate first."""
    return (
        areas.filter(F.col("fy_end_year") == areas.agg(F.max("fy_end_year")).scalar())
        .select("area_name", "subregion", F.col("rate_age_standardised").alias("rate"), "financial_year")
        .orderBy(F.asc_nulls_last("rate"))
    )
