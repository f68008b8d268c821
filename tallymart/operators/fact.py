"""Episode fact: every flag the KPI layer counts is computed once, here."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions.columns import days_between, quarter_start
from tallymart.params import Params

# Statuses that end an episode, and the status of a running one.
COMPLETED_STATUSES = ("Treatment concluded", "Client disengaged", "Referred on")
OPEN_STATUS = "Open"
FOLLOW_UP_DAYS = 7


def build_episode_fact(episodes: DataFrame, outcomes: DataFrame, contacts: DataFrame, params: Params) -> DataFrame:
    """Episodes with their outcome pivot and contact rollup.

    Both rollups are already at episode grain and partitioned by its key, so each table is shuffled
    once (not at all when the tables are bucketed by episode).
    """
    waited = days_between("referral_date", "first_contact_date")
    stale_before = F.date_sub(F.lit(params.extract_date), params.stale_open_days)
    no_contacts = F.lit(0).cast("long")
    paired = F.col("has_start_measure") & F.col("has_end_measure")
    return (
        episodes.join(outcomes, "episode_id", "left")
        .join(contacts, "episode_id", "left")
        .select(
            "episode_id",
            "client_key",
            "provider_code",
            "referral_date",
            quarter_start("referral_date").alias("referral_quarter"),
            "first_contact_date",
            "episode_end_date",
            quarter_start("episode_end_date").alias("end_quarter"),
            "completion_status",
            "is_suicide_risk_referral",
            "age_group",
            "sex",
            "indigenous_status",
            "iar_level",
            waited.alias("days_to_first_contact"),
            (
                F.col("is_suicide_risk_referral")
                & F.col("first_contact_date").isNotNull()
                & (waited <= FOLLOW_UP_DAYS)
            ).alias("is_followed_up_within_7_days"),
            F.col("completion_status").isin(*COMPLETED_STATUSES).alias("is_completed"),
            ((F.col("completion_status") == OPEN_STATUS) & (F.col("first_contact_date") < stale_before)).alias(
                "is_stale_open"
            ),
            "outcome_measure",
            "start_score",
            "end_score",
            (F.col("end_score") - F.col("start_score")).alias("score_change"),
            F.coalesce("has_start_measure", F.lit(False)).alias("has_start_measure"),
            F.coalesce("has_end_measure", F.lit(False)).alias("has_end_measure"),
            F.coalesce(paired, F.lit(False)).alias("has_paired_measures"),
            F.coalesce("contacts_booked", no_contacts).alias("contacts_booked"),
            F.coalesce("contacts_attended", no_contacts).alias("contacts_attended"),
            F.coalesce("minutes_attended", no_contacts).alias("minutes_attended"),
            "last_contact_date",
            "data_source",
        )
    )
