"""Provider KPIs by quarter and by period, and service reach by subregion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.functions.aggregates import count_where, sum_where, weighted_median
from tallymart.functions.columns import half_away, quarter_label, ratio, target_status, within
from tallymart.functions.tables import with_spine
from tallymart.operators.fact import OPEN_STATUS
from tallymart.params import Params


def _risk_contacted() -> Column:
    return F.col("is_suicide_risk_referral") & F.col("first_contact_date").isNotNull()


def kpi_quarterly(fact: DataFrame, providers: DataFrame) -> DataFrame:
    """Provider x quarter: access KPIs by referral quarter, outcome collection by end quarter.

    One pass over the fact: each episode counts towards its referral quarter and, when completed,
    its end quarter. Rows are first counted per provider, quarter and wait; waits are whole days, so
    this is small, splits a hot provider over its waits, and still gives the exact median. The spine
    holds the quarters with a referral: completions in any other quarter have no row.
    """
    referred = F.struct(F.col("referral_quarter").alias("quarter"), F.lit(True).alias("is_referral"))
    ended = F.when(
        F.col("is_completed"), F.struct(F.col("end_quarter").alias("quarter"), F.lit(False).alias("is_referral"))
    )
    cohorts = fact.select(
        "provider_code",
        "days_to_first_contact",
        _risk_contacted().alias("risk_contacted"),
        "is_followed_up_within_7_days",
        "has_paired_measures",
        F.explode(F.array(referred, ended)).alias("cohort"),
    ).filter(F.col("cohort").isNotNull())
    is_referral = F.col("cohort.is_referral")
    counted = (
        cohorts.withColumn("quarter", F.col("cohort.quarter"))
        .withColumn("wait", F.when(is_referral, F.col("days_to_first_contact")))
        .groupBy("provider_code", "quarter", "wait")
        .agg(
            count_where(is_referral).alias("referrals"),
            count_where(is_referral & F.col("risk_contacted")).alias("contacted"),
            count_where(is_referral & F.col("is_followed_up_within_7_days")).alias("followed"),
            count_where(~is_referral).alias("completed"),
            count_where(~is_referral & F.col("has_paired_measures")).alias("paired"),
        )
    )
    cells = counted.groupBy("provider_code", "quarter").agg(
        *[F.sum(name).alias(name) for name in ("referrals", "contacted", "followed", "completed", "paired")],
        weighted_median(F.col("wait"), F.col("referrals")).alias("median_wait"),
    )
    spine = with_spine(
        providers.select("provider_code"), fact.select(F.col("referral_quarter").alias("quarter")).distinct(), "quarter"
    )

    def or_zero(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0).cast("long"))

    return spine.join(cells, ["provider_code", "quarter"], "left").select(
        "provider_code",
        "quarter",
        quarter_label("quarter").alias("quarter_label"),
        or_zero("referrals").alias("referrals"),
        F.col("median_wait").alias("median_days_to_first_contact"),
        or_zero("contacted").alias("suicide_risk_referrals_contacted"),
        or_zero("followed").alias("suicide_risk_followed_up_7_days"),
        ratio(F.col("followed"), F.col("contacted")).alias("followup_7day_rate"),
        or_zero("completed").alias("episodes_completed"),
        or_zero("paired").alias("episodes_completed_with_paired_measures"),
        ratio(F.col("paired"), F.col("completed")).alias("outcome_collection_rate"),
    )


def kpi_scorecard(fact: DataFrame, providers: DataFrame, params: Params) -> DataFrame:
    """One row per provider for ``params.scorecard``: KPIs, backlog and a status per target.

    Referral, completion and backlog counts come from one pass. A provider without referrals in the
    period has null access counts, one without completions null outcome counts, and one without any
    episode a null backlog; a null metric is 'Below target'.
    """
    period = params.scorecard
    referred = within("referral_date", period.start, period.end)
    completed = F.col("is_completed") & within("episode_end_date", period.start, period.end)
    paired = completed & F.col("has_paired_measures")
    counted = (
        fact.withColumn("wait", F.when(referred, F.col("days_to_first_contact")))
        .groupBy("provider_code", "wait")
        .agg(
            count_where(referred).alias("referrals"),
            count_where(referred & _risk_contacted()).alias("contacted"),
            count_where(referred & F.col("is_followed_up_within_7_days")).alias("followed"),
            count_where(completed).alias("completed"),
            count_where(paired).alias("paired"),
            sum_where(F.col("score_change"), paired).alias("score_sum"),
            F.count(F.when(paired, F.col("score_change"))).alias("scored"),
            count_where(F.col("completion_status") == OPEN_STATUS).alias("open_episodes"),
            count_where(F.col("is_stale_open")).alias("stale_open_episodes"),
        )
    )
    sums = (
        "referrals", "contacted", "followed", "completed", "paired",
        "score_sum", "scored", "open_episodes", "stale_open_episodes",
    )
    cells = counted.groupBy("provider_code").agg(
        *[F.sum(name).alias(name) for name in sums],
        weighted_median(F.col("wait"), F.col("referrals")).alias("median_days_to_first_contact"),
    )
    wait, followup, outcome = (
        F.col("median_days_to_first_contact"),
        F.col("followup_7day_rate"),
        F.col("outcome_collection_rate"),
    )
    dim = providers.select("provider_code", "provider_label", "program_type", "subregion")
    return (
        dim.join(cells, "provider_code", "left")
        .select(
            *dim.columns,
            F.nullif("referrals", F.lit(0)).alias("referrals"),
            "median_days_to_first_contact",
            ratio(F.col("followed"), F.col("contacted")).alias("followup_7day_rate"),
            F.when(F.col("referrals") > 0, F.col("contacted")).alias("suicide_risk_referrals_contacted"),
            F.nullif("completed", F.lit(0)).alias("episodes_completed"),
            ratio(F.col("paired"), F.col("completed")).alias("outcome_collection_rate"),
            ratio(F.col("score_sum"), F.col("scored")).alias("avg_score_change"),
            "open_episodes",
            "stale_open_episodes",
            ratio(F.col("stale_open_episodes"), F.col("open_episodes")).alias("stale_open_share"),
        )
        .withColumns(
            {
                "wait_status": target_status(wait <= params.target_wait_days),
                "followup_status": target_status(followup >= params.target_followup_rate),
                "outcome_collection_status": target_status(outcome >= params.target_outcome_rate),
            }
        )
    )


def service_reach(
    fact: DataFrame,
    providers: DataFrame,
    subregions: DataFrame,
    indicator: DataFrame,
    area_map: DataFrame,
    params: Params,
    *,
    level: str,
    triage: str,
    presentations: str,
    population: str,
) -> DataFrame:
    """Referrals and latest-year presentations per subregion, each against its own population.

    Episodes are counted per provider before the provider is looked up, and the published rows per
    area name before the area is, so both joins see one row per key.
    """
    activity = (
        fact.groupBy("provider_code")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(providers.select("provider_code", "subregion"), "provider_code")
        .groupBy("subregion")
        .agg(F.sum("n").alias("referrals"))
    )
    latest = indicator.agg(F.max("fy_end_year")).scalar()
    published = (
        indicator.filter(
            (F.col("geography_level") == level)
            & (F.col("triage_category") == triage)
            & (F.col("fy_end_year") == latest)
        )
        .groupBy(F.col("geography_name").alias("area_name"))
        .agg(
            sum_where(F.col("measure_value"), F.col("measure_name") == presentations).alias("presentations"),
            sum_where(F.col("measure_value"), F.col("measure_name") == population).alias("area_population"),
        )
        .join(area_map, "area_name")
        .groupBy("subregion")
        .agg(F.sum("presentations").alias("presentations"), F.sum("area_population").alias("area_population"))
    )
    yearly = ratio(F.col("referrals") / F.lit(float(params.reach_years)), F.col("population_2023"))
    return (
        subregions.select("subregion", "region", "population_2023")
        .join(activity, "subregion", "left")
        .join(published, "subregion", "left")
        .select(
            "subregion",
            "region",
            "population_2023",
            "referrals",
            half_away(yearly * 1000, 1).alias("referrals_per_1000_per_year"),
            "presentations",
            half_away(ratio(F.col("presentations"), F.col("area_population")) * 1000, 1).alias(
                "presentations_per_1000_crude"
            ),
        )
    )
