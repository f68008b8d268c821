"""Every operator as a query over the driver tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.functions.aggregates import sum_where
from tallymart.functions.columns import ratio
from tallymart.functions.tables import keep_first, spread_rank
from tallymart.operators import (
    cleaning,
    dimensions,
    fact,
    feeds,
    indicators,
    kpis,
    profiling,
    quality,
    rollups,
    scoping,
)
from tallymart.plans import packs
from tallymart.plans.driver_tables import (
    CODES,
    ED_SCOPE,
    PARAMS,
    PPH_SCOPE,
    Cleaned,
    DriverTables,
    area_indicator,
    area_map,
    ed_indicator,
    long_areas,
    pph_ages,
    pph_conditions,
    pph_totals,
    raw_ed_release,
    raw_pph_release,
    raw_supplier_providers,
    reference_rates,
    services,
    supplier_years,
    unit_map,
    wide_areas,
)
from tallymart.session import materialise
from tallymart.sources.writers import sorted_export

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[DriverTables], DataFrame]) -> Callable[[DriverTables], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(DriverTables(spark, folder))
    return build


# Service tables and KPIs.


@query
def clean_episodes(t):
    return Cleaned(t).episodes


@query
def clean_measures(t):
    return Cleaned(t).measures


@query
def contact_rollup(t):
    return rollups.rollup_contacts(Cleaned(t).contacts)


@query
def outcome_pivot(t):
    return rollups.pivot_outcomes(Cleaned(t).measures)


@query
def clean_contacts(t):
    return Cleaned(t).contacts


@query
def dim_provider(t):
    return dimensions.dim_provider(cleaning.clean_providers(raw_supplier_providers(t)), Cleaned(t).subregions)


def nation_providers(t) -> DataFrame:
    c = Cleaned(t)
    return dimensions.dim_provider(c.providers, c.subregions)


@query
def dim_subregion(t):
    return dimensions.dim_subregion(Cleaned(t).subregions, unit_map(t))


@query
def episode_fact(t):
    c = Cleaned(t)
    return fact.build_episode_fact(
        c.episodes, rollups.pivot_outcomes(c.measures), rollups.rollup_contacts(c.contacts), PARAMS
    )


@query
def kpi_quarterly(t):
    return kpis.kpi_quarterly(episode_fact(t), nation_providers(t))


@query
def kpi_scorecard(t):
    return kpis.kpi_scorecard(episode_fact(t), nation_providers(t), PARAMS)


@query
def service_reach(t):
    return kpis.service_reach(
        episode_fact(t),
        nation_providers(t),
        dim_subregion(t),
        materialise(ed_indicator(t)),
        unit_map(t),
        PARAMS,
        level=CODES.unit_level,
        triage=packs.LOWER_URGENCY_TRIAGE,
        presentations=packs.ALL_HOURS_NUMBER,
        population=packs.POPULATION,
    )


# Releases: scope, clean, deduplicate, profile.


@query
def scope_release(t):
    return scoping.scope_release(raw_ed_release(t), ED_SCOPE)


@query
def scope_release_ages(t):
    return scoping.scope_release(raw_pph_release(t), PPH_SCOPE)


@query
def scope_missing(t):
    return scoping.missing_required(scope_release(t), ED_SCOPE)


@query
def clean_indicator(t):
    return cleaning.clean_indicator(scope_release(t), packs.ED_SPEC)


@query
def clean_indicator_ages(t):
    return cleaning.clean_indicator(scope_release_ages(t), packs.PPH_SPEC)


LINE_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query
def clean_dedup(t):
    """First of the line items that share order and line number, by ship date."""
    lines = t.lineitem.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    order = [F.asc_nulls_last(c) for c in (*LINE_ORDER, "l_returnflag", "l_linestatus")]
    return keep_first(lines, ["l_orderkey", "l_linenumber"], order)


@query
def profile_release(t):
    return profiling.profile(raw_pph_release(t), packs.PROFILE_COLUMNS)


@query
def profile_events(t):
    return profiling.profile(t.events, ["user_id", "event_type", "props"])


@query
def profile_documents(t):
    return profiling.profile(t.documents, ["lang", "source", "n_chars", "text"], long=["text"])


# Indicators.


def band_rates(t) -> DataFrame:
    return indicators.rates_by_band(ed_indicator(t), CODES, packs.LOWER_URGENCY_TRIAGE, packs.BAND_SEPARATOR)


@query
def indicator_trend_band(t):
    return indicators.indicator_trend(band_rates(t), "hour_band", "IM-02", CODES)


@query
def indicator_trend_category(t):
    rates = indicators.rates_by_category(pph_totals(t), CODES, packs.PPH_TOTALS)
    return indicators.indicator_trend(rates, "pph_category", "IM-01", CODES)


def all_hours(t) -> DataFrame:
    return indicator_trend_band(t).filter(F.col("hour_band") == packs.ALL_HOURS)


def total_category(t) -> DataFrame:
    return indicator_trend_category(t).filter(F.col("pph_category") == "PPH")


@query
def age_trend(t):
    return indicators.age_trend(pph_ages(t), CODES)


@query
def benchmark_unit(t):
    rows = ed_indicator(t).filter(
        (F.col("measure_name") == packs.ALL_HOURS_RATE)
        & (F.col("triage_category") == packs.LOWER_URGENCY_TRIAGE)
        & (F.col("hour_band") == packs.ALL_HOURS)
    )
    return indicators.benchmark_unit(rows.withColumnRenamed("measure_value", "rate"), CODES)


@query
def condition_gaps(t):
    latest = t.lineitem.agg(F.max(F.year("l_shipdate"))).scalar()
    return indicators.condition_gaps(pph_conditions(t), CODES, latest)


@query
def area_pivot(t):
    return rollups.area_table(
        long_areas(t), area_map(t), packs.AREA_COLUMNS, CODES.area_level, packs.LOWER_URGENCY_TRIAGE
    )


@query
def area_rates(t):
    return indicators.area_rates(area_indicator(supplier_years(t)), area_map(t), CODES)


@query
def area_trend(t):
    years = materialise(supplier_years(t))
    references = indicators.yearly_references(reference_rates(years), CODES)
    rates = indicators.area_rates(area_indicator(years), area_map(t), CODES)
    return indicators.area_trend(rates, references)


@query
def area_hotspots(t):
    years = materialise(supplier_years(t))
    references = indicators.yearly_references(reference_rates(years), CODES)
    return indicators.area_hotspots(wide_areas(years), references, services(t), packs.SERVICE_TYPES, PARAMS)


@query
def order_rank(t):
    """Every order ranked by its total within its year, ties included."""
    orders = t.orders.select("o_orderkey", F.year("o_orderdate").alias("fy_end_year"), "o_totalprice")
    return spread_rank(orders, ["fy_end_year"], "o_totalprice", "rank_highest_first", descending=True)


@query
def peer_comparison(t):
    return indicators.peer_comparison([all_hours(t), total_category(t)], CODES)


@query
def criteria_check(t):
    return indicators.criteria_check(all_hours(t), total_category(t), PARAMS)


# Feeds and exports.


@query
def feed_scorecard(t):
    return feeds.scorecard_feed(kpi_scorecard(t))


@query
def feed_collection(t):
    return feeds.collection_feed(kpi_quarterly(t), dt.date(1998, 4, 1))


@query
def feed_benchmark(t):
    return feeds.benchmark_feed(benchmark_unit(t))


@query
def feed_top1(t):
    return feeds.latest_national_rate(benchmark_unit(t))


@query
def feed_latest_areas(t):
    return feeds.latest_area_feed(materialise(wide_areas(supplier_years(t))))


@query
def export_trend(t):
    return sorted_export(indicator_trend_band(t), packs.EXPORTS["im02_lower_urgency"].order)


# Data quality: failing rows.


@query
def q_unique(t):
    return quality.duplicate_keys(Cleaned(t).contacts, ["contact_id"], count_nulls=False)


@query
def q_not_null(t):
    return Cleaned(t).measures.filter(quality.is_missing("collection_occasion")).select("measure_id", "episode_id")


@query
def q_accepted(t):
    allowed = ("Treatment concluded", "Client disengaged", "Referred on", "Open")
    rows = Cleaned(t).episodes_alone.filter(quality.not_accepted("completion_status", allowed))
    return rows.select("episode_id", "completion_status")


@query
def q_relationships(t):
    """Line items whose supplier number is no nation number."""
    return quality.orphans(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey"), "l_suppkey", t.nation, "n_nationkey"
    )


@query
def q_unique_combo(t):
    return quality.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query
def q_dates_in_order(t):
    rows = Cleaned(t).episodes_alone.filter(quality.dates_out_of_order())
    return rows.select("episode_id", "referral_date", "first_contact_date", "episode_end_date")


@query
def q_contact_window(t):
    c = Cleaned(t)
    return quality.contacts_outside_episode(c.contacts, c.episodes_alone, PARAMS.extract_date)


@query
def q_one_per_day(t):
    return quality.repeated_contact_days(Cleaned(t).contacts)


@query
def q_first_contact(t):
    c = Cleaned(t)
    return quality.first_contact_without_record(c.episodes_alone, c.contacts)


@query
def q_scale(t):
    return Cleaned(t).measures.filter(quality.outside_scale()).select("measure_id", "measure", "score")


@query
def q_rate_bounds(t):
    """Orders whose returned share of the kept quantity leaves [0, 1]."""
    quantity, flag = F.col("l_quantity").cast("long"), F.col("l_returnflag")
    rates = (
        t.lineitem.groupBy("l_orderkey")
        .agg(
            sum_where(quantity, flag == "R").alias("returned"),
            sum_where(quantity, flag == "N").alias("kept"),
            F.sum(quantity).alias("total"),
        )
        .select(
            "l_orderkey",
            ratio(F.col("returned"), F.col("kept")).alias("followup_7day_rate"),
            ratio(F.col("returned"), F.col("total")).alias("outcome_collection_rate"),
        )
    )
    return rates.filter(quality.rate_out_of_bounds("followup_7day_rate", "outcome_collection_rate"))


@query
def q_area_complete(t):
    """Years in which not every part was shipped."""
    shipped = t.lineitem.select(F.year("l_shipdate").alias("fy_end_year"), F.col("l_partkey").alias("area_code"))
    return quality.incomplete_years(shipped, t.part)


@query
def q_rows_complete(t):
    return quality.wrong_row_count(indicator_trend_band(t), (CODES.unit, CODES.national), 48)


# Stands in for the seed of published values: literals, not cut from the rates that they check. On the tables of scale
# 0.01 some are within a tenth of the rate, some beyond, and some name a series or year that is not there.
PUBLISHED_VALUES = (
    ("IM-02", "U07", 1995, "All-hours", 1520.5),
    ("IM-02", "U07", 1999, "All-hours", 1726.0),
    ("IM-02", "U07", 2000, "All-hours", 1823.9),
    ("IM-02", "NAT", 1995, "All-hours", 1524.0),
    ("IM-02", "NAT", 2001, "All-hours", 871.0),
    ("IM-02", "NAT", 2005, "All-hours", 900.0),
    ("IM-02", "U07", 1996, "After-hours", 602.7),
    ("IM-02", "U02", 1997, "After-hours", 473.0),
    ("IM-02", "NAT", 1998, "After-hours", 602.7),
    ("IM-02", "NAT", 2000, "After-hours", 625.0),
    ("IM-02", "NAT", 1997, "Daytime", 895.3),
    ("IM-02", "U99", 1997, "All-hours", 895.3),
    ("IM-01", "NAT", 1995, "All-hours", 1524.0),
)


@query
def q_reconcile(t):
    """Published values against the trends of their series; only these series are built."""
    columns = "indicator_code string, geography_code string, fy_end_year int, category string, published_value double"
    published = t.spark.createDataFrame(PUBLISHED_VALUES, columns)
    rates = quality.published_series(band_rates(t), published, "hour_band")
    trend = indicators.indicator_trend(rates, "hour_band", "IM-02", CODES)
    return quality.unreconciled(published, {"hour_band": trend}, 0.1)


@query
def q_unmapped(t):
    return quality.unmapped(services(t), "area_name", area_map(t))


@query
def q_drift(t):
    """Line counts per order before and after deduplication."""
    before = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines"))
    return quality.drift(before, clean_dedup(t).groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines")))


@query
def q_report(t):
    """The suite's report over the cleaned service tables."""
    c = Cleaned(t)
    tables = {"episodes": c.episodes, "contacts": c.contacts, "measures": c.measures, "providers": c.providers}
    checks = [
        quality.unique("episodes", "episode_id"),
        *quality.not_null("episodes", "episode_id", "first_contact_date", "episode_end_date"),
        quality.related("episodes", "provider_code", "providers"),
        quality.accepted("episodes", "iar_level", (1, 2, 3, 4)),
        quality.Check("episode_dates_in_order", "episodes", condition=quality.dates_out_of_order()),
        *quality.not_null("measures", "measure_id", "collection_occasion"),
        quality.accepted("measures", "measure", ("K10+",)),
        quality.unique_combination("measures", "episode_id", "collection_occasion"),
        quality.related("contacts", "episode_id", "episodes"),
        quality.Check("scores_within_scale", "measures", condition=quality.outside_scale()),
    ]
    return quality.run_checks(tables, checks)
