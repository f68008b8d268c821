"""The engine's inputs derived from the driver's star-schema tables.

Orders stand for episodes, line items for contacts and measures, nations for providers and published
units, regions for subregions and peer groups, suppliers for areas. Each function reads whole tables.

Line items are counted per supplier and year before the supplier is looked up: hundreds of rows per
key become a few, a hot supplier too. Orders per customer are few, so counting first would shuffle
them twice for nothing; they are joined as they are, and adaptive execution splits a hot customer's
side of that join.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import cache, cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.functions.aggregates import count_where, sum_where
from tallymart.functions.columns import ratio
from tallymart.operators import cleaning
from tallymart.operators.scoping import ScopeSpec
from tallymart.params import GeographyCodes, Params
from tallymart.plans import packs

CODES = GeographyCodes(
    unit="U07",
    national="NAT",
    peer_group="G2",
    neighbours=("U02", "U07", "U12"),
    unit_level="Unit",
    group_level="Unit group",
    area_level="Area",
    peer_group_name="ASIA",
)
PARAMS = Params(
    extract_date=dt.date(2001, 8, 1),
    target_wait_days=30,
    target_followup_rate=0.13,
    target_outcome_rate=0.45,
    baseline_fy=1996,
    scorecard_start=dt.date(2001, 1, 1),
    scorecard_end=dt.date(2001, 6, 30),
    codes=CODES,
)

# One unit in this many has no published rates in a year, whatever the size of the tables.
WITHHELD_EVERY = 8


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")


@cache
def table_schema(spark: SparkSession, path: str) -> T.StructType:
    """Read from a footer once per session: opening the table again starts no job."""
    return spark.read.parquet(path).schema


class DriverTables:
    """The tables of one folder, each opened at first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        path = f"{self.folder}/{name}.parquet"
        table = self.spark.read.schema(table_schema(self.spark, path)).parquet(path)
        setattr(self, name, table)
        return table


def cents(name: str) -> Column:
    """Money as whole cents, so sums are exact in any order."""
    return F.round(F.col(name) * 100).cast("long")


def two_digits(prefix: str, name: str) -> Column:
    return F.concat(F.lit(prefix), F.lpad(F.col(name).cast("string"), 2, "0"))


def fy_label(year: Column, dash: str = "-") -> Column:
    """1998 -> '1997-98'."""
    return F.concat((year - 1).cast("string"), F.lit(dash), F.substring(year.cast("string"), 3, 2))


# Service tables.


def raw_episodes(t: DriverTables, customers: bool = True) -> DataFrame:
    """Orders as episodes; without ``customers`` the two columns looked up there are null."""
    referral, spread = F.col("o_orderdate").cast("date"), cents("o_totalprice")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    waiting = (status == "P") & (priority == "5-LOW")
    if customers:
        looked_up = t.customer.select("c_custkey", "c_nationkey", F.col("c_mktsegment").alias("age_group"))
        rows = t.orders.join(looked_up, F.expr("o_custkey = c_custkey"), "left")
        provider = two_digits("P", "c_nationkey")
    else:
        provider = F.lit(None).cast("string")
        rows = t.orders.withColumn("age_group", provider)
    return rows.select(
        F.col("o_orderkey").alias("episode_id"),
        F.col("o_custkey").alias("client_key"),
        provider.alias("provider_code"),
        referral.alias("referral_date"),
        F.when(~waiting, F.date_add(referral, (spread % 60).cast("int"))).alias("first_contact_date"),
        F.when(status == "F", F.date_add(referral, (spread % 400 - 20).cast("int"))).alias("episode_end_date"),
        F.when(status == "O", "Open")
        .when(waiting, "Awaiting first contact")
        .when(status == "P", "Referral not progressed")
        .when(priority == "5-LOW", "Referred on")
        .when(priority == "4-NOT SPECIFIED", "Client disengaged")
        .otherwise("Treatment concluded")
        .alias("completion_status"),
        F.when(priority == "1-URGENT", "Yes").otherwise("No").alias("suicide_risk_referral"),
        "age_group",
        F.lit("Not stated").alias("sex"),
        F.lit("Not stated").alias("indigenous_status"),
        F.substring(priority, 1, 1).alias("iar_level"),
        F.lit("DRIVER").alias("data_source"),
    )


def line_id() -> Column:
    return F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber"))


def raw_contacts(t: DriverTables) -> DataFrame:
    return t.lineitem.select(
        line_id().alias("contact_id"),
        F.col("l_orderkey").alias("episode_id"),
        F.col("l_shipdate").alias("contact_date"),
        F.col("l_linestatus").alias("modality"),
        F.col("l_quantity").alias("duration_minutes"),
        F.when(F.col("l_returnflag") == "R", "No").otherwise("Yes").alias("attended"),
    )


def raw_measures(t: DriverTables) -> DataFrame:
    line = F.col("l_linenumber")
    return t.lineitem.select(
        line_id().alias("measure_id"),
        F.col("l_orderkey").alias("episode_id"),
        F.when(F.col("l_linestatus") == "F", "K10+").otherwise("SDQ").alias("measure"),
        F.when(line <= 3, "Episode start").when(line >= 5, "Episode end").otherwise("Review").alias("collection_occasion"),
        F.col("l_shipdate").alias("collection_date"),
        F.col("l_quantity").alias("score"),
    )


def nations(t: DriverTables) -> DataFrame:
    """25 nations with their region: fixed tables at every scale."""
    return t.nation.join(t.region, F.expr("n_regionkey = r_regionkey")).select(
        "n_nationkey", "n_name", "r_regionkey", "r_name"
    )


def raw_providers(t: DriverTables) -> DataFrame:
    region = F.col("r_regionkey")
    types = packs.PROGRAM_TYPES
    return nations(t).select(
        two_digits("P", "n_nationkey").alias("provider_code"),
        F.col("n_name").alias("provider_label"),
        F.when(region == 0, types[0]).when(region == 1, types[1]).when(region == 2, types[2]).otherwise(types[3]).alias(
            "program_type"
        ),
        F.col("r_name").alias("subregion"),
        F.lit("100").alias("annual_episode_target"),
        F.lit("DRIVER").alias("data_source"),
    )


def raw_supplier_providers(t: DriverTables) -> DataFrame:
    """Suppliers as providers, for the dimension by itself."""
    types = packs.PROGRAM_TYPES
    balance = F.col("s_acctbal")
    return t.supplier.join(nations(t), F.expr("s_nationkey = n_nationkey"), "left").select(
        F.col("s_suppkey").alias("provider_code"),
        F.col("s_name").alias("provider_label"),
        F.when(balance < 0, types[0]).when(balance < 3000, types[1]).when(balance < 6000, types[2]).otherwise(types[3]).alias(
            "program_type"
        ),
        F.when(balance < 9500, F.col("r_name")).otherwise("ELSEWHERE").alias("subregion"),
        F.floor(F.abs(balance)).cast("string").alias("annual_episode_target"),
        F.lit("DRIVER").alias("data_source"),
    )


def raw_subregions(t: DriverTables) -> DataFrame:
    people = (
        t.customer.groupBy("c_nationkey")
        .agg(F.count(F.lit(1)).alias("people"))
        .join(t.nation, F.expr("c_nationkey = n_nationkey"))
        .groupBy("n_regionkey")
        .agg(F.sum("people").alias("population_2023"), F.min("n_name").alias("hub_town"))
    )
    return t.region.join(people, F.expr("r_regionkey = n_regionkey"), "left").select(
        F.col("r_name").alias("subregion"),
        F.when(F.col("r_regionkey") <= 1, "West").otherwise("East").alias("region"),
        "hub_town",
        "population_2023",
    )


def unit_map(t: DriverTables) -> DataFrame:
    return nations(t).select(F.col("n_name").alias("area_name"), F.col("r_name").alias("subregion"))


def area_map(t: DriverTables) -> DataFrame:
    return t.supplier.join(nations(t), F.expr("s_nationkey = n_nationkey")).select(
        F.col("s_name").alias("area_name"), F.col("r_name").alias("subregion")
    )


def services(t: DriverTables) -> DataFrame:
    """A service per part, named after the supplier of the same number; most have no such area."""
    kinds = packs.SERVICE_TYPES
    return t.part.select(
        F.when(F.col("p_size") <= 25, kinds["urgent_care_clinics"])
        .otherwise(kinds["after_hours_services"])
        .alias("service_type"),
        F.col("p_name").alias("location"),
        F.concat(F.lit("Supplier#"), F.lpad(F.col("p_partkey").cast("string"), 9, "0")).alias("area_name"),
    )


class Cleaned:
    """Typed service tables of one folder, each made at first use."""

    def __init__(self, t: DriverTables):
        self.t = t

    @cached_property
    def episodes(self) -> DataFrame:
        return cleaning.clean_episodes(raw_episodes(self.t))

    @cached_property
    def episodes_alone(self) -> DataFrame:
        """For checks of an episode's own columns, which need no customer."""
        return cleaning.clean_episodes(raw_episodes(self.t, customers=False))

    @cached_property
    def contacts(self) -> DataFrame:
        return cleaning.clean_contacts(raw_contacts(self.t))

    @cached_property
    def measures(self) -> DataFrame:
        return cleaning.clean_measures(raw_measures(self.t))

    @cached_property
    def providers(self) -> DataFrame:
        return cleaning.clean_providers(raw_providers(self.t))

    @cached_property
    def subregions(self) -> DataFrame:
        return cleaning.clean_subregions(raw_subregions(self.t))


# Indicator tables.


def at_all_levels(t: DriverTables, by_nation: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Nation rows plus their region and national totals, with geography columns."""
    named = by_nation.join(nations(t), "n_nationkey")
    region, nation = ["r_regionkey", "r_name"], ["n_nationkey", "n_name"]
    keys = list(keys)
    rolled = named.groupingSets([keys + region + nation, keys + region, keys], *keys, *region, *nation).agg(
        *[F.sum(name).alias(name) for name in sums]
    )
    is_unit, is_group = F.col("n_nationkey").isNotNull(), F.col("r_regionkey").isNotNull()
    return rolled.select(
        *keys,
        fy_label(F.col("fy_end_year")).alias("financial_year"),
        F.when(is_unit, CODES.unit_level).when(is_group, CODES.group_level).otherwise(CODES.national_level).alias(
            "geography_level"
        ),
        F.when(is_unit, two_digits("U", "n_nationkey"))
        .when(is_group, F.concat(F.lit("G"), F.col("r_regionkey").cast("string")))
        .otherwise(CODES.national)
        .alias("geography_code"),
        F.coalesce("n_name", "r_name", F.lit(CODES.national_level)).alias("geography_name"),
        F.coalesce("r_name", F.lit(CODES.national_level)).alias("geographic_group"),
        *sums,
    )


def published(value: Column, turn: Column | int = 0) -> Column:
    """Null for the units whose turn it is in a year not to be published; ``turn`` shifts it within the year."""
    number = F.substring("geography_code", 2, 2).try_cast("int") + F.col("fy_end_year") + turn
    withheld = (F.col("geography_level") == CODES.unit_level) & (number % WITHHELD_EVERY == 0)
    return F.when(~withheld, value)


def per_thousand(count: str, population: str) -> Column:
    """Rate per 1,000, where published."""
    return published(ratio(F.col(count) * F.lit(1000.0), F.col(population)))


def with_others(rows: DataFrame, **others: object) -> DataFrame:
    """Every row again for each given column, with the other value there and a higher measure: rows to be filtered out."""
    own = {name: F.col(name) for name in (*others, "measure_value")}
    higher = F.coalesce("measure_value", F.lit(0.0)) + F.lit(1.0)
    variants = [own] + [own | {name: F.lit(other), "measure_value": higher} for name, other in others.items()]
    entries = F.array(*[F.struct(*[value.alias(name) for name, value in row.items()]) for row in variants])
    return rows.select(*[name for name in rows.columns if name not in own], F.inline(entries)).select(*rows.columns)


def customers_by_nation(t: DriverTables) -> DataFrame:
    return t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("population"))


def ed_indicator(t: DriverTables) -> DataFrame:
    """Clean long indicator: orders per 1,000 customers by unit, year and hour band."""
    after = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    by_nation = (
        t.orders.join(t.customer, F.expr("o_custkey = c_custkey"))
        .groupBy(F.col("c_nationkey").alias("n_nationkey"), F.year("o_orderdate").alias("fy_end_year"))
        .agg(F.count(F.lit(1)).alias("all_hours"), count_where(after).alias("after_hours"))
        .withColumn("in_hours", F.col("all_hours") - F.col("after_hours"))
        .join(customers_by_nation(t), "n_nationkey")
    )
    wide = at_all_levels(t, by_nation, ["fy_end_year"], ["all_hours", "after_hours", "in_hours", "population"])
    rows = (
        (packs.ALL_HOURS_RATE, "All-hours", "rate_age_standardised", per_thousand("all_hours", "population")),
        (packs.AFTER_HOURS_RATE, "After-hours", "rate_age_standardised", per_thousand("after_hours", "population")),
        (packs.IN_HOURS_RATE, "In-hours", "rate_age_standardised", per_thousand("in_hours", "population")),
        (packs.ALL_HOURS_NUMBER, "All-hours", "count", F.col("all_hours").cast("double")),
        (packs.POPULATION, "Not applicable", "population", F.col("population").cast("double")),
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(name).alias("measure_name"),
                F.lit(band).alias("hour_band"),
                F.lit(kind).alias("measure_type"),
                value.alias("measure_value"),
            )
            for name, band, kind, value in rows
        ]
    )
    long = wide.select(
        "fy_end_year",
        "financial_year",
        "geography_level",
        "geography_code",
        "geography_name",
        "geographic_group",
        F.lit(packs.LOWER_URGENCY_TRIAGE).alias("triage_category"),
        F.inline(entries),
    ).withColumn("is_flagged", F.col("measure_value").isNull())
    return with_others(long, triage_category="All", geography_level=CODES.area_level)


def suppliers_by_nation(t: DriverTables) -> DataFrame:
    return t.supplier.groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("population"))


def supplier_nation(t: DriverTables) -> DataFrame:
    return t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey"))


PPH_COLUMNS = (
    "fy_end_year", "financial_year", "geography_level", "geography_code", "geography_name", "geographic_group",
    "demographic_group", "pph_group", "pph_condition", "is_group_total", "measure_type", "measure_value", "flag",
)


def pph_totals(t: DriverTables) -> DataFrame:
    """Clean long indicator: lines per 1,000 suppliers by unit, year and condition total."""
    names = dict(zip(packs.PPH_TOTALS, ("total", "acute", "chronic", "vaccine")))
    flag = F.col("l_returnflag")
    by_nation = (
        t.lineitem.groupBy("l_suppkey", F.year("l_shipdate").alias("fy_end_year"))
        .agg(
            F.count(F.lit(1)).alias("total"),
            count_where(flag == "A").alias("acute"),
            count_where(flag == "N").alias("chronic"),
            count_where(flag == "R").alias("vaccine"),
        )
        .join(supplier_nation(t), "l_suppkey")
        .groupBy("n_nationkey", "fy_end_year")
        .agg(*[F.sum(c).alias(c) for c in names.values()])
        .join(suppliers_by_nation(t), "n_nationkey")
    )
    wide = at_all_levels(t, by_nation, ["fy_end_year"], [*names.values(), "population"])
    entries = F.array(
        *[
            F.struct(F.lit(label).alias("pph_condition"), per_thousand(c, "population").alias("measure_value"))
            for label, c in names.items()
        ]
    )
    long = (
        wide.select("*", F.inline(entries))
        .withColumns(
            {
                "demographic_group": F.lit("All persons"),
                "pph_group": F.lit("Total"),
                "is_group_total": F.lit(True),
                "measure_type": F.lit("rate_age_standardised"),
                "flag": F.when(F.col("measure_value").isNull(), "n.p."),
            }
        )
        .select(*PPH_COLUMNS)
    )
    return with_others(
        long, demographic_group="65+", pph_condition="Angina", measure_type="rate_crude", geography_level=CODES.area_level
    )


def pph_conditions(t: DriverTables) -> DataFrame:
    """Clean long indicator: lines per 1,000 suppliers by unit, year, part type and brand."""
    by_nation = (
        t.lineitem.join(t.part, F.expr("l_partkey = p_partkey"))
        .join(supplier_nation(t), "l_suppkey")
        .groupBy(
            "n_nationkey",
            F.year("l_shipdate").alias("fy_end_year"),
            F.col("p_type").alias("pph_group"),
            F.col("p_brand").alias("pph_condition"),
        )
        .agg(F.count(F.lit(1)).alias("lines"))
    )
    wide = at_all_levels(t, by_nation, ["fy_end_year", "pph_group", "pph_condition"], ["lines"])
    value = published(F.col("lines") * F.lit(2.5), turn=F.ascii(F.right("pph_condition", F.lit(1))))
    long = wide.withColumns(
        {
            "demographic_group": F.lit("All persons"),
            "is_group_total": F.lit(False),
            "measure_type": F.lit("rate_age_standardised"),
            "measure_value": value,
            "flag": F.when(value.isNull(), "n.p."),
        }
    ).select(*PPH_COLUMNS)
    return with_others(long, demographic_group="65+", is_group_total=True, measure_type="rate_crude")


def pph_ages(t: DriverTables) -> DataFrame:
    """Clean long indicator: orders per 1,000 customers by unit, year and two customer bands."""
    band = F.when(F.col("c_acctbal") < 5000, "0-64").otherwise("65+")
    people = t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey"), band.alias("demographic_group")).agg(
        F.count(F.lit(1)).alias("population")
    )
    by_nation = (
        t.orders.join(t.customer, F.expr("o_custkey = c_custkey"))
        .groupBy(
            F.col("c_nationkey").alias("n_nationkey"),
            F.year("o_orderdate").alias("fy_end_year"),
            band.alias("demographic_group"),
        )
        .agg(F.count(F.lit(1)).alias("orders"))
        .join(people, ["n_nationkey", "demographic_group"])
    )
    wide = at_all_levels(t, by_nation, ["fy_end_year", "demographic_group"], ["orders", "population"])
    value = per_thousand("orders", "population")
    long = wide.withColumns(
        {
            "pph_group": F.lit("Total"),
            "pph_condition": F.lit("Total PPH"),
            "is_group_total": F.lit(True),
            "measure_type": F.lit("rate_crude"),
            "measure_value": value,
            "flag": F.when(value.isNull(), "n.p."),
        }
    ).select(*PPH_COLUMNS)
    return with_others(
        long, demographic_group="All persons", pph_condition="Angina", measure_type="rate_age_standardised"
    )


# Areas.


def supplier_years(t: DriverTables) -> DataFrame:
    """Line items per supplier and year: the areas before rates are taken."""
    price, returned = cents("l_extendedprice"), F.col("l_returnflag") == "R"
    return (
        t.lineitem.groupBy("l_suppkey", F.year("l_shipdate").alias("fy_end_year"))
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.sum(price).alias("price"),
            count_where(returned).alias("returned_lines"),
            sum_where(price, returned).alias("returned_price"),
            F.sum(F.col("l_quantity").cast("long")).alias("quantity"),
            F.bool_or(F.col("l_discount") >= 0.1).alias("is_flagged"),
        )
        .join(t.supplier, F.expr("l_suppkey = s_suppkey"))
        .join(nations(t), F.expr("s_nationkey = n_nationkey"))
    )


def wide_areas(years: DataFrame) -> DataFrame:
    return years.select(
        fy_label(F.col("fy_end_year")).alias("financial_year"),
        "fy_end_year",
        F.col("l_suppkey").alias("area_code"),
        F.col("s_name").alias("area_name"),
        F.col("r_name").alias("subregion"),
        ratio(F.col("price"), F.col("lines")).alias("rate_age_standardised"),
        ratio(F.col("returned_price"), F.col("returned_lines")).alias("after_hours_rate_age_standardised"),
        F.col("lines").cast("double").alias("lower_urgency_presentations"),
        F.col("quantity").cast("double").alias("population"),
        "is_flagged",
    )


def area_indicator(years: DataFrame) -> DataFrame:
    """Clean long indicator at area level: one rate per supplier and year."""
    value = ratio(F.col("price"), F.col("lines"))
    long = years.select(
        "fy_end_year",
        fy_label(F.col("fy_end_year")).alias("financial_year"),
        F.lit(CODES.area_level).alias("geography_level"),
        F.col("l_suppkey").alias("geography_code"),
        F.col("s_name").alias("geography_name"),
        F.lit("All persons").alias("demographic_group"),
        F.lit("Total PPH").alias("pph_condition"),
        F.lit("rate_age_standardised").alias("measure_type"),
        value.alias("measure_value"),
        F.when(F.col("is_flagged"), "*").alias("flag"),
    )
    return with_others(
        long, geography_level=CODES.unit_level, demographic_group="65+", pph_condition="Angina", measure_type="rate_crude"
    )


def reference_rates(years: DataFrame) -> DataFrame:
    """Mean line price per nation and for all, by year, from the same counts as the areas."""
    rolled = years.groupingSets([["fy_end_year", "n_nationkey"], ["fy_end_year"]], "fy_end_year", "n_nationkey").agg(
        F.sum("price").alias("price"), F.sum("lines").alias("lines")
    )
    return rolled.select(
        "fy_end_year",
        F.when(F.col("n_nationkey").isNotNull(), two_digits("U", "n_nationkey")).otherwise(CODES.national).alias(
            "geography_code"
        ),
        ratio(F.col("price"), F.col("lines")).alias("rate"),
    )


def long_areas(t: DriverTables) -> DataFrame:
    """Clean long indicator at area level, a row per line item."""
    year, flag = F.year("l_shipdate"), F.col("l_returnflag")
    return t.lineitem.select(
        fy_label(year).alias("financial_year"),
        year.alias("fy_end_year"),
        F.lit(CODES.area_level).alias("geography_level"),
        F.col("l_suppkey").alias("geography_code"),
        F.concat(F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0")).alias("geography_name"),
        F.when(F.col("l_tax") >= 0.04, packs.LOWER_URGENCY_TRIAGE).otherwise("All").alias("triage_category"),
        F.when(flag == "A", packs.ALL_HOURS_RATE)
        .when(flag == "R", packs.AFTER_HOURS_RATE)
        .when(F.col("l_linestatus") == "F", packs.ALL_HOURS_NUMBER)
        .otherwise(packs.POPULATION)
        .alias("measure_name"),
        F.col("l_quantity").alias("measure_value"),
        (F.col("l_discount") >= 0.09).alias("is_flagged"),
    )


# Raw releases, text as published.


def raw_ed_release(t: DriverTables) -> DataFrame:
    """A release row per order: a third is national under one code, years carry an en dash."""
    nation, priority = F.col("c_nationkey"), F.substring("o_orderpriority", 1, 1).cast("int")
    national = F.col("o_orderstatus") == "P"
    measures = packs.ED_SCOPE.measures
    price = cents("o_totalprice")
    return t.orders.join(t.customer, F.expr("o_custkey = c_custkey")).select(
        F.lit("DRV-1").alias("Code"),
        F.lit("Driver tables").alias("DataSource"),
        F.lit("Orders").alias("Name"),
        F.concat(F.lit("Table"), (priority % 4 + 1).cast("string")).alias("Worksheet"),
        fy_label(F.year("o_orderdate"), "–").alias("Year"),
        F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_mktsegment")).alias("StateTerritory"),
        F.when(national, "NAT").when(nation <= 9, "PHN").otherwise("SA3").alias("GeographicUnit"),
        F.when(national, "001NAT")
        .when(nation == 3, "003MET")
        .when(nation == 4, "003REG")
        .otherwise(two_digits("U", "c_nationkey"))
        .alias("GeographicCode"),
        F.when(national, "National").otherwise(two_digits("Area – ", "c_nationkey")).alias("GeographicAreaName"),
        F.col("c_mktsegment").alias("GeographicGroup"),
        F.when(F.col("c_acctbal") < 8000, "All persons").otherwise("0–64").alias("DemographicGroup"),
        F.when(F.col("o_orderstatus") == "O", "").otherwise("All-hours").alias("HourED"),
        F.when(priority <= 3, "TC4+5").otherwise("All").alias("TriageCategory"),
        F.when(priority == 1, measures[0])
        .when(priority == 2, measures[2])
        .when(priority == 3, measures[3])
        .when(priority == 4, measures[5])
        .otherwise("Number of beds")
        .alias("MeasureName"),
        F.when(price < 5_000_000, "n.p.").otherwise(price.cast("string")).alias("MeasureValue"),
        F.when(price < 5_000_000, "np").alias("Flag"),
        F.when(price < 5_000_000, "Not published").alias("FlagExplanation"),
    )


ED_SCOPE = ScopeSpec(
    measures=(packs.ED_SCOPE.measures[0], packs.ED_SCOPE.measures[2], packs.ED_SCOPE.measures[3], "Number of wards"),
    areas=("Area - 11", "Area - 12", "Area - 20", "Area - 77"),
    wide_levels=("NAT", "PHN"),
    area_level="SA3",
    state="BUILDING",
    member_of={"TriageCategory": ("TC4+5", "All")},
    required_codes=("001NAT", "PHN999"),
)


def raw_pph_release(t: DriverTables) -> DataFrame:
    """A release row per line item."""
    measures = tuple(packs.PPH_MEASURES)
    line, supplier = F.col("l_linenumber"), F.col("l_suppkey")
    national = F.col("l_returnflag") == "R"
    return t.lineitem.select(
        F.lit("DRV-2").alias("Code"),
        F.lit("Driver tables").alias("DataSource"),
        F.lit("Line items").alias("Name"),
        F.concat(F.lit("Table"), line.cast("string")).alias("Worksheet"),
        fy_label(F.year("l_shipdate"), "–").alias("Year"),
        F.when(line == 1, "Vic").when(line == 2, "Vic/NSW").when(line == 3, "").otherwise("NSW").alias("StateTerritory"),
        F.when(national, "NAT").when(F.col("l_returnflag") == "A", "PHN").otherwise("SA3").alias("GeographicUnit"),
        F.when(national, "001NAT").otherwise(F.concat(F.lit("S"), supplier.cast("string"))).alias("GeographicCode"),
        F.when(national, "National").otherwise(F.concat(F.lit("Area "), supplier.cast("string"))).alias(
            "GeographicAreaName"
        ),
        F.lit("Regional").alias("GeographicGroup"),
        F.when(F.col("l_tax") < 0.03, "All persons").when(F.col("l_tax") < 0.06, "0–64").otherwise("65+").alias(
            "DemographicGroup"
        ),
        F.when(F.col("l_linestatus") == "F", "Acute").otherwise("Chronic").alias("PPHGroup"),
        F.when(line <= 2, "Total PPH").when(line <= 4, "Total acute").otherwise("Cellulitis").alias("PPHCondition"),
        F.when(F.col("l_discount") < 0.03, measures[0])
        .when(F.col("l_discount") < 0.05, measures[1])
        .when(F.col("l_discount") < 0.07, measures[2])
        .when(F.col("l_discount") < 0.09, measures[3])
        .otherwise("Average length of stay")
        .alias("MeasureName"),
        F.when(F.col("l_quantity") < 5, "-").otherwise(F.col("l_quantity").cast("int").cast("string")).alias("MeasureValue"),
        F.when(F.col("l_quantity") < 5, "-").alias("Flag"),
        F.when(F.col("l_quantity") < 5, "Nil or rounded to zero").alias("FlagExplanation"),
    )


PPH_SCOPE = ScopeSpec(
    measures=tuple(packs.PPH_MEASURES),
    areas=("Area 3", "Area 7", "Area 8"),
    wide_levels=("NAT", "PHN"),
    area_level="SA3",
    state="Vic",
    state_contains=True,
    age_bands=("0-64", "65+"),
    required_codes=("001NAT",),
)
