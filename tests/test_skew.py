"""One key with a third of all rows: same results, and the work is split."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallymart.operators import cleaning, quality, rollups
from tallymart.operators.profiling import profile
from tallymart.plans import packs

ROWS = 240_000
START = dt.date(2026, 1, 1)


@pytest.fixture
def forced_shuffles(spark):
    """No broadcast of data, and skew thresholds that fit a test."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


@pytest.fixture
def contacts(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 20_000)
    return spark.range(0, ROWS, numPartitions=8).select(
        F.col("id").alias("contact_id"),
        key.alias("episode_id"),
        F.date_add(F.lit(START), (F.col("id") % 100).cast("int")).alias("contact_date"),
        F.lit(10).alias("duration_minutes"),
        (F.col("id") % 2 == 0).alias("is_attended"),
    )


@pytest.fixture
def episodes(spark):
    return spark.range(0, 20_000, numPartitions=8).select(
        F.col("id").alias("episode_id"),
        F.lit(START + dt.timedelta(10)).alias("first_contact_date"),
        F.lit(None).cast("date").alias("episode_end_date"),
    )


def test_a_hot_episode_is_split_in_the_window_check(spark, forced_shuffles, contacts, episodes):
    found = quality.contacts_outside_episode(contacts, episodes, START + dt.timedelta(89))
    expected = sum(not 10 <= i % 100 <= 89 for i in range(ROWS))
    assert len(found.collect()) == expected
    assert "SortMergeJoin(skew=true)" in found._jdf.queryExecution().executedPlan().toString()


def test_a_hot_orphan_is_split_in_the_relationship_check(spark, forced_shuffles, contacts, episodes):
    found = quality.orphans(contacts, "episode_id", episodes.filter("episode_id > 0"))
    assert len(found.collect()) == sum(i % 3 == 0 or i % 20_000 == 0 for i in range(ROWS))
    assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()


def test_a_hot_episode_is_combined_before_the_shuffle(spark, contacts):
    rolled = rollups.rollup_contacts(contacts)
    hot = rolled.filter("episode_id = 0").first()
    ids = [i for i in range(ROWS) if i % 3 == 0 or i % 20_000 == 0]
    assert (hot.contacts_booked, hot.minutes_attended) == (len(ids), 10 * sum(i % 2 == 0 for i in ids))
    plan = rolled._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning(episode_id")
    assert sorted(r.n for r in profile(contacts, ["episode_id"], k=1).collect()) == [len(ids)]


def test_hot_national_copies_leave_one_row(spark):
    national = F.col("id") % 3 == 0
    raw = spark.range(0, 60_000, numPartitions=8).select(
        F.concat(F.lit("Table"), (F.col("id") % 4).cast("string")).alias("Worksheet"),
        F.lit("2017-18").alias("Year"),
        F.lit("").alias("StateTerritory"),
        F.when(national, "NAT").otherwise("PHN").alias("GeographicUnit"),
        F.when(national, "001NAT").otherwise((F.col("id") % 500).cast("string")).alias("GeographicCode"),
        F.lit("x").alias("GeographicAreaName"),
        F.lit("x").alias("GeographicGroup"),
        F.lit("All persons").alias("DemographicGroup"),
        F.lit("All-hours").alias("HourED"),
        F.lit("TC4+5").alias("TriageCategory"),
        F.lit(packs.ALL_HOURS_RATE).alias("MeasureName"),
        F.col("id").cast("string").alias("MeasureValue"),
        F.lit(None).cast("string").alias("Flag"),
        F.lit(None).cast("string").alias("FlagExplanation"),
    )
    clean = cleaning.clean_indicator(raw, packs.ED_SPEC)
    kept = clean.filter("geography_code = '001NAT'").collect()
    assert [r.measure_value for r in kept] == [0.0]
    assert clean.count() == 1 + len({i % 500 for i in range(60_000) if i % 3})
