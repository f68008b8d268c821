import datetime as dt

import pytest

from tallymart import Params
from tallymart.operators import dimensions, fact, kpis, rollups

D = dt.date
PARAMS = Params(extract_date=D(2026, 6, 30))

EPISODE = (
    "episode_id string, client_key string, provider_code string, referral_date date, first_contact_date date, "
    "episode_end_date date, completion_status string, is_suicide_risk_referral boolean, age_group string, sex string, "
    "indigenous_status string, iar_level int, data_source string"
)
CONTACT = "contact_id string, episode_id string, contact_date date, modality string, duration_minutes int, is_attended boolean"
MEASURE = "measure_id string, episode_id string, measure string, collection_occasion string, collection_date date, score int"


def episode(key, provider="A", referral=D(2026, 1, 10), first=None, end=None, status="Open", risk=False):
    return (key, "c", provider, referral, first, end, status, risk, "25-64", "F", "Neither", 3, "SYNTHETIC")


def contacts_of(spark, rows):
    return spark.createDataFrame([(f"{k}-{i}", k, day, "Phone", m, a) for i, (k, day, m, a) in enumerate(rows)], CONTACT)


def measures_of(spark, rows):
    return spark.createDataFrame([(f"m{i}", k, m, o, D(2026, 1, 1), s) for i, (k, m, o, s) in enumerate(rows)], MEASURE)


def fact_of(spark, episodes, contacts=(), measures=()):
    return fact.build_episode_fact(
        spark.createDataFrame(episodes, EPISODE),
        rollups.pivot_outcomes(measures_of(spark, measures)),
        rollups.rollup_contacts(contacts_of(spark, contacts)),
        PARAMS,
    )


def providers_of(spark, *codes):
    return spark.createDataFrame([(c, c.lower(), "Low intensity", "North") for c in codes],
                                 "provider_code string, provider_label string, program_type string, subregion string")


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_contact_rollup(spark):
    rows = [("a", D(2026, 1, 1), 30, True), ("a", D(2026, 1, 9), 45, False), ("a", D(2026, 1, 2), None, True),
            ("b", D(2026, 2, 1), 50, False), ("b", D(2026, 2, 2), 50, None)]
    got = by(rollups.rollup_contacts(contacts_of(spark, rows)), "episode_id")
    assert tuple(got["a"])[1:] == (3, 2, 30, D(2026, 1, 9))
    assert tuple(got["b"])[1:] == (2, 0, None, D(2026, 2, 2))


def test_outcome_pivot(spark):
    rows = [("start", "K10+", "start", 30), ("end", "SDQ", "end", 9), ("both", "SDQ", "start", 20),
            ("both", "SDQ", "end", 15), ("none", "K10+", None, 11)]
    got = by(rollups.pivot_outcomes(measures_of(spark, rows)), "episode_id")
    assert tuple(got["start"])[1:] == ("K10+", 30, None, True, False)
    assert tuple(got["end"])[1:] == ("SDQ", None, 9, False, True)
    assert tuple(got["both"])[1:] == ("SDQ", 20, 15, True, True)
    assert tuple(got["none"])[1:] == ("K10+", None, None, False, False)


def test_dimensions(spark):
    subregions = spark.createDataFrame(
        [("North", "R1", "Hub", 10), ("South", "R2", "Town", 20)],
        "subregion string, region string, hub_town string, population_2023 int",
    )
    providers = spark.createDataFrame(
        [("A", "a", "Low intensity", "North", 5, "S"), ("B", "b", "Low intensity", "Nowhere", 5, "S")],
        "provider_code string, provider_label string, program_type string, subregion string, "
        "annual_episode_target int, data_source string",
    )
    areas = spark.createDataFrame([("Zed", "North"), ("Alpha", "North")], "area_name string, subregion string")
    got = by(dimensions.dim_provider(providers, subregions), "provider_code")
    assert (got["A"].region, got["B"].region) == ("R1", None)
    got = by(dimensions.dim_subregion(subregions, areas), "subregion")
    assert (got["North"].area_count, got["North"].area_names) == (2, "Alpha, Zed")
    assert (got["South"].area_count, got["South"].area_names) == (0, None)


def test_fact_flags(spark):
    extract = PARAMS.extract_date
    rows = [
        episode("day7", referral=D(2026, 1, 1), first=D(2026, 1, 8), risk=True),
        episode("day8", referral=D(2026, 1, 1), first=D(2026, 1, 9), risk=True),
        episode("uncontacted", risk=True),
        episode("norisk", first=D(2026, 1, 11)),
        episode("unknown risk", first=D(2026, 1, 11), risk=None),
        episode("180", first=extract - dt.timedelta(180)),
        episode("181", first=extract - dt.timedelta(181)),
        episode("181 ended", first=extract - dt.timedelta(181), status="Referred on", end=D(2026, 4, 2)),
        episode("nostatus", status=None, first=D(2026, 1, 11)),
        episode("waiting", status="Awaiting first contact"),
    ]
    measures = [("day7", "K10+", "start", 30), ("day7", "K10+", "end", 22), ("day8", "K10+", "start", 30)]
    got = by(fact_of(spark, rows, [("day7", D(2026, 1, 8), 40, False)], measures), "episode_id")
    followed = {k: r.is_followed_up_within_7_days for k, r in got.items()}
    assert (followed["day7"], followed["day8"], followed["uncontacted"], followed["norisk"]) == (True, False, False, False)
    assert followed["unknown risk"] is None
    assert (got["180"].is_stale_open, got["181"].is_stale_open, got["181 ended"].is_stale_open) == (False, True, False)
    assert got["uncontacted"].is_stale_open is None
    assert (got["181 ended"].is_completed, got["waiting"].is_completed, got["nostatus"].is_completed) == (True, False, None)
    assert (got["181 ended"].end_quarter, got["day7"].referral_quarter) == (D(2026, 4, 1), D(2026, 1, 1))
    assert (got["day7"].days_to_first_contact, got["uncontacted"].days_to_first_contact) == (7, None)
    assert (got["day7"].score_change, got["day8"].score_change) == (-8, None)
    assert (got["day7"].has_paired_measures, got["day8"].has_paired_measures) == (True, False)
    nothing = got["waiting"]
    assert (nothing.has_start_measure, nothing.has_end_measure, nothing.has_paired_measures) == (False, False, False)
    assert (nothing.contacts_booked, nothing.contacts_attended, nothing.minutes_attended) == (0, 0, 0)
    assert (got["day7"].contacts_booked, got["day7"].minutes_attended) == (1, 0)
    assert nothing.last_contact_date is None and nothing.outcome_measure is None


def quarterly_rows(spark):
    rows = [
        episode("1", "A", D(2026, 1, 1), D(2026, 1, 5), risk=True),
        episode("2", "A", D(2026, 2, 1), D(2026, 2, 21), risk=True),
        episode("3", "A", D(2026, 2, 1)),
        episode("4", "A", D(2026, 2, 1), D(2026, 2, 3), D(2026, 5, 1), "Treatment concluded"),
        episode("5", "B", D(2026, 4, 1), D(2026, 4, 2), D(2026, 4, 9), "Client disengaged"),
        episode("6", "B", D(2026, 4, 1), D(2026, 4, 2), D(2026, 9, 9), "Referred on"),
        episode("7", "B", D(2026, 4, 1), D(2026, 4, 2), None, "Referred on"),
    ]
    measures = [("4", "SDQ", "start", 9), ("4", "SDQ", "end", 7)]
    return fact_of(spark, rows, measures=measures)


def test_quarterly_kpis(spark):
    got = {
        (r.provider_code, r.quarter_label): r
        for r in kpis.kpi_quarterly(quarterly_rows(spark), providers_of(spark, "A", "B", "C")).collect()
    }
    # No quarter 3: nobody was referred in it, although an episode ended there.
    assert set(got) == {(p, q) for p in "ABC" for q in ("2026-Q1", "2026-Q2")}
    first = got["A", "2026-Q1"]
    assert (first.referrals, first.median_days_to_first_contact) == (4, 4.0)
    assert (first.suicide_risk_referrals_contacted, first.suicide_risk_followed_up_7_days) == (2, 1)
    assert (first.followup_7day_rate, first.episodes_completed, first.outcome_collection_rate) == (0.5, 0, None)
    second = got["A", "2026-Q2"]
    assert (second.referrals, second.median_days_to_first_contact, second.followup_7day_rate) == (0, None, None)
    assert (second.episodes_completed, second.episodes_completed_with_paired_measures) == (1, 1)
    assert second.outcome_collection_rate == 1.0
    other = got["B", "2026-Q2"]
    assert (other.referrals, other.episodes_completed, other.outcome_collection_rate) == (3, 1, 0.0)
    assert (got["C", "2026-Q1"].referrals, got["C", "2026-Q1"].median_days_to_first_contact) == (0, None)


def test_scorecard(spark):
    rows = [
        episode("1", "A", D(2026, 1, 1), D(2026, 1, 11), D(2026, 6, 30), "Treatment concluded"),
        episode("2", "A", D(2026, 6, 30), D(2026, 7, 20), risk=True),
        episode("3", "A", D(2025, 12, 31), D(2026, 1, 1), D(2026, 2, 1), "Referred on"),
        episode("4", "B", D(2025, 6, 1), D(2025, 6, 2)),
    ]
    measures = [("1", "SDQ", "start", 9), ("1", "SDQ", "end", 4)]
    df = kpis.kpi_scorecard(fact_of(spark, rows, measures=measures), providers_of(spark, "A", "B", "C"), PARAMS)
    got = by(df, "provider_code")
    a, b, c = got["A"], got["B"], got["C"]
    assert (a.referrals, a.median_days_to_first_contact, a.wait_status) == (2, 15.0, "Below target")
    assert (a.suicide_risk_referrals_contacted, a.followup_7day_rate, a.followup_status) == (1, 0.0, "Below target")
    assert (a.episodes_completed, a.outcome_collection_rate, a.avg_score_change) == (2, 0.5, -5.0)
    assert (a.open_episodes, a.stale_open_episodes, a.stale_open_share) == (1, 0, 0.0)
    assert (b.referrals, b.suicide_risk_referrals_contacted, b.episodes_completed) == (None, None, None)
    assert (b.open_episodes, b.stale_open_episodes, b.stale_open_share) == (1, 1, 1.0)
    assert (c.referrals, c.open_episodes, c.wait_status, c.outcome_collection_status) == (
        None, None, "Below target", "Below target",
    )


def test_scorecard_statuses_meet_their_targets(spark):
    rows = [episode(str(i), "A", D(2026, 1, 1), D(2026, 1, 15 if i else 8), D(2026, 2, 1), "Referred on", True) for i in (0, 1)]
    measures = [(str(i), "SDQ", o, 9) for i in (0, 1) for o in ("start", "end")]
    params = Params(target_followup_rate=0.5)
    row = kpis.kpi_scorecard(fact_of(spark, rows, measures=measures), providers_of(spark, "A"), params).first()
    assert (row.wait_status, row.followup_status, row.outcome_collection_status) == ("On target",) * 3


def test_service_reach(spark):
    facts = fact_of(spark, [episode(str(i), "A" if i < 3 else "B") for i in range(4)])
    subregions = spark.createDataFrame(
        [("North", "R", 1000), ("South", "R", 500)], "subregion string, region string, population_2023 int"
    )
    indicator = spark.createDataFrame(
        [("SA3", y, "TC4+5", a, m, v) for y, a, m, v in [
            (2024, "x", "n", 99.0), (2025, "x", "n", 30.0), (2025, "x", "pop", 300.0), (2025, "y", "n", 6.0),
            (2025, "y", "pop", 100.0), (2025, "other", "n", 1.0)]],
        "geography_level string, fy_end_year int, triage_category string, geography_name string, "
        "measure_name string, measure_value double",
    )
    areas = spark.createDataFrame([("x", "North"), ("y", "North")], "area_name string, subregion string")
    df = kpis.service_reach(
        facts, providers_of(spark, "A", "B"), subregions, indicator, areas, PARAMS,
        level="SA3", triage="TC4+5", presentations="n", population="pop",
    )
    got = by(df, "subregion")
    assert (got["North"].referrals, got["North"].referrals_per_1000_per_year) == (4, 2.7)
    assert (got["North"].presentations, got["North"].presentations_per_1000_crude) == (36.0, 90.0)
    assert tuple(got["South"])[3:] == (None, None, None, None)


def test_a_quarter_pass_reads_the_fact_once(spark, sf_dir):
    from tallymart.plans.catalogue import QUERIES

    plan = QUERIES["kpi_scorecard"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("orders.parquet") == 1
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("key, rows", [("hot", 3000)])
def test_a_hot_provider_gives_the_same_kpis(spark, key, rows):
    hot = [episode(str(i), key, D(2026, 1, 1), D(2026, 1, 1) + dt.timedelta(i % 40)) for i in range(rows)]
    row = by(kpis.kpi_quarterly(fact_of(spark, hot), providers_of(spark, key, "cold")), "provider_code")[key]
    assert (row.referrals, row.median_days_to_first_contact) == (rows, 19.5)


def test_a_missing_referral_quarter_has_a_row_for_each_provider(spark):
    rows = [
        episode("1", "A", D(2026, 1, 1), D(2026, 1, 5), risk=True),
        episode("2", "A", None, D(2026, 1, 5), None, "Open"),
        episode("3", "A", D(2026, 1, 2), D(2026, 1, 5), None, "Treatment concluded"),
    ]
    got = kpis.kpi_quarterly(fact_of(spark, rows), providers_of(spark, "A", "B")).collect()
    assert sorted((r.provider_code, r.quarter_label or "") for r in got) == [
        ("A", ""), ("A", "2026-Q1"), ("B", ""), ("B", "2026-Q1")
    ]
    # No quarter equals a missing one, so nothing is counted there: neither its referrals nor its completions.
    for r in got:
        if r.quarter is None:
            assert (r.referrals, r.episodes_completed, r.median_days_to_first_contact, r.followup_7day_rate) == (0, 0, None, None)
