from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tallymart import GeographyCodes, Params
from tallymart.operators import feeds, indicators, rollups

CODES = GeographyCodes()
RATES = (
    "fy_end_year int, financial_year string, geography_level string, geography_code string, geography_name string, "
    "geographic_group string, band string, rate double"
)


def label(year):
    return f"{year - 1}-{year % 100:02d}"


def rate(year, code, value, band="All-hours", level="PHN", group="Regional", name=None):
    return (year, label(year), level, code, name or code, group, band, value)


def national(year, value, band="All-hours"):
    return rate(year, "001NAT", value, band, "National", "National", "National")


def group(year, value, band="All-hours"):
    return rate(year, "003REG", value, band, "PHN group", "x", "Regional")


def trend(spark, rows, indicator="I"):
    return indicators.indicator_trend(spark.createDataFrame(rows, RATES), "band", indicator, CODES)


def test_trend_goes_by_row_not_by_year(spark):
    rows = [rate(2019, "PHN206", 100.0), rate(2021, "PHN206", 90.0), rate(2022, "PHN206", None),
            rate(2023, "PHN206", 45.0), rate(2018, "PHN1", 0.0), rate(2019, "PHN1", 5.0)]
    got = {(r.geography_code, r.fy_end_year): r for r in trend(spark, rows).collect()}
    late = got["PHN206", 2021]
    assert (late.prior_year_rate, late.baseline_rate) == (100.0, 100.0)
    assert (late.change_pct_year_on_year, late.change_pct_since_baseline) == (-10.0, -10.0)
    assert got["PHN206", 2019].change_pct_year_on_year is None
    assert got["PHN206", 2019].change_pct_since_baseline == 0.0
    assert got["PHN206", 2022].change_pct_since_baseline is None
    after_gap = got["PHN206", 2023]
    assert (after_gap.change_pct_year_on_year, after_gap.change_pct_since_baseline) == (None, -55.0)
    assert got["PHN1", 2019].change_pct_year_on_year is None


def test_trend_flags_and_peer_groups(spark):
    rows = [rate(2018, "PHN206", 1.0), rate(2018, "PHN204", 1.0, group="Metropolitan"), national(2018, 1.0), group(2018, 1.0)]
    got = {r.geography_code: r for r in trend(spark, rows).collect()}
    assert {k: r.peer_group for k, r in got.items()} == {
        "PHN206": "Regional", "PHN204": "Metropolitan", "001NAT": "National", "003REG": "Regional",
    }
    assert [got[k].is_reported_unit for k in ("PHN206", "PHN204")] == [True, False]
    assert [got[k].is_neighbour for k in ("PHN206", "PHN204", "001NAT")] == [True, True, False]


def test_rates_come_from_measure_name_and_totals(spark):
    long = spark.createDataFrame(
        [(2018, "2017-18", "PHN", "PHN1", "n", "g", "TC4+5", "Not applicable", "rate_age_standardised", "In-hours lower urgency ED, x", 3.0),
         (2018, "2017-18", "SA3", "1", "n", "g", "TC4+5", "All-hours", "rate_age_standardised", "In-hours lower urgency ED, x", 3.0),
         (2018, "2017-18", "PHN", "PHN1", "n", "g", "All", "All-hours", "rate_age_standardised", "In-hours lower urgency ED, x", 3.0),
         (2018, "2017-18", "PHN", "PHN1", "n", "g", "TC4+5", "All-hours", "count", "Number x", 3.0)],
        "fy_end_year int, financial_year string, geography_level string, geography_code string, geography_name string, "
        "geographic_group string, triage_category string, hour_band string, measure_type string, measure_name string, measure_value double",
    )
    assert [r.hour_band for r in indicators.rates_by_band(long, CODES, "TC4+5", " lower urgency").collect()] == ["In-hours"]
    pph = long.select("*", F.lit("All persons").alias("demographic_group"), F.lit("Total acute").alias("pph_condition"))
    got = indicators.rates_by_category(pph, CODES, ["Total acute"]).collect()
    assert {r.pph_category for r in got} == {"acute"}


def test_age_trend(spark):
    rows = [("rate_crude", "Total PPH", band, code, code, year, label(year), value)
            for band, code, year, value in [("0-64", "PHN206", 2018, 10.0), ("0-64", "PHN206", 2019, 12.0),
                                            ("65+", "PHN206", 2019, 50.0), ("0-64", "PHN9", 2018, 1.0)]]
    rows.append(("count", "Total PPH", "0-64", "PHN206", "x", 2018, label(2018), 1.0))
    df = spark.createDataFrame(
        rows,
        "measure_type string, pph_condition string, demographic_group string, geography_code string, "
        "geography_name string, fy_end_year int, financial_year string, measure_value double",
    )
    got = {(r.age_group, r.fy_end_year): r for r in indicators.age_trend(df, CODES).collect()}
    assert set(got) == {("0-64", 2018), ("0-64", 2019), ("65+", 2019)}
    assert (got["0-64", 2019].change_pct_since_baseline, got["0-64", 2019].change_pct_year_on_year) == (20.0, 20.0)


def test_benchmark_drops_null_rates_before_ranking(spark):
    rows = [rate(2018, "PHN206", 50.0), rate(2018, "PHN1", 70.0), rate(2018, "PHN2", 50.0), rate(2018, "PHN3", None),
            rate(2018, "PHN4", 10.0), national(2018, 60.04), group(2018, 99.0),
            rate(2019, "PHN206", 50.0), rate(2020, "PHN206", None), national(2020, 1.0)]
    got = indicators.benchmark_unit(spark.createDataFrame(rows, RATES), CODES).collect()
    assert len(got) == 1  # 2019 has no national row, 2020 no rate
    row = got[0]
    assert (row.unit_rank_highest_first, row.unit_count, row.unit_median_rate) == (2, 4, 50.0)
    assert (row.national_rate, row.gap_to_national, row.financial_year) == (60.04, -10.0, "2017-18")


AREAS = "fy_end_year int, financial_year string, area_code string, area_name string, subregion string, rate double, flag string"


def test_area_trend_needs_both_references(spark):
    rows = [(y, label(y), c, c, "s", v, None) for y, c, v in [
        (2017, "a", 50.0), (2018, "a", 100.0), (2018, "b", 100.0), (2018, "c", 20.0), (2018, "d", None), (2019, "a", 110.0),
        (2020, "a", 150.0)]]
    refs = [rate(2018, "PHN206", 5.0), national(2018, 6.0), rate(2019, "PHN206", 5.0), national(2017, 1.0),
            rate(2020, "PHN206", None), national(2020, 7.0)]
    references = indicators.yearly_references(spark.createDataFrame(refs, RATES), CODES)
    trend = indicators.area_trend(spark.createDataFrame(rows, AREAS), references).collect()
    assert {r.fy_end_year for r in trend} == {2018, 2020}
    got = {r.area_code: r for r in trend if r.fy_end_year == 2018}
    assert {k: r.rank_highest_first for k, r in got.items()} == {"a": 1, "b": 1, "c": 3, "d": 4}
    assert (got["a"].unit_rate, got["a"].national_rate) == (5.0, 6.0)
    # 2017 has no unit row, so it is neither a row nor the baseline; a null reference is still a row.
    last = next(r for r in trend if r.fy_end_year == 2020)
    assert (last.baseline_rate, last.change_pct_since_baseline, last.unit_rate) == (100.0, 50.0, None)


def test_area_rates_join_on_the_name(spark):
    rows = [("SA3", "rate_age_standardised", "All persons", "Total PPH", 2018, "2017-18", c, n, v, None)
            for c, n, v in [("1", "Geelong", 9.0), ("2", "Elsewhere", 8.0)]]
    df = spark.createDataFrame(
        rows,
        "geography_level string, measure_type string, demographic_group string, pph_condition string, fy_end_year int, "
        "financial_year string, geography_code string, geography_name string, measure_value double, flag string",
    )
    areas = spark.createDataFrame([("Geelong", "South")], "area_name string, subregion string")
    got = indicators.area_rates(df, areas, CODES).collect()
    assert [(r.area_code, r.area_name, r.subregion, r.rate) for r in got] == [("1", "Geelong", "South", 9.0)]


def test_condition_gaps_keep_unpublished_rates_null(spark):
    rows = [(2018, "PHN206", "c1", 1.0, None), (2019, "PHN206", "c1", 10.0, None), (2019, "003REG", "c1", 12.4, None),
            (2019, "001NAT", "c1", 9.0, None), (2019, "PHN206", "c2", None, "n.p."), (2019, "001NAT", "c2", 3.0, None),
            (2019, "003REG", "c3", 3.0, None)]
    df = spark.createDataFrame(
        [(y, label(y), code, "g", c, "rate_age_standardised", "All persons", False, v, f) for y, code, c, v, f in rows],
        "fy_end_year int, financial_year string, geography_code string, pph_group string, pph_condition string, "
        "measure_type string, demographic_group string, is_group_total boolean, measure_value double, flag string",
    )
    got = {r.pph_condition: r for r in indicators.condition_gaps(df, CODES).collect()}
    assert set(got) == {"c1", "c2"}
    assert (got["c1"].unit_rate, got["c1"].gap_to_peer_group, got["c1"].gap_to_national) == (10.0, -2.0, 1.0)
    assert (got["c2"].unit_rate, got["c2"].national_rate, got["c2"].gap_to_national) == (None, 3.0, None)
    assert (got["c2"].unit_flag, got["c2"].peer_group_rate) == ("n.p.", None)


def test_area_table(spark):
    rows = [("2017-18", 2018, "SA3", "1", "Geelong", t, m, v, f) for t, m, v, f in [
        ("TC4+5", "rate", 5.0, False), ("TC4+5", "after", 2.0, True), ("All", "rate", 99.0, False), ("TC4+5", "other", 7.0, False)]]
    rows.append(("2017-18", 2018, "SA3", "2", "Elsewhere", "TC4+5", "rate", 1.0, False))
    df = spark.createDataFrame(
        rows,
        "financial_year string, fy_end_year int, geography_level string, geography_code string, geography_name string, "
        "triage_category string, measure_name string, measure_value double, is_flagged boolean",
    )
    areas = spark.createDataFrame([("Geelong", "South")], "area_name string, subregion string")
    got = rollups.area_table(df, areas, {"r": "rate", "a": "after", "n": "number"}, "SA3", "TC4+5").collect()
    assert [tuple(r) for r in got] == [("2017-18", 2018, "1", "Geelong", "South", 5.0, 2.0, None, True)]


def test_hotspots_use_the_named_baseline_year(spark):
    areas = spark.createDataFrame(
        [(label(y), y, c, f"area {c}", "s", v, v, 1.0, 1.0, False) for y, c, v in [
            (2017, "a", 1.0), (2018, "a", 50.0), (2019, "a", 60.0), (2018, "b", 90.0), (2019, "b", 80.0),
            (2019, "late", 99.0), (2018, "gone", 1.0), (2018, "c", None), (2019, "c", 60.0)]],
        "financial_year string, fy_end_year int, area_code string, area_name string, subregion string, "
        "rate_age_standardised double, after_hours_rate_age_standardised double, lower_urgency_presentations double, "
        "population double, is_flagged boolean",
    )
    references = spark.createDataFrame([(2018, 1.0, 1.0), (2019, 40.0, 55.0)], "fy_end_year int, unit_rate double, national_rate double")
    services = spark.createDataFrame([("area a", "Clinic"), ("area a", "Clinic"), ("area a", "x")], "area_name string, service_type string")
    df = indicators.area_hotspots(areas, references, services, {"clinics": "Clinic", "nights": "Night"}, Params(baseline_fy=2018))
    got = {r.area_code: r for r in df.collect()}
    assert set(got) == {"a", "b", "c"}
    assert (got["a"].baseline_rate, got["a"].change_pct_since_baseline, got["a"].ratio_to_unit) == (50.0, 20.0, 1.5)
    assert [got[k].is_hotspot for k in "abc"] == [True, False, None]
    assert [got[k].rank_highest_first for k in "abc"] == [2, 1, 2]
    assert [(got[k].clinics, got[k].nights) for k in "ab"] == [(2, 0), (0, 0)]


def test_peers_count_null_rates_and_rank_them_last(spark):
    one = [rate(2018, "PHN1", 9.0), rate(2019, "PHN1", 3.0), rate(2019, "PHN206", 3.0), rate(2019, "PHN2", None),
           rate(2019, "PHN3", 7.0), rate(2019, "PHN4", 1.0, group="Metropolitan"), national(2019, 6.0), group(2019, 5.0)]
    two = [rate(2018, "PHN1", 8.0), national(2018, 4.0), group(2018, 2.0)]
    three = [rate(2018, "PHN1", 8.0), national(2018, 4.0)]
    df = indicators.peer_comparison([trend(spark, one, "ONE"), trend(spark, two, "TWO"), trend(spark, three, "THREE")], CODES)
    got = {(r.indicator_code, r.geography_code): r for r in df.collect()}
    assert set(got) == {("ONE", c) for c in ("PHN1", "PHN206", "PHN2", "PHN3")} | {("TWO", "PHN1")}
    assert [got["ONE", c].rank_lowest_first for c in ("PHN1", "PHN206", "PHN3", "PHN2")] == [1, 1, 3, 4]
    assert {(r.peer_count, r.peer_median) for k, r in got.items() if k[0] == "ONE"} == {(4, 3.0)}
    assert (got["ONE", "PHN1"].peer_group_rate, got["ONE", "PHN1"].national_rate) == (5.0, 6.0)
    assert got["TWO", "PHN1"].financial_year == "2017-18"


def test_criteria(spark):
    unit = [100.0, 90.0, 92.0, 91.9, None, 50.0]
    nation = [100.0, 95.0, 95.0, 93.0, 93.0, 40.0]
    rows = [rate(2018 + i, "PHN206", v) for i, v in enumerate(unit)] + [national(2018 + i, v) for i, v in enumerate(nation)]
    other = [national(2018, 100.0), national(2019, 99.0), national(2020, 98.95), rate(2019, "PHN206", 1.0)]
    df = indicators.criteria_check(trend(spark, rows, "IM-02"), trend(spark, other, "IM-01"), Params())
    got = {(r.indicator_code, r.criterion_level, r.fy_end_year): r for r in df.collect()}
    assert df.count() == len(got)
    status = {k: r.pack_status for k, r in got.items()}
    assert status["IM-02", "PHN", 2019] == "Met"  # -10 against -5
    assert status["IM-02", "PHN", 2020] == "Watch"  # 2.2 against 0, but -8 against -5 since baseline
    assert status["IM-02", "PHN", 2021] == "Watch"
    # No rate in 2022, so no change in 2022 or 2023.
    assert ("IM-02", "PHN", 2022) not in got and ("IM-02", "PHN", 2023) not in got
    assert status["IM-02", "National", 2020] == "Not met"
    assert status["IM-01", "National", 2019] == "Met"  # exactly one percent
    assert status["IM-01", "National", 2020] == "Not met"  # -0.05 rounds to -0.1
    assert ("IM-01", "PHN", 2019) not in got
    assert [k for k, r in got.items() if r.is_latest_year] == [
        k for k in got if k in {("IM-02", "PHN", 2021), ("IM-02", "National", 2023), ("IM-01", "National", 2020)}
    ]
    row = got["IM-02", "National", 2019]
    assert (row.unit_value, row.is_met_since_baseline, row.national_value) == (None, None, 95.0)


def test_feeds(spark):
    benchmark = spark.createDataFrame(
        [("2018-19", 2019, 2.0, 3.0), ("2017-18", 2018, 4.0, 5.0)],
        "financial_year string, fy_end_year int, unit_rate double, national_rate double",
    )
    assert [tuple(r) for r in feeds.latest_national_rate(benchmark).collect()] == [(3.0,)]
    assert [r.financial_year for r in feeds.benchmark_feed(benchmark).collect()] == ["2017-18", "2018-19"]
    areas = spark.createDataFrame(
        [(2018, "a", 1.0), (2019, "b", 9.0), (2019, "c", None), (2019, "d", 2.0)],
        "fy_end_year int, area_name string, rate_age_standardised double",
    ).withColumns({"subregion": F.lit("s"), "financial_year": F.lit("y")})
    assert [r.area_name for r in feeds.latest_area_feed(areas).collect()] == ["d", "b", "c"]


@pytest.mark.parametrize("name", ["area_trend", "area_hotspots"])
def test_areas_are_never_ranked_in_one_task(spark, sf_dir, name):
    from tallymart.plans.catalogue import QUERIES

    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert all("_slice" in line for line in plan.splitlines() if "rank(" in line)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_an_area_with_two_names_has_a_row_for_each(spark):
    rows = [(2018, "x", "One", 10.0), (2020, "x", "One", 12.0), (2020, "x", "Two", 30.0), (2020, "y", "New", 5.0)]
    areas = spark.createDataFrame(rows, "fy_end_year int, area_code string, area_name string, rate_age_standardised double")
    areas = areas.selectExpr("*", "'l' AS financial_year", "'s' AS subregion", "1.0D AS after_hours_rate_age_standardised", "false AS is_flagged")
    references = spark.createDataFrame([(2018, 9.0, 9.0), (2020, 11.0, 10.0)], "fy_end_year int, unit_rate double, national_rate double")
    services = spark.createDataFrame([("Two", "Clinic")], "area_name string, service_type string")
    got = indicators.area_hotspots(areas, references, services, {"clinics": "Clinic"}, Params(baseline_fy=2018)).collect()
    assert {(r.area_name, r.rate, r.baseline_rate, r.rank_highest_first, r.clinics) for r in got} == {
        ("One", 12.0, 10.0, 2, 0), ("Two", 30.0, 10.0, 1, 1)
    }


def test_a_condition_without_a_group_stands_beside_nothing(spark):
    rows = [(None, "U", 5.0), (None, "N", 3.0), ("g", "U", 5.0), ("g", "N", 3.0)]
    table = spark.createDataFrame(rows, "pph_group string, geography_code string, measure_value double").selectExpr(
        "*", "'c' AS pph_condition", "2020 AS fy_end_year", "'l' AS financial_year", "'rate_age_standardised' AS measure_type",
        "'All persons' AS demographic_group", "false AS is_group_total", "cast(null AS string) AS flag",
    )
    codes = replace(Params().codes, unit="U", national="N", peer_group="P")
    got = {r.pph_group: (r.unit_rate, r.national_rate, r.gap_to_national) for r in indicators.condition_gaps(table, codes).collect()}
    assert got == {None: (5.0, None, None), "g": (5.0, 3.0, 2.0)}
