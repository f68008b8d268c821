import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallymart.operators import cleaning
from tallymart.operators.scoping import IncompleteRelease, ScopeSpec, missing_required, require_complete, scope_release
from tallymart.operators.profiling import profile
from tallymart.plans import packs

ED_COLUMNS = (
    "Code DataSource Name Worksheet Year StateTerritory GeographicUnit GeographicCode GeographicAreaName "
    "GeographicGroup DemographicGroup HourED TriageCategory MeasureName MeasureValue Flag FlagExplanation"
).split()
PPH_COLUMNS = (
    "Code DataSource Name Worksheet Year StateTerritory GeographicUnit GeographicCode GeographicAreaName "
    "GeographicGroup DemographicGroup PPHGroup PPHCondition MeasureName MeasureValue Flag FlagExplanation"
).split()


def release(spark, columns, rows):
    base = dict.fromkeys(columns)
    return spark.createDataFrame([tuple((base | r)[c] for c in columns) for r in rows], ", ".join(f"{c} string" for c in columns))


def ed_row(**changes):
    row = dict(
        Code="c", DataSource="d", Name="n", Worksheet="Table1", Year="2017–18", StateTerritory="Vic",
        GeographicUnit="PHN", GeographicCode="PHN1", GeographicAreaName="Unit one", GeographicGroup="Regional",
        DemographicGroup="All persons", HourED="All-hours", TriageCategory="TC4+5",
        MeasureName=packs.ALL_HOURS_RATE, MeasureValue="10.5",
    )
    return row | changes


def pph_row(**changes):
    row = ed_row(PPHGroup="Total", PPHCondition="Total PPH", MeasureName=next(iter(packs.PPH_MEASURES)))
    return {k: v for k, v in row.items() if k in PPH_COLUMNS} | changes


def test_ed_indicator(spark):
    nation = dict(GeographicUnit="NAT", GeographicCode="001NAT", GeographicAreaName="National", StateTerritory="")
    rows = [ed_row(Worksheet=f"Table{i}", **nation) for i in (4, 2, 1, 3)]
    rows += [
        ed_row(StateTerritory="Vic/NSW", MeasureValue="2"),
        ed_row(StateTerritory="Vic", MeasureValue="1"),
        ed_row(StateTerritory="", MeasureValue="3"),
        ed_row(GeographicCode="003MET", HourED=""),
        ed_row(GeographicCode="003REG", MeasureValue="n.p.", Flag="#", FlagExplanation="why"),
        ed_row(GeographicUnit="SA3", GeographicCode="20101", MeasureName="Number total ED", MeasureValue="1,234"),
        ed_row(GeographicUnit="SA3", GeographicCode="20102", MeasureName=packs.POPULATION),
        ed_row(GeographicUnit="SA3", GeographicCode="20103", MeasureName="All-hours ED, per 1,000 population"),
        ed_row(GeographicUnit="SA3", GeographicCode="20104", MeasureName="Something else"),
    ]
    clean = cleaning.clean_indicator(release(spark, ED_COLUMNS, rows), packs.ED_SPEC)
    got = {r.geography_code: r for r in clean.collect()}
    assert clean.count() == len(got) == 8
    assert (got["001NAT"].geography_level, got["001NAT"].state) == ("National", None)
    assert (got["PHN1"].state, got["PHN1"].measure_value) == ("Vic", 1.0)
    assert got["PHN1"].fy_end_year == 2018
    assert (got["003MET"].geography_level, got["003MET"].hour_band) == ("PHN group", "Not applicable")
    assert (got["003REG"].measure_value, got["003REG"].is_flagged, got["003REG"].flag_explanation) == (None, True, "why")
    assert (got["20101"].measure_type, got["20101"].measure_value, got["20101"].is_flagged) == ("count", None, False)
    assert [got[c].measure_type for c in ("20102", "20103", "20104")] == ["population", "rate_crude", None]
    assert got["PHN1"].measure_type == "rate_age_standardised"


def test_either_name_of_the_hour_column(spark):
    raw = release(spark, ED_COLUMNS, [ed_row()])
    other = raw.withColumnRenamed("HourED", "HourEDpresentation")
    first = cleaning.clean_indicator(raw, packs.ED_SPEC).collect()
    assert first == cleaning.clean_indicator(other, packs.ED_SPEC).collect()
    with pytest.raises(ValueError):
        cleaning.clean_indicator(raw.drop("HourED"), packs.ED_SPEC)


def test_pph_indicator_key_has_no_level(spark):
    rows = [
        pph_row(GeographicUnit="SA3", MeasureValue="2", StateTerritory="Vic/NSW"),
        pph_row(GeographicUnit="PHN", MeasureValue="1"),
        pph_row(PPHCondition="Cellulitis", MeasureValue="-", Flag="-"),
    ]
    got = cleaning.clean_indicator(release(spark, PPH_COLUMNS, rows), packs.PPH_SPEC).collect()
    by_condition = {r.pph_condition: r for r in got}
    assert len(got) == 2
    assert (by_condition["Total PPH"].measure_value, by_condition["Total PPH"].is_group_total) == (1.0, True)
    assert (by_condition["Cellulitis"].flag, by_condition["Cellulitis"].is_group_total) == ("-", False)
    assert by_condition["Cellulitis"].measure_value is None


def test_scope_keeps_named_areas_of_the_state(spark):
    area = dict(GeographicUnit="SA3", GeographicAreaName="Creswick - Daylesford - Ballan")
    rows = [
        ed_row(),
        ed_row(GeographicUnit="NAT"),
        ed_row(**area, GeographicCode="in"),
        ed_row(**(area | {"GeographicAreaName": "Creswick – Daylesford – Ballan"}), GeographicCode="dash"),
        ed_row(**area, GeographicCode="state", StateTerritory="Vic/NSW"),
        ed_row(**area, GeographicCode="nostate", StateTerritory=None),
        ed_row(**(area | {"GeographicAreaName": "Elsewhere"}), GeographicCode="name"),
        ed_row(GeographicUnit="RA"),
        ed_row(DemographicGroup="Male"),
        ed_row(DemographicGroup=None),
        ed_row(TriageCategory="TC3"),
        ed_row(MeasureName="Number of beds"),
    ]
    scoped = scope_release(release(spark, ED_COLUMNS, rows), packs.ED_SCOPE)
    assert {"Code", "DataSource", "Name"}.isdisjoint(scoped.columns)
    got = scoped.collect()
    assert sorted(r.GeographicCode for r in got) == ["PHN1", "PHN1", "dash", "in"]
    assert {r.Year for r in got} == {"2017-18"}
    assert {r.GeographicAreaName for r in got if r.GeographicUnit == "SA3"} == {"Creswick - Daylesford - Ballan"}


def test_scope_with_age_bands(spark):
    rows = [
        pph_row(GeographicCode="a"),
        pph_row(GeographicCode="b", DemographicGroup="0–64"),
        pph_row(GeographicCode="c", DemographicGroup="0\u009664"),
        pph_row(GeographicCode="d", DemographicGroup="65+"),
        pph_row(GeographicCode="e", DemographicGroup="65+", PPHCondition="Cellulitis"),
        pph_row(GeographicCode="f", DemographicGroup="65+", PPHCondition=None),
        pph_row(GeographicCode="g", PPHCondition="Cellulitis"),
        pph_row(GeographicCode="h", GeographicUnit="SA3", GeographicAreaName="Geelong", StateTerritory="Vic/NSW"),
        pph_row(GeographicCode="i", GeographicUnit="SA3", GeographicAreaName="Geelong", StateTerritory=None),
    ]
    got = scope_release(release(spark, PPH_COLUMNS, rows), packs.PPH_SCOPE).collect()
    assert sorted(r.GeographicCode for r in got) == list("abcdgh")
    assert {r.DemographicGroup for r in got} == {"All persons", "0-64", "65+"}


def test_completeness(spark):
    spec = ScopeSpec(
        measures=(packs.ALL_HOURS_RATE, packs.POPULATION), areas=("Geelong",), wide_levels=("PHN",),
        area_level="SA3", state="Vic", required_codes=("PHN1", "PHN2"),
    )
    scoped = scope_release(release(spark, ED_COLUMNS, [ed_row(), ed_row(GeographicAreaName="Geelong")]), spec)
    # 'Geelong' as the name of a unit is not the area.
    assert {tuple(r) for r in missing_required(scoped, spec).collect()} == {
        ("measure", packs.POPULATION), ("area", "Geelong"), ("code", "PHN2"),
    }
    with pytest.raises(IncompleteRelease, match="PHN2"):
        require_complete(scoped, spec)
    whole = [
        ed_row(), ed_row(GeographicCode="PHN2", MeasureName=packs.POPULATION),
        ed_row(GeographicUnit="SA3", GeographicAreaName="Geelong"),
    ]
    complete = scope_release(release(spark, ED_COLUMNS, whole), spec)
    assert require_complete(complete, spec) is complete


def test_scope_reaches_the_parquet_scan(spark, tmp_path, capsys):
    path = str(tmp_path / "release")
    release(spark, ED_COLUMNS, [ed_row()]).write.parquet(path)
    scoped = scope_release(spark.read.parquet(path), packs.ED_SCOPE).select("Year", "MeasureValue")
    scoped.explain("formatted")
    plan = capsys.readouterr().out
    pushed = next(line for line in plan.splitlines() if line.startswith("PushedFilters"))
    assert "EqualTo(DemographicGroup,All persons)" in pushed and "In(GeographicUnit, [NAT,PHN])" in pushed
    assert "FlagExplanation" not in next(line for line in plan.splitlines() if line.startswith("ReadSchema"))


def test_scope_with_age_bands_reaches_the_scan(spark, tmp_path, capsys):
    path = str(tmp_path / "release")
    release(spark, PPH_COLUMNS, [pph_row()]).write.parquet(path)
    scope_release(spark.read.parquet(path), packs.PPH_SCOPE).explain("formatted")
    pushed = next(line for line in capsys.readouterr().out.splitlines() if line.startswith("PushedFilters"))
    assert "StringContains(StateTerritory,Vic)" in pushed and "StringStartsWith(PPHCondition,Total)" in pushed


def test_profile_counts_null_as_a_value_and_cuts_at_k(spark):
    rows = [("x", str(i)) for i in range(5)] + [(None, "0"), (None, "0")]
    got = profile(spark.createDataFrame(rows, "a string, b string"), ["a", "b"], k=3).collect()
    a = sorted(((r.value_rank, r.value, r.n, r.distinct_values, r.total_rows) for r in got if r.column_name == "a"))
    assert a == [(1, "x", 5, 2, 7), (2, None, 2, 2, 7)]
    b = sorted((r.value_rank, r.value, r.n, r.distinct_values) for r in got if r.column_name == "b")
    assert b == [(1, "0", 3, 5), (2, "1", 1, 5), (3, "2", 1, 5)]


def test_service_tables(spark):
    raw = spark.createDataFrame(
        [("e1", "c", "p", "2026-01-05", None, None, "Open", "Yes", "12-17", "F", "n", "3", "S")],
        "episode_id string, client_key string, provider_code string, referral_date string, first_contact_date string, "
        "episode_end_date string, completion_status string, suicide_risk_referral string, age_group string, "
        "sex string, indigenous_status string, iar_level string, data_source string",
    )
    row = cleaning.clean_episodes(raw).first()
    assert (row.referral_date, row.first_contact_date, row.is_suicide_risk_referral, row.iar_level) == (
        dt.date(2026, 1, 5), None, True, 3,
    )
    with pytest.raises(PySparkException):
        cleaning.clean_episodes(raw.withColumn("iar_level", F.lit("high"))).collect()
    measures = spark.createDataFrame(
        [("m", "e", "K10+", o, "2026-01-05", "20") for o in ("Episode start", "Episode end", "Review")],
        "measure_id string, episode_id string, measure string, collection_occasion string, collection_date string, score string",
    )
    assert [r.collection_occasion for r in cleaning.clean_measures(measures).collect()] == ["start", "end", None]


def test_profile_of_long_values_fetches_the_most_frequent(spark):
    rows = [("b" * 5000, 1)] * 3 + [("a" * 5000, 1)] * 2 + [(None, 2)] * 4 + [(f"once {k}", 3) for k in range(90)]
    df = spark.createDataFrame(rows, "text string, n int").repartition(6)
    plain = {(r.column_name, r.value): r.n for r in profile(df, ["text", "n"], k=200).collect()}
    got = profile(df, ["text", "n"], k=60, long=["text"]).collect()
    assert {(r.column_name, r.value): r.n for r in got}.items() <= plain.items()
    texts = sorted((r for r in got if r.column_name == "text"), key=lambda r: r.value_rank)
    assert [r.n for r in texts] == [4, 3, 2] + [1] * 57 and texts[0].value is None and texts[1].value == "b" * 5000
    assert {(r.column_name, r.distinct_values, r.total_rows) for r in got} == {("text", 93, 99), ("n", 3, 99)}
    first = profile(df, ["text"], long=["text"])._jdf.queryExecution().executedPlan().toString()
    assert "md5" in first
    with pytest.raises(ValueError):
        profile(df, ["n"], long=["text"])
