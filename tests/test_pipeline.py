"""Sources, sinks and the whole build on a small invented pack."""

import csv
import datetime as dt
import glob
import os
from dataclasses import replace
from types import SimpleNamespace

import pytest

from tallymart import Params
from tallymart.operators.fact import build_episode_fact
from tallymart.operators.quality import QualityGateError, drift
from tallymart.operators.rollups import pivot_outcomes, rollup_contacts
from tallymart.operators.scoping import IncompleteRelease, scope_release
from tallymart.plans import packs, pipeline
from tallymart.session import _shared_folder, materialise, shuffle_settings
from tallymart.sources import schemas
from tallymart.sources.readers import read_csv, read_mart, read_release, read_text
from tallymart.sources.writers import current_version, publish_table, swap_version, write_extract, write_version

AREAS = ("Geelong", "Grampians")
YEARS = range(2018, 2021)


def write(path, header, rows, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="", encoding=encoding) as out:
        writer = csv.writer(out)
        writer.writerow(header)
        writer.writerows(rows)
    return path


RELEASE_HEAD = ["Worksheet", "Year", "StateTerritory", "GeographicUnit", "GeographicCode", "GeographicAreaName",
                "GeographicGroup", "DemographicGroup"]
RELEASE_TAIL = ["MeasureName", "MeasureValue", "Flag", "FlagExplanation"]
GEOGRAPHIES = [("NAT", "001NAT", "National", "National", "")] + [
    ("PHN", code, name, group, "Vic")
    for code, name, group in [
        ("PHN206", "Unit", "Regional"), ("PHN204", "Other", "Regional"), ("PHN101", "City", "Metropolitan"),
        ("003REG", "Regional", "PHN group"),
    ]
] + [("SA3", f"2{i}", area, "Area", "Vic") for i, area in enumerate(AREAS)]


def ed_rows():
    for year in YEARS:
        label = f"{year - 1}-{year % 100}"
        for i, (unit, code, name, group, state) in enumerate(GEOGRAPHIES):
            for sheet in ("Table1", "Table2") if unit == "NAT" else ("Table3",):
                for m, measure in enumerate(packs.ED_SCOPE.measures):
                    band = measure.split(" lower")[0] if m < 3 else ""
                    value = 100 + 10 * i + m + (2020 - year) * (3 + i)
                    yield [sheet, label, state, unit, code, name, group, "All persons", band, "TC4+5", measure, value, "", ""]


def pph_rows():
    for year in YEARS:
        label = f"{year - 1}-{year % 100}"
        for i, (unit, code, name, group, state) in enumerate(GEOGRAPHIES):
            conditions = [("Total", t) for t in packs.PPH_TOTALS] + [("Acute", "Cellulitis")]
            for c, (kind, condition) in enumerate(conditions):
                for people in ("All persons", "0-64", "65+") if c == 0 else ("All persons",):
                    for measure in packs.PPH_MEASURES:
                        missing = condition == "Cellulitis" and unit == "PHN"
                        value = "n.p." if missing else 2000 + 50 * i + 7 * c + (2020 - year) * 40
                        yield ["Table1", label, state, unit, code, name, group, people, kind, condition, measure, value,
                               "n.p." if missing else "", ""]


@pytest.fixture(scope="module")
def folders(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    service, seeds = str(root / "service"), str(root / "seeds")
    write(f"{service}/dim_provider.csv", schemas.PROVIDERS.fieldNames(),
          [[p, s, "Low intensity", 100, p, "SYNTHETIC"] for p, s in [("A", "North"), ("B", "South"), ("C", "South")]])
    write(f"{service}/dim_subregion.csv", schemas.SUBREGIONS.fieldNames(), [["North", "R", 1000, "X"], ["South", "R", 2000, "Y"]])
    write(f"{service}/map_sa3_subregion.csv", schemas.AREA_MAP.fieldNames(), [["Geelong", "South"], ["Grampians", "North"]])
    episodes, contacts, measures = [], [], []
    for i in range(24):
        key, referral = f"E{i:02d}", dt.date(2026, 1 + i % 6, 3)
        first = referral + dt.timedelta(i % 12)
        done = i % 3 == 0
        episodes.append([key, f"c{i % 9}", "AB"[i % 2], referral, first, first + dt.timedelta(5) if done else "",
                         "Treatment concluded" if done else "Open", "Yes" if i % 4 == 0 else "No", "25-64", "F", "n", 1 + i % 5,
                         "SYNTHETIC"])
        contacts.append([f"{key}-1", key, first, "Phone", 30, "Yes"])
        measures.append([f"{key}-s", key, "K10+", "Episode start", first, 30])
        if done:
            measures.append([f"{key}-e", key, "K10+", "Episode end", first, 20])
    write(f"{service}/fact_episode.csv", schemas.EPISODES.fieldNames(), episodes)
    write(f"{service}/fact_service_contact.csv", schemas.CONTACTS.fieldNames(), contacts)
    write(f"{service}/fact_outcome_measure.csv", schemas.MEASURES.fieldNames(), measures)
    write(f"{seeds}/service_locations.csv", schemas.SERVICE_LOCATIONS.fieldNames(),
          [["Medicare Urgent Care Clinic", "Town", "1, \"Main\" St", "Geelong", "op", "url", "2026-01-01"]])
    write(f"{seeds}/published_reference_values.csv", schemas.PUBLISHED_VALUES.fieldNames(),
          [["IM-02", "PHN206", 2020, "All-hours", 110.0, "s"], ["IM-01", "001NAT", 2020, "PPH", 2000.04, "s"]])
    write(f"{seeds}/framework_indicator_spec.csv", schemas.INDICATOR_SPECS.fieldNames(), [["IM-01"] + ["t, x"] * 12])
    ed = write(str(root / "ed.csv"), RELEASE_HEAD + ["HourEDpresentation", "TriageCategory"] + RELEASE_TAIL, ed_rows())
    pph = write(str(root / "pph.csv"), RELEASE_HEAD + ["PPHGroup", "PPHCondition"] + RELEASE_TAIL, pph_rows())
    return service, seeds, ed, pph


def checks(params):
    return pipeline.mart_checks(params, units=3, peers=2, band_rows=18, category_rows=24)


def test_build_writes_checks_and_exports(spark, folders, tmp_path):
    params = Params()
    raw = pipeline.read_raw(spark, *folders)
    marts = pipeline.build(spark, raw, params, str(tmp_path / "out"), checks_on_marts=checks(params))
    assert {name: df.count() for name, df in marts.items()} == {
        "dim_provider": 3, "dim_subregion": 2, "fct_episode": 24, "kpi_provider_quarterly": 6,
        "kpi_provider_scorecard": 3, "subregion_service_reach": 2, "lower_urgency_ed_benchmark": 3,
        "lower_urgency_ed_sa3": 6, "im02_lower_urgency": 45, "im01_pph": 60, "im01_sa3": 6, "im01_conditions": 1,
        "im01_age": 18, "im02_sa3_hotspots": 2, "peer_comparison": 4, "criteria_check": 6,
    }
    assert read_mart(spark, "fct_episode").count() == 24
    other = spark.newSession()
    assert read_mart(other, "episode_contacts", layer="intermediate").count() == 24
    assert read_mart(other, "episode_outcomes", layer="intermediate").where("has_end_measure").count() == 8
    assert read_mart(other, "service_locations", layer="reference").count() == 1
    assert {row.name for row in other.catalog.listTables("intermediate")} == {"episode_contacts", "episode_outcomes"}
    assert spark.table("staging.episodes").count() == 24
    card = {r.provider_code: r for r in marts["kpi_provider_scorecard"].collect()}
    assert (card["A"].outcome_collection_rate, card["C"].referrals) == (1.0, None)
    gap = marts["im01_conditions"].first()
    assert (gap.unit_rate, gap.unit_flag, gap.gap_to_national) == (None, "n.p.", None)
    assert set(os.listdir(tmp_path / "out")) == set(packs.EXPORTS)
    parts = sorted(glob.glob(f"{tmp_path}/out/im01_sa3/*.csv"))
    exported = [row for part in parts for row in csv.DictReader(open(part, encoding="utf-8"))]
    assert [(r["sa3_name"], r["fy_end_year"]) for r in exported] == [(a, str(y)) for a in AREAS for y in YEARS]
    header = open(glob.glob(f"{tmp_path}/out/im02_sa3/*.csv")[0], encoding="utf-8").readline().strip().split(",")
    assert header[:5] == ["financial_year", "fy_end_year", "sa3_code", "sa3_name", "subregion"]
    drifted = pipeline.export_drift(spark, str(tmp_path / "out"))
    assert {name: df.count() for name, df in drifted.items()} == dict.fromkeys(packs.EXPORTS, 0)
    publish_table(marts["im01_age"].filter("age_group = '65+'"), "marts", "fewer")
    fewer = pipeline.export_drift(spark, str(tmp_path / "out"), {"im01_age": replace(packs.EXPORTS["im01_age"], table="fewer")})
    assert {r.side for r in fewer["im01_age"].collect()} == {"committed only"}
    assert fewer["im01_age"].count() == 9


def test_bucketed_episode_tables_join_without_a_shuffle(spark, folders):
    raw = pipeline.read_raw(spark, *folders)
    params = Params()
    plain = pipeline.build(spark, raw, params, staging_tables=False, checks_on_marts=checks(params))
    before = [df.orderBy(*df.columns).collect() for df in plain.values()]
    marts = pipeline.build(spark, raw, params, episode_buckets=4, checks_on_marts=checks(params))
    assert [df.orderBy(*df.columns).collect() for df in marts.values()] == before
    episodes, contacts, measures = (spark.table(f"staging.{n}") for n in pipeline.EPISODE_TABLES)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = build_episode_fact(episodes, pivot_outcomes(measures), rollup_contacts(contacts), params)
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_full_releases_give_the_extracts(spark, folders, tmp_path):
    def full(name, source, outside):
        """The extract's rows as published, among rows out of scope."""
        with open(source, encoding="utf-8") as lines:
            header, *rows = list(csv.reader(lines))
        rows = [row[:1] + [row[1].replace("-", "–")] + row[2:] for row in rows]
        rows += [row[:7] + ["Male"] + row[8:] for row in rows] + [row[:3] + [outside] + row[4:] for row in rows]
        path = str(tmp_path / name)
        return write(path, ["Code", "DataSource", "Name"] + header, [["c", "d", "n"] + row for row in rows], "cp1252")

    _, _, ed, pph = folders
    paths = full("ed.csv", ed, "RA"), full("pph.csv", pph, "SEIFA")
    scopes = replace(packs.ED_SCOPE, areas=AREAS), replace(packs.PPH_SCOPE, areas=AREAS)
    got = pipeline.read_releases(spark, *paths, *scopes)
    for name, path in ((pipeline.ED, ed), (pipeline.PPH, pph)):
        expected = read_text(spark, path)
        assert got[name].columns == expected.columns
        assert drift(expected, got[name]).count() == 0
    with pytest.raises(IncompleteRelease, match="Warrnambool"):
        pipeline.read_releases(spark, *paths)


def test_a_failing_check_stops_the_build(spark, folders):
    raw = pipeline.read_raw(spark, *folders)
    doubled = raw | {"fact_service_contact": raw["fact_service_contact"].union(raw["fact_service_contact"])}
    with pytest.raises(QualityGateError, match="one_contact_per_episode_day.*unique_contacts_contact_id"):
        pipeline.build(spark, doubled, Params())
    params = Params(tolerance=0.01)
    with pytest.raises(QualityGateError, match="^reconciles_to_published: 1 failing rows$"):
        pipeline.build(spark, raw, params, checks_on_marts=checks(params))


def test_failing_checks_keep_their_tables_and_those_that_read_them(spark, folders, tmp_path):
    raw, params = pipeline.read_raw(spark, *folders), Params()
    pipeline.build(spark, raw, params, checks_on_marts=checks(params))
    names = [mart.name for mart in pipeline.MARTS]
    before = {name: current_version(spark, "marts", name) for name in names}
    rows = read_mart(spark, "fct_episode").orderBy("episode_id").collect()
    episodes = raw["fact_episode"]
    doubled = raw | {"fact_episode": episodes.union(episodes.where("episode_id = 'E03'"))}
    wrong = [replace(c, failing=lambda t: t["im01_pph"]) if c.name == "pph_rows_complete" else c for c in checks(params)]
    message = "^pph_rows_complete: 60 failing rows; unique_episodes_episode_id: 1 failing rows$"
    with pytest.raises(QualityGateError, match=message) as error:
        pipeline.build(spark, doubled, params, str(tmp_path / "out"), checks_on_marts=wrong)
    kept = {"fct_episode", "kpi_provider_quarterly", "kpi_provider_scorecard", "subregion_service_reach"}
    kept |= {"im01_sa3", "peer_comparison", "criteria_check"}
    assert error.value.held == ("episodes", "im01_pph") and set(error.value.skipped) == kept
    after = {name: current_version(spark, "marts", name) for name in names}
    assert {name for name in names if after[name] == before[name]} == {"im01_pph", *kept}
    other = spark.newSession()
    assert read_mart(other, "fct_episode").orderBy("episode_id").collect() == rows
    assert read_mart(other, "kpi_provider_scorecard").count() == 3
    assert read_mart(other, "episodes", layer="staging").count() == 24
    exported = {packs.EXPORTS[name].table for name in os.listdir(tmp_path / "out")}
    assert exported and not exported & {"im01_pph", *kept}

    # The next good run replaces them, and leaves no more than two versions of each.
    pipeline.build(spark, raw, params, checks_on_marts=checks(params))
    assert all(current_version(spark, "marts", name) not in (before[name], after[name]) for name in names)
    left = [row.tableName for row in spark.sql("SHOW TABLES IN marts LIKE 'fct_episode__v_*'").collect()]
    assert current_version(spark, "marts", "fct_episode") in left and before["fct_episode"] in left and len(left) == 2


def test_marts_stand_behind_what_they_read():
    seen = set()
    for wave in pipeline.mart_waves():
        assert not {i for m in wave for i in m.inputs} & {m.name for m in wave}
        assert {i for m in wave for i in m.inputs if i in {x.name for x in pipeline.MARTS}} <= seen
        seen |= {m.name for m in wave}
    assert len(seen) == 16


def test_a_plain_table_makes_way_for_a_version(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS marts")
    publish_table(spark.range(3), "marts", "moved")
    assert current_version(spark, "marts", "moved") is None and current_version(spark, "marts", "none") is None
    write_version(spark.range(5), "marts", "moved", "a")
    assert swap_version(spark, "marts", "moved", "a").count() == 5
    assert current_version(spark, "marts", "moved") == "moved__v_a"


def test_declared_check_counts():
    params = Params()
    names = [c.name for c in pipeline.staging_checks(params) + pipeline.mart_checks(params)]
    assert len(names) == len(set(names)) == 88


def test_windows_1252_release(spark, tmp_path):
    columns = ["Code", "DataSource", "Name"] + RELEASE_HEAD + ["PPHGroup", "PPHCondition"] + RELEASE_TAIL
    row = ["c", "d", "n", "Table1", "2017–18", "", "NAT", "001NAT", "National", "National", "0–64", "Total", "Total PPH",
           packs.PPH_SCOPE.measures[1], "5", "", "‘n.p.’ – not published… €"]
    path = write(str(tmp_path / "release.csv"), columns, [row], encoding="cp1252")
    release = read_release(spark, path)
    assert list(release.first()) == [value or None for value in row]
    scoped = scope_release(release, packs.PPH_SCOPE)
    got = scoped.first()
    assert (got.Year, got.DemographicGroup, got.StateTerritory, got.Flag) == ("2017-18", "0-64", None, None)
    assert write_extract(scoped, str(tmp_path / "extract"), "csv") == 1
    assert read_text(spark, str(tmp_path / "extract")).collect() == scoped.collect()
    assert write_extract(scoped, str(tmp_path / "parquet")) == 1


def test_missing_marks_and_line_breaks_of_a_release(spark, tmp_path):
    path = write(str(tmp_path / "r.csv"), ["a", "b", "c"], [["NA", "n.p.", "-"], ["n/a", "None", "x"], ["one\ntwo", "NaN", ""]])
    assert [tuple(r) for r in read_release(spark, path, multi_line=True).collect()] == [
        (None, "n.p.", "-"), (None, None, "x"), ("one\ntwo", None, None),
    ]


def test_a_different_header_is_an_error(spark, tmp_path):
    path = write(str(tmp_path / "x.csv"), ["subregion", "sa3_name"], [["a", "b"]])
    with pytest.raises(Exception, match="header does not conform"):
        read_csv(spark, path, schemas.AREA_MAP).collect()


def test_codes_stay_text(spark, tmp_path):
    path = write(str(tmp_path / "x.csv"), ["sa3_name", "subregion"], [["001NAT", ""], ["007", "x"]])
    assert [tuple(r) for r in read_csv(spark, path, schemas.AREA_MAP).collect()] == [("001NAT", None), ("007", "x")]


def test_partitioned_marts_prune(spark, capsys):
    spark.sql("CREATE DATABASE IF NOT EXISTS marts")
    df = spark.createDataFrame([(2018, 1.0), (2019, 2.0)], "fy_end_year int, rate double")
    table = publish_table(df, "marts", "pruned", partition_by=("fy_end_year",))
    table.filter("fy_end_year = 2019").explain("formatted")
    assert "PartitionFilters: [isnotnull(fy_end_year" in capsys.readouterr().out
    assert table.filter("fy_end_year = 2019").count() == 1
    with pytest.raises(ValueError):
        publish_table(df, "marts", "x", bucket_by="rate")


def test_materialise_keeps_rows_and_schema(spark):
    df = spark.range(5).selectExpr("id", "cast(id as string) as s")
    kept = materialise(df)
    assert kept.schema.simpleString() == df.schema.simpleString() and kept.exceptAll(df).count() == 0
    assert "Range" not in kept._jdf.queryExecution().executedPlan().toString()
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert folder.removeprefix("file:") in kept.inputFiles()[0]


def test_shuffles_are_sized_by_their_bytes():
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert shuffle_settings(1)[initial] == "200"
    assert shuffle_settings(10 * 1024**4)[initial] == "40960"


@pytest.mark.parametrize("setting, master, expected", [("hdfs:/shared", "yarn", "hdfs:/shared"), (None, "yarn", None)])
def test_a_cluster_uses_the_folder_it_names_or_none(setting, master, expected):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    session = SimpleNamespace(conf={"spark.checkpoint.dir": setting}, sparkContext=context)
    assert _shared_folder(session) == expected
