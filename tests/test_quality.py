import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallymart.operators import quality as q

D = dt.date
EPISODES = "episode_id string, referral_date date, first_contact_date date, episode_end_date date"
CONTACTS = "contact_id string, episode_id string, contact_date date"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_unique_ignores_nulls_and_combinations_count_them(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 1), (None, 1), ("b", None), ("b", None)], "k string, v int")
    assert rows(q.duplicate_keys(df, ["k"], count_nulls=False)) == [("a", 2), ("b", 2)]
    assert {tuple(r) for r in q.duplicate_keys(df, ["k", "v"]).collect()} == {(None, 1, 2), ("b", None, 2)}
    assert q.duplicate_keys(df.filter("v = 2"), ["k"]).count() == 0


def test_accepted_values_pass_nulls(spark):
    df = spark.createDataFrame([("a", 1), ("z", 6), (None, None)], "k string, n int")
    assert rows(df.filter(q.not_accepted("k", ("a", "b")))) == [("z", 6)]
    assert rows(df.filter(q.not_accepted("n", range(1, 6)))) == [("z", 6)]


def test_relationships_pass_nulls_and_mapping_does_not(spark):
    child = spark.createDataFrame([("a",), ("a",), ("x",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    assert rows(q.orphans(child, "k", parent)) == [("x",)]
    assert rows(q.orphans(child, "k", parent.withColumnRenamed("k", "other"), "other")) == [("x",)]
    assert {r.k for r in q.unmapped(child, "k", parent).collect()} == {"x", None}


def test_dates_in_order(spark):
    good = [("g1", D(2026, 1, 1), None, None), ("g2", D(2026, 1, 1), D(2026, 1, 1), D(2026, 1, 1))]
    bad = [("b1", D(2026, 1, 2), D(2026, 1, 1), None), ("b2", D(2026, 1, 2), None, D(2026, 1, 1)),
           ("b3", D(2026, 1, 1), D(2026, 1, 5), D(2026, 1, 4))]
    df = spark.createDataFrame(good + bad, EPISODES)
    assert [r[0] for r in rows(df.filter(q.dates_out_of_order()).select("episode_id"))] == ["b1", "b2", "b3"]


def test_contacts_against_their_episode(spark):
    episodes = spark.createDataFrame(
        [("e", D(2026, 1, 1), D(2026, 1, 5), D(2026, 2, 1)), ("open", D(2026, 1, 1), D(2026, 1, 5), None),
         ("none", D(2026, 1, 1), None, None)], EPISODES)
    contacts = spark.createDataFrame(
        [("early", "e", D(2026, 1, 4)), ("first", "e", D(2026, 1, 5)), ("late", "e", D(2026, 2, 2)),
         ("last day", "open", D(2026, 6, 30)), ("future", "open", D(2026, 7, 1)), ("lost", "x", D(2026, 1, 1)),
         ("twice", "e", D(2026, 2, 2))], CONTACTS)
    found = q.contacts_outside_episode(contacts, episodes, D(2026, 6, 30))
    assert [r[0] for r in rows(found)] == ["early", "future", "late", "twice"]
    assert rows(q.repeated_contact_days(contacts)) == [("e", D(2026, 2, 2), 2)]
    assert rows(q.first_contact_without_record(episodes, contacts)) == [("open",)]


def test_scales_and_rates(spark):
    scores = spark.createDataFrame(
        [("K10+", 10), ("K10+", 50), ("K10+", 9), ("K10+", 51), ("SDQ", 0), ("SDQ", 40), ("SDQ", 41), ("SDQ", -1),
         ("other", 99), ("SDQ", None)], "measure string, score int")
    assert rows(scores.filter(q.outside_scale())) == [("K10+", 9), ("K10+", 51), ("SDQ", -1), ("SDQ", 41)]
    rates = spark.createDataFrame([(0.0, 1.0), (None, 1.1), (-0.1, None), (None, None)], "a double, b double")
    assert rates.filter(q.rate_out_of_bounds("a", "b")).count() == 2


def test_completeness(spark):
    areas = spark.createDataFrame([(2018, "a"), (2018, "b"), (2018, "b"), (2019, "a")], "fy_end_year int, area_code string")
    area_map = spark.createDataFrame([("a",), ("b",)], "area_name string")
    assert rows(q.incomplete_years(areas, area_map)) == [(2019, 1)]
    trend = spark.createDataFrame([("u", 1.0), ("u", None), ("n", 2.0), ("x", 2.0)], "geography_code string, rate double")
    assert rows(q.wrong_row_count(trend, ("u", "n"), 2)) == []
    assert rows(q.wrong_row_count(trend, ("u", "n"), 3)) == [(2,)]


def test_reconciliation(spark):
    trend = spark.createDataFrame(
        [("I", "u", 2018, "c", 10.0), ("I", "u", 2019, "c", 10.25), ("I", "u", 2020, "c", 10.5), ("I", "u", 2021, "c", None)],
        "indicator_code string, geography_code string, fy_end_year int, band string, rate double",
    )
    published = spark.createDataFrame(
        [("I", "u", y, c, v) for y, c, v in [(2018, "c", 10.0), (2019, "c", 10.5), (2020, "c", 10.875), (2021, "c", 1.0), (2018, "d", 1.0)]],
        "indicator_code string, geography_code string, fy_end_year int, category string, published_value double",
    )
    found = q.unreconciled(published, {"band": trend}, 0.25)
    assert {(r.fy_end_year, r.category) for r in found.collect()} == {(2020, "c"), (2021, "c"), (2018, "d")}


def test_drift_counts_copies(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "z")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, None), (4, "w"), (4, "w")], "k int, v string")
    assert rows(q.drift(a, b)) == [
        ("committed only", 1, 1, "x"), ("committed only", 1, 3, "z"), ("rebuilt only", 2, 4, "w"),
    ]
    assert q.drift(a, a.select("v", "k")).count() == 0
    both = a.exceptAll(b).count() + b.exceptAll(a).count()
    assert q.drift(a, b).agg(F.sum("copies")).first()[0] == both


def suite():
    return [
        q.unique("t", "k"),
        *q.not_null("t", "k", "v"),
        q.accepted("t", "v", (1, 2)),
        q.unique_combination("t", "k", "v"),
        q.related("t", "k", "p"),
        *q.not_null("p", "k"),
    ]


def test_report_and_gate(spark):
    good = {
        "t": spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"),
        "p": spark.createDataFrame([("a",), ("b",)], "k string"),
    }
    assert {r[2] for r in q.gate(good, suite())} == {0}
    bad = good | {"t": spark.createDataFrame([("a", 1), ("a", 1), ("c", 9), (None, None)], "k string, v int")}
    report = {r.check: r.failures for r in q.run_checks(bad, suite()).collect()}
    assert report == {
        "unique_t_k": 1, "not_null_t_k": 1, "not_null_t_v": 1, "accepted_values_t_v": 1,
        "unique_combination_t": 1, "relationships_t_k": 1, "not_null_p_k": 0,
    }
    for check in suite():
        assert check.rows(bad).count() == report[check.name]
    with pytest.raises(q.QualityGateError, match="accepted_values_t_v: 1 failing rows"):
        q.gate(bad, suite())
    with pytest.raises(ValueError):
        q.Check("neither", "t")


def test_row_checks_share_one_pass(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/orders.parquet")
    checks = [*q.not_null("o", "o_orderkey", "o_custkey"), q.accepted("o", "o_orderstatus", ("F", "O", "P"))]
    plan = q.run_checks({"o": table}, checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("orders.parquet") == 1


def test_key_checks_of_a_table_share_one_pass(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    checks = [
        q.unique("o", "o_orderkey"), q.unique_combination("o", "o_custkey", "o_orderdate"), *q.not_null("o", "o_orderdate"),
        q.related("o", "o_custkey", "c", "c_custkey"), q.related("o", "o_orderkey", "o", "o_custkey"), q.unique("c", "c_nationkey"),
    ]
    tables = {"o": orders, "c": customer}
    report = q.run_checks(tables, checks)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("orders.parquet") == 1 and plan.count("customer.parquet") == 1 and "Join" not in plan
    got = {r.check: r.failures for r in report.collect()}
    assert got == {c.name: c.rows(tables).count() for c in checks} and max(got.values()) > 0


def test_keys_of_other_types_and_signs_do_not_meet(spark):
    rows = [("a", None), ("a", "null"), ("[", '","'), ('","', "["), (None, None), (None, None)]
    t = spark.createDataFrame(rows, "k string, v string")
    p = spark.createDataFrame([("a",), (None,)], "k string")
    checks = [q.unique_combination("t", "k", "v"), q.unique("t", "v"), q.related("t", "k", "p")]
    got = {r.check: r.failures for r in q.run_checks({"t": t, "p": p}, checks).collect()}
    assert got == {"unique_combination_t": 1, "unique_t_v": 0, "relationships_t_k": 2}
    assert q.run_checks({}, []).count() == 0


def test_drift_shuffles_digests_before_rows(spark):
    wide = spark.range(200).selectExpr("id", "repeat(cast(id AS string), 50) AS text", "if(id % 2 = 0, 0.0D, -0.0D) AS v", "array(id) AS a")
    other = wide.where("id <> 7").withColumn("v", F.col("v") * -1)
    got = q.drift(wide, other.union(wide.where("id = 9")))
    assert {(r.side, r.id, r.copies) for r in got.collect()} == {("committed only", 7, 1), ("rebuilt only", 9, 1)}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(_digest" in plan
