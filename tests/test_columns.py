import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallymart import Params, Period
from tallymart.functions import columns as c


def values(spark, rows, schema, *expressions):
    df = spark.createDataFrame(rows, schema).select(*[e.alias(f"c{i}") for i, e in enumerate(expressions)])
    return [tuple(r) for r in df.collect()]


def test_yes_flag_is_three_valued(spark):
    assert values(spark, [("Yes",), ("No",), (None,)], "a string", c.yes_flag("a")) == [(True,), (False,), (None,)]


def test_fy_end_year(spark):
    assert values(spark, [("2017-18",), ("1999–00",)], "a string", c.fy_end_year("a")) == [(2018,), (2000,)]


def test_lenient_double(spark):
    rows = [("12.5",), ("n.p.",), ("-",), ("",), (" 12 ",), ("1,234",), (None,)]
    assert values(spark, rows, "a string", c.lenient_double("a")) == [
        (12.5,), (None,), (None,), (None,), (12.0,), (None,), (None,),
    ]


def test_strict_cast_raises(spark):
    with pytest.raises(PySparkException):
        spark.createDataFrame([("2025-13-45",)], "d string").select(F.col("d").cast("date")).collect()


def test_blanks(spark):
    got = values(spark, [("",), ("x",), (None,)], "a string", c.blank_to_null("a"))
    assert got == [(None,), ("x",), (None,)]


def test_maps_take_the_first_match_and_leave_the_rest_null(spark):
    patterns = [("%standardised", "rate"), ("Number%", "count")]
    rows = [("Number standardised",), ("Number x",), ("number x",), (None,)]
    assert values(spark, rows, "a string", c.like_map("a", patterns)) == [("rate",), ("count",), (None,), (None,)]
    assert values(spark, [("a",), ("z",), (None,)], "a string", c.code_map("a", {"a": "b"})) == [("b",), (None,), (None,)]


def test_dashes(spark):
    rows = [("2017–18",), ("2017\u009618",), ("2017\u009618".replace("\u0096", "\x96"),)]
    assert set(values(spark, rows, "a string", c.plain_dashes("a"))) == {("2017-18",)}
    assert c.with_dash_forms(["0-64", "65+"]) == ["0-64", "0–64", "0\u009664", "65+"]


def test_quarters_and_days(spark):
    rows = [(dt.date(2025, 5, 17), dt.date(2025, 5, 24)), (None, dt.date(2025, 1, 1))]
    got = values(
        spark, rows, "a date, b date", c.quarter_start("a"), c.quarter_label("a"), c.days_between("a", "b")
    )
    assert got == [(dt.date(2025, 4, 1), "2025-Q2", 7), (None, None, None)]


def test_ratio_has_no_zero_division(spark):
    rows = [(1, 2), (1, 0), (None, 2)]
    assert values(spark, rows, "a int, b int", c.ratio(F.col("a"), F.col("b"))) == [(0.5,), (None,), (None,)]


@pytest.mark.parametrize(
    "number, digits, expected", [(8.325, 2, 8.32), (1.005, 2, 1.0), (12.5, 0, 13.0), (-12.5, 0, -13.0), (0.25, 1, 0.3)]
)
def test_half_away_rounds_the_binary_value(spark, number, digits, expected):
    assert values(spark, [(number,)], "a double", c.half_away(F.col("a"), digits)) == [(expected,)]


def test_half_away_equals_the_other_engine(spark):
    duckdb = pytest.importorskip("duckdb")
    random.seed(5)
    numbers = [random.uniform(-500, 500) for _ in range(500)]
    numbers += [random.randint(-99999, 99999) / d for d in (8, 20, 40, 80, 200, 400, 2000) for _ in range(200)]
    rounded = spark.createDataFrame([(x,) for x in numbers], "x double").select(
        "x", *[c.half_away(F.col("x"), n).alias(f"r{n}") for n in (0, 1, 2)]
    )
    con = duckdb.connect()
    for row in rounded.collect():
        expected = con.execute("SELECT round(?::DOUBLE, 0), round(?::DOUBLE, 1), round(?::DOUBLE, 2)", [row.x] * 3).fetchall()
        assert (row.r0, row.r1, row.r2) == expected[0], row.x


def test_pct_change(spark):
    rows = [(110.0, 100.0), (90.0, 120.0), (1.0, 0.0), (1.0, None), (None, 1.0)]
    got = values(spark, rows, "a double, b double", c.pct_change(F.col("a"), F.col("b")))
    assert got == [(10.0,), (-25.0,), (None,), (None,), (None,)]


def test_target_status_of_a_missing_metric(spark):
    got = values(spark, [(14.0,), (15.0,), (None,)], "a double", c.target_status(F.col("a") <= 14))
    assert got == [("On target",), ("Below target",), ("Below target",)]


def test_params_are_validated():
    with pytest.raises(ValueError):
        Params(target_outcome_rate=1.2)
    with pytest.raises(ValueError):
        Params(stale_open_days=-1)
    with pytest.raises(ValueError):
        Params(reach_years=0)
    with pytest.raises(ValueError):
        Params(extract_date=dt.date(2025, 12, 31))
    assert Params(extract_date=dt.date(2026, 3, 31)).scorecard == Period(dt.date(2026, 1, 1), dt.date(2026, 3, 31))
    with pytest.raises(ValueError):
        Period(dt.date(2026, 2, 1), dt.date(2026, 1, 1))
