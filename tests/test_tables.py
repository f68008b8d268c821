import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallymart.functions.aggregates import joined_names, weighted_median
from tallymart.functions.tables import cut_points, keep_first, spread_rank, with_spine


def test_keep_first_keeps_one_row_per_key_nulls_included(spark):
    rows = [("a", "Vic/NSW", 1), ("a", "Vic", 2), ("a", None, 0), (None, None, 5), (None, None, 4)]
    df = spark.createDataFrame(rows, "k string, state string, v int")
    got = keep_first(df, ["k"], [F.asc_nulls_last("state"), F.asc("v")]).collect()
    assert {(r.k, r.v) for r in got} == {("a", 2), (None, 4)}


def test_keep_first_limits_each_task_before_the_shuffle(spark):
    df = spark.range(10_000).withColumn("k", F.col("id") % 2)
    plan = keep_first(df, ["k"], [F.asc("id")])._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert "Partial" in plan and "Final" in plan


def test_spine_has_every_pair_and_no_cross_join(spark):
    entities = spark.createDataFrame([("a",), ("b",), ("c",)], "e string")
    periods = spark.createDataFrame([(1,), (2,), (2,), (None,)], "p int")
    spine = with_spine(entities, periods, "p")
    assert sorted(map(str, spine.collect())) == sorted(f"Row(e='{e}', p={p})" for e in "abc" for p in (1, 2, None))
    plan = spine._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("descending", [True, False])
def test_spread_rank_equals_the_window_rank(spark, descending):
    """Ties, nulls, NaN, an outlier that would stretch equal-width slices, and a third of all rows equal."""
    random.seed(7)
    rows = []
    for i in range(6000):
        value = 42.0 if i % 3 == 0 else random.choice([None, 0.0, -0.0, 1e12, float("nan"), random.gauss(0, 1), random.randint(0, 9)])
        rows.append((i, random.choice([2018, 2019, None]), None if value is None else float(value)))
    rows.append((-1, 2020, None))
    df = spark.createDataFrame(rows, "id int, y int, v double")
    order = F.desc_nulls_last("v") if descending else F.asc_nulls_last("v")
    expected = df.withColumn("r", F.rank().over(Window.partitionBy("y").orderBy(order)))
    got = spread_rank(df, ["y"], "v", "r", descending=descending)
    assert {(r.id, r.r) for r in got.collect()} == {(r.id, r.r) for r in expected.collect()}
    assert got.count() == len(rows)


def test_cut_points_follow_from_the_values_alone(spark):
    """The same cuts in any order and partitioning; about equal shares of the values between them."""
    base = spark.range(40_000).selectExpr("id % 2 AS g", "pow(id, 3) AS v")
    counted = base.groupBy("g", "v").agg(F.count("*").alias("_n"))
    cuts = {r.g: r._cuts for r in cut_points(counted, ["g"], "v", 8).collect()}
    mixed = counted.orderBy(F.rand(5)).repartition(13)
    assert {r.g: r._cuts for r in cut_points(mixed, ["g"], "v", 8).collect()} == cuts
    for g, own in cuts.items():
        assert own == sorted(own) and len(own) == 7
        below = [base.filter((F.col("g") == g) & (F.col("v") < c)).count() for c in own]
        assert all(abs(n - 2500 * (k + 1)) < 600 for k, n in enumerate(below))


def test_spread_rank_needs_no_written_table(spark):
    df = spark.range(30_000).selectExpr("id", "1 AS y", "cast(id * 7919 % 10007 AS double) AS v")
    got = spread_rank(df, ["y"], "v", "r")
    plan = got._jdf.queryExecution().analyzed().toString()
    assert "spark_partition_id" not in plan.lower() and "parquet" not in plan.lower()
    expected = df.withColumn("r", F.rank().over(Window.partitionBy("y").orderBy("v")).cast("long"))
    assert got.exceptAll(expected).count() == 0 and got.count() == 30_000


def test_spread_rank_of_whole_numbers_and_of_nothing(spark):
    df = spark.createDataFrame([(1, 2**60), (1, 2**60 + 1), (1, 2**60)], "y int, v long")
    assert sorted(r.r for r in spread_rank(df, ["y"], "v", "r").collect()) == [1, 1, 3]
    assert spread_rank(df.filter("y = 2"), ["y"], "v", "r").count() == 0
    with pytest.raises(ValueError):
        spread_rank(df, [], "v", "r")


@pytest.mark.parametrize("descending", [True, False])
def test_spread_rank_takes_the_lowest_number(spark, descending):
    df = spark.createDataFrame([(1, -(2**63)), (1, 5), (1, -(2**63)), (1, None)], "y int, v long")
    got = {(r.v, r.r) for r in spread_rank(df, ["y"], "v", "r", descending=descending).collect()}
    assert got == ({(5, 1), (-(2**63), 2), (None, 4)} if descending else {(-(2**63), 1), (5, 3), (None, 4)})


def test_weighted_median_equals_the_plain_one(spark):
    random.seed(3)
    rows = [(random.randint(0, 5), random.choice([None, *range(30)])) for _ in range(997)]
    df = spark.createDataFrame(rows, "k int, v int")
    plain = {r.k: r.m for r in df.groupBy("k").agg(F.median("v").alias("m")).collect()}
    counted = df.groupBy("k", "v").agg(F.count("*").alias("n"))
    got = {
        r.k: r.m for r in counted.groupBy("k").agg(weighted_median(F.col("v"), F.col("n")).alias("m")).collect()
    }
    assert got == plain


def test_joined_names(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "n string")
    assert df.agg(joined_names("n").alias("x")).first().x == "a, b"


def test_tables_have_few_files(spark):
    from tallymart.sources.writers import create_layers, publish_table

    create_layers(spark, ["layout"])
    df = spark.range(20_000, numPartitions=16).withColumn("y", F.col("id") % 8)
    for name, how, most in (("b", {"bucket_by": "id", "buckets": 32}, 32), ("p", {"partition_by": ["y"]}, 16)):
        table = publish_table(df, "layout", name, **how)
        assert table.count() == 20_000 and len(table.inputFiles()) <= most
