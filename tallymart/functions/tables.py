"""Table helpers: keep-first deduplication, spines and ranks that survive a hot group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``, which must be total for a repeatable result.

    The rank filter becomes a group limit ahead of the shuffle, so of a key that holds a large
    share of the rows each task sends one row.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_copy", F.row_number().over(window)).filter("_copy = 1").drop("_copy")


def with_spine(entities: DataFrame, periods: DataFrame, period: str) -> DataFrame:
    """Every entity beside every distinct period, a missing one included, without a cross join.

    The distinct periods are calendar dates (four quarters a year), so the one-row array of them
    is bounded by the calendar, not by the rows they come from. Each is held in a struct, which is there
    even where the period is not.
    """
    listed = periods.agg(F.array_sort(F.collect_set(F.struct(F.col(period).alias("period")))).alias("_periods"))
    return entities.withColumn(period, F.explode(listed.scalar())).withColumn(period, F.col(f"{period}.period"))


#: Ranges into which ``spread_rank`` cuts a group, and the values that its cut points are drawn from.
RANGES, SAMPLED = 32, 2048


def cut_points(counted: DataFrame, group: Sequence[str], value: str, ranges: int = RANGES) -> DataFrame:
    """For each group the ``_cuts`` that part its distinct values into about equal ranges.

    They are quantiles of the values that a hash of the value picks, about ``SAMPLED`` a group: the same ones whenever
    they are asked for, whatever the partitions or their order.
    """
    sizes = counted.groupBy(*group).agg(F.count(F.lit(1)).alias("_distinct"))
    every = F.ceil(F.col("_distinct") / SAMPLED)
    picked = counted.where(F.col(value).isNotNull()).join(_rename(sizes, group, "_s"), _same(group, "_s"))
    picked = picked.where(F.pmod(F.xxhash64(value), every) == 0)
    sampled = picked.groupBy(*group).agg(F.sort_array(F.collect_list(value)).alias("_sample"))
    places = [F.floor(F.size("_sample") * F.lit(k) / F.lit(ranges)).cast("int") for k in range(1, ranges)]
    return sampled.select(*group, F.array_distinct(F.array(*(F.get("_sample", p) for p in places))).alias("_cuts"))


def spread_rank(
    df: DataFrame, keys: Sequence[str], value: str, rank: str, *, descending: bool = False, ranges: int = RANGES
) -> DataFrame:
    """``rank()`` within ``keys`` (nulls last, ties share a rank) with no task holding a large group.

    Rows are counted by keys and value first, so a value that many rows share is one row from here on. A count's range
    is the number of cut points below its value, so it depends on the value alone, however often and wherever it is
    computed. The rows ahead of a value are those in earlier ranges of its group, from one total a range, and those
    before it in its own range. The rank joins back by keys and value, nulls and NaN included.
    """
    group = list(keys)
    if not group:
        raise ValueError("rank within at least one key, such as the year")
    order = F.desc_nulls_last(value) if descending else F.asc_nulls_last(value)
    counted = df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("_n"))
    cuts = _rename(cut_points(counted, group, value, ranges), group, "_c")
    below = F.size(F.filter("_cuts", lambda cut: cut < F.col(value)))
    place = F.when(F.col(value).isNull(), ranges + 1).otherwise(F.coalesce(-below if descending else below, F.lit(0)))
    counted = counted.join(cuts, _same(group, "_c"), "left").select(*group, value, "_n", place.alias("_range"))
    in_range = [*group, "_range"]
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = counted.groupBy(*in_range).agg(F.sum("_n").alias("_sum"))
    before = before.select(*in_range, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*in_range).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = counted.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    ranked = ranked.join(_rename(before, in_range, "_b"), _same(in_range, "_b"))
    place = (F.col("_before") + F.col("_inside") + 1).cast("long").alias(rank)
    by_value = [*group, value]
    ranked = _rename(ranked.select(*by_value, place), by_value, "_v")
    return df.join(ranked, _same(by_value, "_v")).select(*df.columns, rank)


def _rename(df: DataFrame, names: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({name: f"{prefix}{name}" for name in names})


def _same(names: Sequence[str], prefix: str) -> Column:
    match = F.lit(True)
    for name in names:
        match = match & F.col(name).eqNullSafe(F.col(f"{prefix}{name}"))
    return match
