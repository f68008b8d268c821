"""Value profile of text columns before scoping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def profile(df: DataFrame, columns: Sequence[str], k: int = 60, long: Sequence[str] = ()) -> DataFrame:
    """Per column: rows, distinct values (null counts as one) and the ``k`` most frequent values.

    The columns are unpivoted in one scan and counted before the shuffle, so a value that fills a
    third of the table travels as one row per task. The top ``k`` are cut per task as well before
    a column's values meet. Ties go by value.

    The columns named in ``long`` hold long values: these are counted by their MD5, which decides ties too, and
    only the ``k`` most frequent ones are fetched, by a second scan.
    """
    unknown = set(long) - set(columns)
    if unknown:
        raise ValueError(f"not among the profiled columns: {sorted(unknown)}")
    counted = (
        df.select(*[(F.md5(F.col(c).cast("string")) if c in long else F.col(c).cast("string")).alias(c) for c in columns])
        .unpivot([], list(columns), "column_name", "value")
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    totals = counted.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("distinct_values"), F.sum("n").alias("total_rows")
    )
    frequency = Window.partitionBy("column_name").orderBy(F.desc("n"), F.asc_nulls_last("value"))
    top = counted.withColumn("value_rank", F.row_number().over(frequency)).filter(F.col("value_rank") <= k)
    if long:
        top = _with_long_values(df, top, long)
    # One row per profiled column: the list of columns bounds the broadcast.
    return top.join(F.broadcast(totals), "column_name").select(
        "column_name", "total_rows", "distinct_values", F.col("value_rank").cast("long").alias("value_rank"), "value", "n"
    )


def _with_long_values(df: DataFrame, top: DataFrame, long: Sequence[str]) -> DataFrame:
    """The top rows of long columns with their values in place of the digests: ``k`` a column bound the broadcast."""
    is_long = F.col("column_name").isin(*long)
    wanted = top.filter(is_long & F.col("value").isNotNull()).select(
        F.col("column_name").alias("_column"), F.col("value").alias("_digest")
    )
    values = df.select(*[F.col(c).cast("string").alias(c) for c in long]).unpivot([], list(long), "_column", "_value")
    values = values.withColumn("_digest", F.md5("_value")).join(F.broadcast(wanted), ["_column", "_digest"], "left_semi")
    values = values.groupBy("_column", "_digest").agg(F.any_value("_value").alias("_value"))
    same = (F.col("column_name") == F.col("_column")) & (F.col("value") == F.col("_digest"))
    found = top.join(values, same, "left")
    return found.withColumn("value", F.when(is_long, F.col("_value")).otherwise(F.col("value"))).select(*top.columns)
