"""Extracts, layer tables and sorted exports."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_extract(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Write a scoped release (Parquet, or UTF-8 CSV with a header) and return its rows.

    The rows are counted by the write itself.
    """
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).option("encoding", "UTF-8").option("escape", '"').csv(path)
    else:
        writer.format(fmt).save(path)
    return seen.get["rows"]


def create_layers(spark: SparkSession, layers: Sequence[str] = ("staging", "intermediate", "marts", "reference")):
    """One database per layer, named as the layer."""
    for layer in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")


def publish_view(spark: SparkSession, layer: str, name: str, query: str) -> DataFrame:
    """A view of a layer in the catalog: it outlives the session, and a reader's filters reach its source."""
    _make_way(spark, layer, name)
    spark.sql(f"CREATE OR REPLACE VIEW `{layer}`.`{name}` AS {query}")
    return spark.table(f"{layer}.{name}")


def _make_way(spark: SparkSession, layer: str, name: str) -> None:
    """A plain table under the name of a view, as builds without versions left it, goes."""
    if spark.catalog.tableExists(f"{layer}.{name}") and spark.catalog.getTable(f"{layer}.{name}").tableType != "VIEW":
        spark.sql(f"DROP TABLE `{layer}`.`{name}`")


def new_run() -> str:
    """A name for the versions that one build writes."""
    return f"{dt.datetime.now(dt.timezone.utc):%Y%m%d%H%M%S}_{uuid.uuid4().hex[:8]}"


def version_name(name: str, run: str) -> str:
    return f"{name}__v_{run}"


def write_version(df: DataFrame, layer: str, name: str, run: str, **layout) -> DataFrame:
    """Write a table under the run's own name: readers of the layer do not see it until ``swap_version``."""
    return publish_table(df, layer, version_name(name, run), **layout)


def current_version(spark: SparkSession, layer: str, name: str) -> str | None:
    """The table behind a name of a layer."""
    if not spark.catalog.tableExists(f"{layer}.{name}"):
        return None
    found = spark.sql(f"DESCRIBE TABLE EXTENDED `{layer}`.`{name}`").where("col_name = 'View Text'").first()
    return found.data_type.rsplit(".", 1)[-1].strip("`") if found else None


def swap_version(spark: SparkSession, layer: str, name: str, run: str) -> DataFrame:
    """Let a name of a layer stand for the run's version from now on.

    The name is a view, replaced in one catalog step, so a reader sees the old version or the new one. The old one is
    kept for queries that still read it; versions before it, and those that were held back, are dropped.
    """
    own, before = version_name(name, run), current_version(spark, layer, name)
    table = publish_view(spark, layer, name, f"SELECT * FROM `{layer}`.`{own}`")
    prefix = version_name(name, "")
    for row in spark.sql(f"SHOW TABLES IN `{layer}` LIKE '{prefix}*'").collect():  # the versions of one name
        if row.tableName.startswith(prefix) and row.tableName not in (own, before):
            spark.sql(f"DROP TABLE `{layer}`.`{row.tableName}`")
    return table


def publish_table(
    df: DataFrame,
    layer: str,
    name: str,
    *,
    partition_by: Sequence[str] = (),
    bucket_by: str | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Write a table of a layer and return it.

    Episodes, contacts and measures are best bucketed by episode: rollups and the fact's joins then
    do not shuffle. ``buckets`` follows from the data (a bucket should fit a task), so it has no
    default. Indicator tables are best partitioned by year: a year filter reads one folder.

    Rows are dealt out before the write, so a table has one file a bucket, and one or a few files a
    folder: rebalancing splits a folder too large for one task.
    """
    if (bucket_by is None) != (buckets is None):
        raise ValueError("give bucket_by and buckets together")
    if bucket_by:
        df = df.repartition(buckets, bucket_by)
    elif partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(f"{layer}.{name}")
    return df.sparkSession.table(f"{layer}.{name}")


@dataclass(frozen=True)
class Export:
    """A mart to hand out: its sort order and, optionally, the column names its readers expect."""

    table: str
    order: tuple[str, ...]
    layer: str = "marts"
    rename: Mapping[str, str] = field(default_factory=dict)


def sorted_export(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Ascending, nulls last."""
    return df.orderBy(*[F.asc_nulls_last(name) for name in order])


def export_marts(spark: SparkSession, folder: str, exports: Mapping[str, Export]) -> dict[str, int]:
    """One CSV directory per export, part files in sort order, and the rows of each.

    A range-partitioned sort writes its parts in parallel; a mart below the coalescing size of
    adaptive execution comes out as one file by itself.
    """
    rows = {}
    for name, export in exports.items():
        mart = sorted_export(spark.table(f"{export.layer}.{export.table}"), export.order)
        rows[name] = write_extract(mart.withColumnsRenamed(dict(export.rename)), f"{folder.rstrip('/')}/{name}", "csv")
    return rows
