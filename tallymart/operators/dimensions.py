"""Provider and subregion dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions.aggregates import joined_names


def dim_provider(providers: DataFrame, subregions: DataFrame) -> DataFrame:
    return providers.join(subregions.select("subregion", "region"), "subregion", "left").select(
        "provider_code", "provider_label", "program_type", "subregion", "region", "annual_episode_target", "data_source"
    )


def dim_subregion(subregions: DataFrame, area_map: DataFrame) -> DataFrame:
    """Subregions with the number of areas they cover and the areas' names in order."""
    areas = area_map.groupBy("subregion").agg(
        F.count("area_name").alias("area_count"), joined_names("area_name").alias("area_names")
    )
    return subregions.join(areas, "subregion", "left").select(
        "subregion",
        "region",
        "hub_town",
        "population_2023",
        F.coalesce("area_count", F.lit(0).cast("long")).alias("area_count"),
        "area_names",
    )
