"""Typed, deduplicated inputs."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.functions.columns import (
    blank_to_null,
    code_map,
    first_match,
    fy_end_year,
    lenient_double,
    like_map,
    yes_flag,
)
from tallymart.functions.tables import keep_first

# Codes that are groups of units although published at unit level, and the label of
# the national level.
GROUP_CODES = ("003MET", "003REG")
NATIONAL_UNIT = "NAT"

OCCASIONS = {"Episode start": "start", "Episode end": "end"}


@dataclass(frozen=True)
class IndicatorSpec:
    """How one release becomes a clean long table.

    ``carried`` maps output names to raw columns kept as they are; ``bands`` maps an output name to
    the raw names it may have in a release. A measure is typed by ``measure_patterns`` (LIKE, first
    match wins) or by ``measure_names`` (exact).
    """

    key: tuple[str, ...]
    carried: Mapping[str, str]
    measure_patterns: tuple[tuple[str, str], ...] = ()
    measure_names: Mapping[str, str] | None = None
    bands: Mapping[str, tuple[str, ...]] | None = None
    band_default: str = "Not applicable"
    total_condition: str | None = None
    total_pattern: str = "Total%"
    flag_as_boolean: bool = False
    unit_level: str = "PHN"


def geography_level(spec: IndicatorSpec) -> Column:
    unit, code = F.col("GeographicUnit"), F.col("GeographicCode")
    return first_match(
        [
            ((unit == spec.unit_level) & code.isin(*GROUP_CODES), F.lit(f"{spec.unit_level} group")),
            (unit == NATIONAL_UNIT, F.lit("National")),
        ],
        otherwise=unit,
    )


def _band(raw: DataFrame, names: tuple[str, ...], default: str) -> Column:
    present = [name for name in names if name in raw.columns]
    if not present:
        raise ValueError(f"release has none of the columns {names}")
    return F.coalesce(*[blank_to_null(name) for name in present], F.lit(default))


def clean_indicator(raw: DataFrame, spec: IndicatorSpec) -> DataFrame:
    """Typed long table with one row per ``spec.key``.

    Repeated national worksheets and a unit listed under two states collapse to the first copy by
    state (blank last), then worksheet, then value, then every other column, so the choice is the
    same on every run.
    """
    columns: dict[str, Column] = {
        "financial_year": F.col("Year"),
        "fy_end_year": fy_end_year("Year"),
        "geography_level": geography_level(spec),
        "geography_code": F.col("GeographicCode"),
        "geography_name": F.col("GeographicAreaName"),
        "geographic_group": F.col("GeographicGroup"),
        "state": blank_to_null("StateTerritory"),
    }
    columns |= {name: F.col(source) for name, source in spec.carried.items()}
    for name, sources in (spec.bands or {}).items():
        columns[name] = _band(raw, sources, spec.band_default)
    if spec.total_condition:
        columns["is_group_total"] = F.col(spec.total_condition).like(spec.total_pattern)
    columns["measure_type"] = (
        code_map("MeasureName", spec.measure_names)
        if spec.measure_names
        else like_map("MeasureName", spec.measure_patterns)
    )
    columns["measure_name"] = F.col("MeasureName")
    columns["measure_value"] = lenient_double("MeasureValue")
    columns |= {"is_flagged": F.col("Flag").isNotNull()} if spec.flag_as_boolean else {"flag": F.col("Flag")}
    columns["flag_explanation"] = F.col("FlagExplanation")

    typed = raw.select(*[column.alias(name) for name, column in columns.items()], F.col("Worksheet").alias("_sheet"))
    first = ["state", "_sheet", "measure_value"]
    rest = [name for name in columns if name not in first and name not in spec.key]
    order = [F.asc_nulls_last(name) for name in (*first, *rest)]
    return keep_first(typed, spec.key, order).drop("_sheet")


def clean_episodes(raw: DataFrame) -> DataFrame:
    return raw.select(
        "episode_id",
        "client_key",
        "provider_code",
        F.col("referral_date").cast("date"),
        F.col("first_contact_date").cast("date"),
        F.col("episode_end_date").cast("date"),
        "completion_status",
        yes_flag("suicide_risk_referral").alias("is_suicide_risk_referral"),
        "age_group",
        "sex",
        "indigenous_status",
        F.col("iar_level").cast("int"),
        "data_source",
    )


def clean_contacts(raw: DataFrame) -> DataFrame:
    return raw.select(
        "contact_id",
        "episode_id",
        F.col("contact_date").cast("date"),
        "modality",
        F.col("duration_minutes").cast("int"),
        yes_flag("attended").alias("is_attended"),
    )


def clean_measures(raw: DataFrame) -> DataFrame:
    """Occasions other than the start and the end of an episode become null."""
    return raw.select(
        "measure_id",
        "episode_id",
        "measure",
        code_map("collection_occasion", OCCASIONS).alias("collection_occasion"),
        F.col("collection_date").cast("date"),
        F.col("score").cast("int"),
    )


def clean_providers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "provider_code",
        "provider_label",
        "program_type",
        "subregion",
        F.col("annual_episode_target").cast("int"),
        "data_source",
    )


def clean_subregions(raw: DataFrame) -> DataFrame:
    return raw.select("subregion", "region", "hub_town", F.col("population_2023").cast("int"))


def clean_area_map(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("sa3_name").alias("area_name"), "subregion")


def clean_services(raw: DataFrame) -> DataFrame:
    return raw.withColumnRenamed("sa3_name", "area_name")
