"""One explicit schema per source: inference would cost a pass and turn codes such as '001' to numbers."""

from __future__ import annotations

from pyspark.sql import types as T


def text_schema(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


EPISODES = text_schema(
    "episode_id", "client_key", "provider_code", "referral_date", "first_contact_date", "episode_end_date",
    "completion_status", "suicide_risk_referral", "age_group", "sex", "indigenous_status", "iar_level", "data_source",
)
CONTACTS = text_schema("contact_id", "episode_id", "contact_date", "modality", "duration_minutes", "attended")
MEASURES = text_schema("measure_id", "episode_id", "measure", "collection_occasion", "collection_date", "score")
PROVIDERS = text_schema(
    "provider_code", "subregion", "program_type", "annual_episode_target", "provider_label", "data_source"
)
SUBREGIONS = text_schema("subregion", "region", "population_2023", "hub_town")
AREA_MAP = text_schema("sa3_name", "subregion")

SERVICE_TABLES = {
    "fact_episode": EPISODES,
    "fact_service_contact": CONTACTS,
    "fact_outcome_measure": MEASURES,
    "dim_provider": PROVIDERS,
    "dim_subregion": SUBREGIONS,
    "map_sa3_subregion": AREA_MAP,
}

SERVICE_LOCATIONS = T.StructType(
    text_schema("service_type", "location", "address", "sa3_name", "operator", "source_url").fields
    + [T.StructField("verified_date", T.DateType())]
)
PUBLISHED_VALUES = T.StructType(
    [
        T.StructField("indicator_code", T.StringType()),
        T.StructField("geography_code", T.StringType()),
        T.StructField("fy_end_year", T.IntegerType()),
        T.StructField("category", T.StringType()),
        T.StructField("published_value", T.DoubleType()),
        T.StructField("source", T.StringType()),
    ]
)
INDICATOR_SPECS = text_schema(
    "indicator_code", "indicator_name", "framework_dimension", "unit", "definition", "numerator", "denominator",
    "source_dataset", "latest_year_available", "phn_criterion", "national_criterion", "comparison_period_used",
    "caveats",
)

SEEDS = {
    "service_locations": SERVICE_LOCATIONS,
    "published_reference_values": PUBLISHED_VALUES,
    "framework_indicator_spec": INDICATOR_SPECS,
}
