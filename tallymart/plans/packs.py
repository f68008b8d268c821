"""The two published packs as data: labels, scopes, cleaning rules and exports."""

from __future__ import annotations

from tallymart.operators.cleaning import IndicatorSpec
from tallymart.operators.scoping import ScopeSpec
from tallymart.sources.writers import Export

# The areas reported on.
AREAS = (
    "Ballarat",
    "Creswick - Daylesford - Ballan",
    "Maryborough - Pyrenees",
    "Barwon - West",
    "Geelong",
    "Surf Coast - Bellarine Peninsula",
    "Warrnambool",
    "Colac - Corangamite",
    "Glenelg - Southern Grampians",
    "Grampians",
)

# Measure labels as published.
ALL_HOURS_RATE = "All-hours lower urgency ED, per 1,000 population, age-standardised"
IN_HOURS_RATE = "In-hours lower urgency ED, per 1,000 population, age-standardised"
AFTER_HOURS_RATE = "After-hours lower urgency ED, per 1,000 population, age-standardised"
ALL_HOURS_NUMBER = "Number all-hours lower urgency ED"
TOTAL_ED_NUMBER = "Number total ED"
POPULATION = "Estimated resident population"
BAND_SEPARATOR = " lower urgency"
LOWER_URGENCY_TRIAGE = "TC4+5"
ALL_HOURS = "All-hours"

# Measure labels and condition totals of the second release.
PPH_MEASURES = {
    "Hospitalisations per 100,000 people (age-standardised)": "rate_age_standardised",
    "Hospitalisations per 100,000 people (crude)": "rate_crude",
    "Number of hospitalisations": "count",
    "Estimated resident population": "population",
}
PPH_TOTALS = ("Total PPH", "Total acute", "Total chronic", "Total vaccine-preventable")

# Measure types by label pattern, first match wins.
ED_MEASURE_PATTERNS = (
    ("%age-standardised", "rate_age_standardised"),
    ("%per 1,000 population", "rate_crude"),
    ("Number%", "count"),
    ("Estimated resident population", "population"),
)

# Codes the service tables may hold.
PROGRAM_TYPES = ("Psychological therapies", "Youth enhanced services", "Low intensity", "Clinical care coordination")
STATUSES = (
    "Treatment concluded",
    "Client disengaged",
    "Referred on",
    "Open",
    "Referral not progressed",
    "Awaiting first contact",
)
SERVICE_TYPES = {
    "urgent_care_clinics": "Medicare Urgent Care Clinic",
    "after_hours_services": "Commissioned after hours service",
}
# Columns profiled before scoping.
PROFILE_COLUMNS = (
    "Worksheet",
    "Year",
    "StateTerritory",
    "GeographicUnit",
    "GeographicGroup",
    "DemographicGroup",
    "PPHGroup",
    "PPHCondition",
    "MeasureName",
    "Flag",
)

ED_SCOPE = ScopeSpec(
    measures=(ALL_HOURS_RATE, IN_HOURS_RATE, AFTER_HOURS_RATE, ALL_HOURS_NUMBER, TOTAL_ED_NUMBER, POPULATION),
    areas=AREAS,
    wide_levels=("NAT", "PHN"),
    area_level="SA3",
    state="Vic",
    member_of={"TriageCategory": (LOWER_URGENCY_TRIAGE, "All")},
    require_measures=False,
)
PPH_SCOPE = ScopeSpec(
    measures=tuple(PPH_MEASURES),
    areas=AREAS,
    wide_levels=("NAT", "PHN"),
    area_level="SA3",
    state="Vic",
    state_contains=True,
    age_bands=("0-64", "65+"),
    required_codes=("PHN206",),
)

ED_SPEC = IndicatorSpec(
    key=("fy_end_year", "geography_level", "geography_code", "triage_category", "hour_band", "measure_name"),
    carried={"triage_category": "TriageCategory"},
    bands={"hour_band": ("HourEDpresentation", "HourED")},
    measure_patterns=ED_MEASURE_PATTERNS,
    flag_as_boolean=True,
)
PPH_SPEC = IndicatorSpec(
    key=("fy_end_year", "geography_code", "demographic_group", "pph_group", "pph_condition", "measure_type"),
    carried={"demographic_group": "DemographicGroup", "pph_group": "PPHGroup", "pph_condition": "PPHCondition"},
    measure_names=PPH_MEASURES,
    total_condition="PPHCondition",
)

# The area table's columns and the measures they hold.
AREA_COLUMNS = {
    "rate_age_standardised": ALL_HOURS_RATE,
    "after_hours_rate_age_standardised": AFTER_HOURS_RATE,
    "lower_urgency_presentations": ALL_HOURS_NUMBER,
    "population": POPULATION,
}

# Exports keep the geography's published column names.
_AREA_NAMES = {"area_code": "sa3_code", "area_name": "sa3_name"}
_GROUP_NAMES = {"peer_group_rate": "regional_group_rate", "gap_to_peer_group": "gap_to_regional"}

EXPORTS = {
    "im01_pph": Export("im01_pph", ("geography_code", "pph_category", "fy_end_year")),
    "im01_age": Export("im01_age", ("geography_code", "age_group", "fy_end_year")),
    "im01_conditions": Export("im01_conditions", ("pph_group", "pph_condition"), rename=_GROUP_NAMES),
    "im01_sa3": Export("im01_sa3", ("area_name", "fy_end_year"), rename=_AREA_NAMES),
    "im02_lower_urgency": Export("im02_lower_urgency", ("geography_code", "hour_band", "fy_end_year")),
    "im02_sa3": Export("lower_urgency_ed_sa3", ("area_name", "fy_end_year"), rename=_AREA_NAMES),
    "im02_sa3_hotspots": Export("im02_sa3_hotspots", ("rank_highest_first",), rename=_AREA_NAMES),
    "peer_comparison": Export("peer_comparison", ("indicator_code", "rank_lowest_first"), rename=_GROUP_NAMES),
    "criteria_check": Export("criteria_check", ("indicator_code", "criterion_level", "fy_end_year")),
    "indicator_spec": Export("framework_indicator_spec", ("indicator_code",), layer="reference"),
    "service_locations": Export("service_locations", ("service_type", "location"), layer="reference"),
}
