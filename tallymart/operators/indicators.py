"""Published-indicator marts: trends, benchmarks, hotspots, peers and criteria.

A rates table has one row per geography, category and year after cleaning. Windows here are over a
series (as many rows as years) or over the published units of a year (a fixed list); anything per
area, whose number follows the data, is ranked with ``spread_rank`` instead.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.functions.aggregates import any_where, count_where, max_where
from tallymart.functions.columns import first_match, half_away, pct_change, ratio
from tallymart.functions.tables import spread_rank
from tallymart.params import GeographyCodes, Params
from tallymart.session import materialise

RATE_COLUMNS = (
    "fy_end_year",
    "financial_year",
    "geography_level",
    "geography_code",
    "geography_name",
    "geographic_group",
)


def rates_by_band(indicator: DataFrame, codes: GeographyCodes, triage: str, separator: str) -> DataFrame:
    """Age-standardised rates by hour band; the band is the measure name up to ``separator``."""
    levels = (codes.national_level, codes.unit_level, codes.group_level)
    return indicator.filter(
        (F.col("measure_type") == "rate_age_standardised")
        & (F.col("triage_category") == triage)
        & F.col("geography_level").isin(*levels)
    ).select(
        *RATE_COLUMNS,
        F.split_part(F.col("measure_name"), F.lit(separator), F.lit(1)).alias("hour_band"),
        F.col("measure_value").alias("rate"),
    )


def rates_by_category(
    indicator: DataFrame, codes: GeographyCodes, totals: Sequence[str], everyone: str = "All persons"
) -> DataFrame:
    """Age-standardised rates of the condition totals for everyone."""
    levels = (codes.national_level, codes.unit_level, codes.group_level)
    return indicator.filter(
        (F.col("measure_type") == "rate_age_standardised")
        & (F.col("demographic_group") == everyone)
        & F.col("pph_condition").isin(*totals)
        & F.col("geography_level").isin(*levels)
    ).select(
        *RATE_COLUMNS,
        F.replace(F.col("pph_condition"), F.lit("Total "), F.lit("")).alias("pph_category"),
        F.col("measure_value").alias("rate"),
    )


def _peer_group(codes: GeographyCodes) -> Column:
    level = F.col("geography_level")
    return first_match(
        [
            (level == codes.unit_level, F.col("geographic_group")),
            (level == codes.group_level, F.col("geography_name")),
        ],
        otherwise=F.lit(codes.national_level),
    )


def indicator_trend(rates: DataFrame, category: str, indicator_code: str, codes: GeographyCodes) -> DataFrame:
    """Each series with its prior row, its first row and the percent change from both.

    Prior and baseline are rows of the series, not named years: a series with a gap compares with
    the year before the gap, one that starts late with its own first year.
    """
    series = Window.partitionBy("geography_code", category).orderBy(F.asc_nulls_last("fy_end_year"))
    rate = F.col("rate")
    return rates.withColumns(
        {"prior_year_rate": F.lag("rate").over(series), "baseline_rate": F.first("rate").over(series)}
    ).select(
        F.lit(indicator_code).alias("indicator_code"),
        "financial_year",
        "fy_end_year",
        "geography_level",
        "geography_code",
        "geography_name",
        _peer_group(codes).alias("peer_group"),
        (F.col("geography_code") == codes.unit).alias("is_reported_unit"),
        F.col("geography_code").isin(*codes.neighbours).alias("is_neighbour"),
        category,
        "rate",
        "prior_year_rate",
        pct_change(rate, F.col("prior_year_rate")).alias("change_pct_year_on_year"),
        "baseline_rate",
        pct_change(rate, F.col("baseline_rate")).alias("change_pct_since_baseline"),
    )


def age_trend(
    indicator: DataFrame, codes: GeographyCodes, condition: str = "Total PPH", bands: Sequence[str] = ("0-64", "65+")
) -> DataFrame:
    """Crude rates by age band for the unit, its peer group and the nation."""
    rows = indicator.filter(
        (F.col("measure_type") == "rate_crude")
        & (F.col("pph_condition") == condition)
        & F.col("demographic_group").isin(*bands)
        & F.col("geography_code").isin(codes.unit, codes.peer_group, codes.national)
    )
    series = Window.partitionBy("geography_code", "demographic_group").orderBy(F.asc_nulls_last("fy_end_year"))
    value = F.col("measure_value")
    return rows.select(
        "financial_year",
        "fy_end_year",
        "geography_code",
        "geography_name",
        F.col("demographic_group").alias("age_group"),
        value.alias("crude_rate"),
        pct_change(value, F.first("measure_value").over(series)).alias("change_pct_since_baseline"),
        pct_change(value, F.lag("measure_value").over(series)).alias("change_pct_year_on_year"),
    )


def benchmark_unit(rates: DataFrame, codes: GeographyCodes) -> DataFrame:
    """One unit per year against the nation and the published units: rank, count, median, gap.

    Units without a rate that year are neither ranked nor counted. The unit's rank is one more than
    the number of units above it, so a year needs one window for the unit's rate and one aggregate,
    both on the same partitioning.
    """
    rate, year = F.col("rate"), Window.partitionBy("fy_end_year")
    is_unit = (F.col("geography_level") == codes.unit_level) & rate.isNotNull()
    is_focus = is_unit & (F.col("geography_code") == codes.unit)
    is_national = F.col("geography_level") == codes.national_level
    published = rates.filter(F.col("geography_level").isin(codes.unit_level, codes.national_level))
    yearly = (
        published.withColumn("focus_rate", F.max(F.when(is_focus, rate)).over(year))
        .groupBy("fy_end_year")
        .agg(
            max_where(F.col("financial_year"), is_focus).alias("financial_year"),
            F.max("focus_rate").alias("unit_rate"),
            max_where(rate, is_national).alias("national_rate"),
            any_where(is_national).alias("has_national"),
            F.median(F.when(is_unit, rate)).alias("unit_median_rate"),
            (count_where(is_unit & (rate > F.col("focus_rate"))) + F.lit(1)).alias("unit_rank_highest_first"),
            count_where(is_unit).alias("unit_count"),
        )
    )
    return yearly.filter(F.col("has_national") & F.col("unit_rate").isNotNull()).select(
        "financial_year",
        "fy_end_year",
        "unit_rate",
        "national_rate",
        "unit_median_rate",
        half_away(F.col("unit_rate") - F.col("national_rate"), 1).alias("gap_to_national"),
        "unit_rank_highest_first",
        "unit_count",
    )


def yearly_references(rates: DataFrame, codes: GeographyCodes) -> DataFrame:
    """The unit's and the nation's rate side by side, for years that have both rows."""
    is_unit, is_national = F.col("geography_code") == codes.unit, F.col("geography_code") == codes.national
    return (
        rates.filter(F.col("geography_code").isin(codes.unit, codes.national))
        .groupBy("fy_end_year")
        .agg(
            max_where(F.col("rate"), is_unit).alias("unit_rate"),
            max_where(F.col("rate"), is_national).alias("national_rate"),
            any_where(is_unit).alias("_unit"),
            any_where(is_national).alias("_national"),
        )
        .filter("_unit AND _national")
        .drop("_unit", "_national")
    )


def area_rates(
    indicator: DataFrame,
    area_map: DataFrame,
    codes: GeographyCodes,
    condition: str = "Total PPH",
    everyone: str = "All persons",
) -> DataFrame:
    """Age-standardised rate of one condition by area and year, for the mapped areas."""
    rows = indicator.filter(
        (F.col("geography_level") == codes.area_level)
        & (F.col("measure_type") == "rate_age_standardised")
        & (F.col("demographic_group") == everyone)
        & (F.col("pph_condition") == condition)
    )
    return rows.withColumnRenamed("geography_name", "area_name").join(area_map, "area_name").select(
        "fy_end_year",
        "financial_year",
        F.col("geography_code").alias("area_code"),
        "area_name",
        "subregion",
        F.col("measure_value").alias("rate"),
        "flag",
    )


def area_trend(areas: DataFrame, references: DataFrame) -> DataFrame:
    """Areas by year with change since their first row, both references and the rank of the year.

    ``areas`` as from ``area_rates``, ``references`` as from ``yearly_references`` (one row a year,
    the calendar bounds the broadcast). Years without both references drop out before the baseline
    is taken, so it too is a row of the result.
    """
    series = Window.partitionBy("area_code").orderBy(F.asc_nulls_last("fy_end_year"))
    kept = materialise(
        areas.join(F.broadcast(references), "fy_end_year")
        .withColumn("baseline_rate", F.first("rate").over(series))
        .withColumn("change_pct_since_baseline", pct_change(F.col("rate"), F.col("baseline_rate")))
    )
    ranked = spread_rank(kept, ["fy_end_year"], "rate", "rank_highest_first", descending=True)
    return ranked.select(
        "fy_end_year",
        "financial_year",
        "area_code",
        "area_name",
        "subregion",
        "rate",
        "flag",
        "baseline_rate",
        "change_pct_since_baseline",
        "unit_rate",
        "national_rate",
        "rank_highest_first",
    )


def condition_gaps(
    indicator: DataFrame, codes: GeographyCodes, latest_fy: Column | int | None = None, everyone: str = "All persons"
) -> DataFrame:
    """The unit's latest rates by condition beside the peer group and the nation.

    The three geographies become columns in one aggregate. A rate that is not published stays null
    with its flag, and so do the gaps from it; a condition or group without a name has none to stand beside.
    ``latest_fy`` defaults to the table's last year.
    """
    latest = indicator.agg(F.max("fy_end_year")).scalar() if latest_fy is None else latest_fy
    code, rate = F.col("geography_code"), F.col("measure_value")
    is_unit = code == codes.unit
    named = F.col("pph_group").isNotNull() & F.col("pph_condition").isNotNull()
    rows = indicator.filter(
        (F.col("measure_type") == "rate_age_standardised")
        & (F.col("demographic_group") == everyone)
        & ~F.col("is_group_total")
        & code.isin(codes.unit, codes.peer_group, codes.national)
        & (F.col("fy_end_year") == latest)
    )
    return (
        rows.groupBy("pph_group", "pph_condition")
        .agg(
            max_where(F.col("financial_year"), is_unit).alias("financial_year"),
            max_where(rate, is_unit).alias("unit_rate"),
            max_where(rate, named & (code == codes.peer_group)).alias("peer_group_rate"),
            max_where(rate, named & (code == codes.national)).alias("national_rate"),
            max_where(F.col("flag"), is_unit).alias("unit_flag"),
            any_where(is_unit).alias("_unit"),
        )
        .filter("_unit")
        .select(
            "financial_year",
            "pph_group",
            "pph_condition",
            "unit_rate",
            "peer_group_rate",
            "national_rate",
            half_away(F.col("unit_rate") - F.col("peer_group_rate"), 0).alias("gap_to_peer_group"),
            half_away(F.col("unit_rate") - F.col("national_rate"), 0).alias("gap_to_national"),
            "unit_flag",
        )
    )


def count_services(services: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Services per area name: ``types`` maps output columns to service types."""
    return services.groupBy("area_name").agg(
        *[count_where(F.col("service_type") == kind).alias(name) for name, kind in types.items()]
    )


def area_hotspots(
    areas: DataFrame, references: DataFrame, services: DataFrame, service_types: Mapping[str, str], params: Params
) -> DataFrame:
    """Areas in the latest year against the baseline year, both references and their services.

    ``areas`` as from ``area_table``, best a written table since it is read twice. The baseline is
    the named year, and an area without a row in it (or a latest year without references) drops out.
    An area under two names has a row for each; the rank over all areas (all of them in the one latest
    year) is spread.
    """
    latest = areas.agg(F.max("fy_end_year")).scalar()
    base = areas.filter(F.col("fy_end_year") == params.baseline_fy).select(
        F.col("area_code").alias("_base_code"), F.col("rate_age_standardised").alias("baseline_rate")
    )
    paired = (
        areas.filter(F.col("fy_end_year") == latest)
        .join(base, F.col("area_code") == F.col("_base_code"))
        .select(
            "fy_end_year",
            "financial_year",
            "area_code",
            "area_name",
            "subregion",
            F.col("rate_age_standardised").alias("rate"),
            "baseline_rate",
            F.col("after_hours_rate_age_standardised").alias("after_hours_rate"),
            F.col("is_flagged").alias("comparability_flag"),
        )
        .join(F.broadcast(references), "fy_end_year")
        .join(count_services(services, service_types), "area_name", "left")
    )
    ranked = spread_rank(materialise(paired), ["fy_end_year"], "rate", "rank_highest_first", descending=True)
    rate = F.col("rate")
    return ranked.select(
        "financial_year",
        "area_code",
        "area_name",
        "subregion",
        "rate",
        "baseline_rate",
        pct_change(rate, F.col("baseline_rate")).alias("change_pct_since_baseline"),
        "after_hours_rate",
        "unit_rate",
        "national_rate",
        half_away(ratio(rate, F.col("unit_rate")), 2).alias("ratio_to_unit"),
        "rank_highest_first",
        *[F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in service_types],
        ((rate > F.col("national_rate")) & (rate > F.col("baseline_rate"))).alias("is_hotspot"),
        "comparability_flag",
    )


TREND_COLUMNS = (
    "indicator_code",
    "financial_year",
    "fy_end_year",
    "geography_level",
    "geography_code",
    "geography_name",
    "peer_group",
    "is_reported_unit",
    "is_neighbour",
    "rate",
    "change_pct_since_baseline",
)


def peer_comparison(trends: Sequence[DataFrame], codes: GeographyCodes) -> DataFrame:
    """Units of the peer group in each indicator's own latest year, lowest rate first.

    A unit without a rate counts as a peer and ranks last but is left out of the median. Indicators
    whose latest year lacks the group or the national row drop out. All windows share one
    partitioning of the published units of that year.
    """
    stacked = trends[0].select(*TREND_COLUMNS)
    for trend in trends[1:]:
        stacked = stacked.unionByName(trend.select(*TREND_COLUMNS))
    indicator = Window.partitionBy("indicator_code")
    is_group, is_national = F.col("geography_code") == codes.peer_group, F.col("geography_code") == codes.national
    years = stacked.groupBy("indicator_code").agg(F.max("fy_end_year").alias("fy_end_year"))
    latest = (
        stacked.join(years, ["indicator_code", "fy_end_year"])  # only the latest year's units reach a window
        .withColumns(
            {
                "peer_group_rate": F.max(F.when(is_group, F.col("rate"))).over(indicator),
                "national_rate": F.max(F.when(is_national, F.col("rate"))).over(indicator),
                "_groups": F.count_if(is_group).over(indicator),
                "_nations": F.count_if(is_national).over(indicator),
            }
        )
    )
    return (
        latest.filter(
            (F.col("geography_level") == codes.unit_level) & (F.col("peer_group") == codes.peer_group_name)
        )
        .withColumns(
            {
                "rank_lowest_first": F.rank().over(indicator.orderBy(F.asc_nulls_last("rate"))).cast("long"),
                "peer_count": F.count(F.lit(1)).over(indicator),
                "peer_median": F.median("rate").over(indicator),
            }
        )
        .filter("_groups > 0 AND _nations > 0")
        .select(
            "indicator_code",
            "financial_year",
            "geography_code",
            "geography_name",
            "is_reported_unit",
            "is_neighbour",
            "rate",
            "change_pct_since_baseline",
            "rank_lowest_first",
            "peer_count",
            "peer_median",
            "peer_group_rate",
            "national_rate",
        )
    )


def criteria_check(unit_trend: DataFrame, national_trend: DataFrame, params: Params) -> DataFrame:
    """Yearly verdicts: the unit against the nation, and the nation against its required fall.

    ``unit_trend`` is the indicator with a unit and a national criterion, ``national_trend`` the one
    assessed nationally only, each already cut to the category under test. Rounded percentages are
    compared. 'Met': the year-on-year criterion holds; 'Watch': it does not, but the unit's fall
    since baseline still matches the nation's, which a national row can never show.
    """
    codes = params.codes
    national_met = F.col("national_change_pct_year_on_year") <= F.lit(-params.required_national_fall_pct)
    unknown_rate, unknown_flag = F.lit(None).cast("double"), F.lit(None).cast("boolean")

    def beside(trend: DataFrame) -> DataFrame:
        is_unit, is_national = F.col("geography_code") == codes.unit, F.col("geography_code") == codes.national
        sides = {"unit": is_unit, "national": is_national}
        return (
            trend.filter(F.col("geography_code").isin(codes.unit, codes.national))
            .groupBy("indicator_code", "fy_end_year")
            .agg(
                F.max("financial_year").alias("financial_year"),
                *[max_where(F.col("rate"), on).alias(f"{side}_value") for side, on in sides.items()],
                *[
                    max_where(F.col(change), on).alias(f"{side}_{change}")
                    for change in ("change_pct_year_on_year", "change_pct_since_baseline")
                    for side, on in sides.items()
                ],
                any_where(is_national).alias("_has_national"),
            )
        )

    def national_row() -> Column:
        return F.when(
            F.col("national_change_pct_year_on_year").isNotNull(),
            F.struct(
                F.lit("National").alias("criterion_level"),
                unknown_rate.alias("unit_value"),
                unknown_rate.alias("unit_change_pct_year_on_year"),
                unknown_rate.alias("unit_change_pct_since_baseline"),
                national_met.alias("is_met_year_on_year"),
                unknown_flag.alias("is_met_since_baseline"),
            ),
        )

    def unit_row() -> Column:
        met = {
            change: F.col(f"unit_{change}") <= F.col(f"national_{change}")
            for change in ("change_pct_year_on_year", "change_pct_since_baseline")
        }
        return F.when(
            F.col("_has_national") & F.col("unit_change_pct_year_on_year").isNotNull(),
            F.struct(
                F.lit(codes.unit_level).alias("criterion_level"),
                F.col("unit_value"),
                F.col("unit_change_pct_year_on_year"),
                F.col("unit_change_pct_since_baseline"),
                met["change_pct_year_on_year"].alias("is_met_year_on_year"),
                met["change_pct_since_baseline"].alias("is_met_since_baseline"),
            ),
        )

    def verdict_rows(trend: DataFrame, rows: list[Column]) -> DataFrame:
        return (
            beside(trend)
            .withColumn("row", F.explode(F.array(*rows)))
            .filter(F.col("row").isNotNull())
            .select(
                "indicator_code",
                "row.criterion_level",
                "financial_year",
                "fy_end_year",
                "row.unit_value",
                "national_value",
                "row.unit_change_pct_year_on_year",
                "national_change_pct_year_on_year",
                "row.unit_change_pct_since_baseline",
                "national_change_pct_since_baseline",
                "row.is_met_year_on_year",
                "row.is_met_since_baseline",
            )
        )

    rows = verdict_rows(unit_trend, [unit_row(), national_row()]).unionByName(
        verdict_rows(national_trend, [national_row()])
    )
    criterion = Window.partitionBy("indicator_code", "criterion_level")
    return rows.withColumns(
        {
            "pack_status": first_match(
                [
                    (F.col("is_met_year_on_year"), F.lit("Met")),
                    (F.col("is_met_since_baseline"), F.lit("Watch")),
                ],
                otherwise=F.lit("Not met"),
            ),
            "is_latest_year": F.col("fy_end_year") == F.max("fy_end_year").over(criterion),
        }
    )
