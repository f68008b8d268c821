"""The whole build: raw files -> typed tables -> checks -> marts -> checks -> exports."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.operators import cleaning, dimensions, fact, indicators, kpis, quality, rollups
from tallymart.operators.quality import (
    Check,
    QualityGateError,
    accepted,
    not_null,
    related,
    unique,
    unique_combination,
)
from tallymart.operators.scoping import ScopeSpec, require_complete, scope_release
from tallymart.params import Params
from tallymart.plans import packs
from tallymart.session import materialise
from tallymart.sources import schemas
from tallymart.sources.readers import read_csv, read_folder, read_release, read_text
from tallymart.sources.writers import (
    Export,
    create_layers,
    export_marts,
    new_run,
    publish_view,
    swap_version,
    write_version,
)

ED, PPH = "lower_urgency_ed", "pph"


def stage(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "episodes": cleaning.clean_episodes(raw["fact_episode"]),
        "contacts": cleaning.clean_contacts(raw["fact_service_contact"]),
        "measures": cleaning.clean_measures(raw["fact_outcome_measure"]),
        "providers": cleaning.clean_providers(raw["dim_provider"]),
        "subregions": cleaning.clean_subregions(raw["dim_subregion"]),
        "area_map": cleaning.clean_area_map(raw["map_sa3_subregion"]),
        ED: cleaning.clean_indicator(raw[ED], packs.ED_SPEC),
        PPH: cleaning.clean_indicator(raw[PPH], packs.PPH_SPEC),
    }


def staging_checks(params: Params) -> list[Check]:
    levels = (
        params.codes.national_level,
        params.codes.unit_level,
        params.codes.group_level,
        params.codes.area_level,
    )
    return [
        unique("providers", "provider_code"),
        *not_null("providers", "provider_code"),
        accepted("providers", "program_type", packs.PROGRAM_TYPES),
        related("providers", "subregion", "subregions"),
        unique("subregions", "subregion"),
        *not_null("subregions", "subregion", "population_2023"),
        unique("area_map", "area_name"),
        *not_null("area_map", "area_name"),
        related("area_map", "subregion", "subregions"),
        unique("episodes", "episode_id"),
        *not_null("episodes", "episode_id", "provider_code", "referral_date"),
        related("episodes", "provider_code", "providers"),
        accepted("episodes", "completion_status", packs.STATUSES),
        accepted("episodes", "iar_level", range(1, 6)),
        unique("contacts", "contact_id"),
        *not_null("contacts", "contact_id"),
        related("contacts", "episode_id", "episodes"),
        unique("measures", "measure_id"),
        *not_null("measures", "measure_id", "collection_occasion"),
        related("measures", "episode_id", "episodes"),
        accepted("measures", "measure", tuple(quality.SCALES)),
        accepted("measures", "collection_occasion", ("start", "end")),
        unique_combination("measures", "episode_id", "collection_occasion"),
        accepted(ED, "geography_level", levels),
        *not_null(ED, "measure_type"),
        unique_combination(ED, *packs.ED_SPEC.key),
        accepted(PPH, "geography_level", levels),
        accepted(PPH, "measure_type", tuple(packs.PPH_MEASURES.values())),
        *not_null(PPH, "measure_type"),
        accepted(PPH, "demographic_group", ("All persons", "0-64", "65+")),
        unique_combination(PPH, *packs.PPH_SPEC.key),
        accepted("service_locations", "service_type", tuple(packs.SERVICE_TYPES.values())),
        unique("framework_indicator_spec", "indicator_code"),
        *not_null("framework_indicator_spec", "indicator_code"),
        Check("episode_dates_in_order", "episodes", condition=quality.dates_out_of_order()),
        Check("scores_within_scale", "measures", condition=quality.outside_scale()),
        Check(
            "contacts_within_episode",
            "contacts",
            failing=lambda t: quality.contacts_outside_episode(t["contacts"], t["episodes"], params.extract_date),
            needs=("episodes",),
        ),
        Check(
            "one_contact_per_episode_day",
            "contacts",
            failing=lambda t: quality.repeated_contact_days(t["contacts"]),
        ),
        Check(
            "first_contact_has_record",
            "episodes",
            failing=lambda t: quality.first_contact_without_record(t["episodes"], t["contacts"]),
            needs=("contacts",),
        ),
        Check(
            "service_locations_mapped",
            "service_locations",
            failing=lambda t: quality.unmapped(t["service_locations"], "area_name", t["area_map"]),
            needs=("area_map",),
        ),
    ]


@dataclass(frozen=True)
class Mart:
    """A mart, the tables it reads, and how it is made of them."""

    name: str
    inputs: tuple[str, ...]
    make: Callable[[Mapping[str, DataFrame], Params], DataFrame]


def _service_reach(t: Mapping[str, DataFrame], params: Params) -> DataFrame:
    return kpis.service_reach(
        t["fct_episode"],
        t["dim_provider"],
        t["dim_subregion"],
        t[ED],
        t["area_map"],
        params,
        level=params.codes.area_level,
        triage=packs.LOWER_URGENCY_TRIAGE,
        presentations=packs.ALL_HOURS_NUMBER,
        population=packs.POPULATION,
    )


def _benchmark(t: Mapping[str, DataFrame], params: Params) -> DataFrame:
    # The benchmark reads the all-hours rows of the full label, whose staged band is 'All-hours'.
    full_label = (
        (F.col("measure_name") == packs.ALL_HOURS_RATE)
        & (F.col("triage_category") == packs.LOWER_URGENCY_TRIAGE)
        & (F.col("hour_band") == packs.ALL_HOURS)
    )
    return indicators.benchmark_unit(t[ED].filter(full_label).withColumnRenamed("measure_value", "rate"), params.codes)


def _area_table(t: Mapping[str, DataFrame], params: Params) -> DataFrame:
    return rollups.area_table(
        t[ED], t["area_map"], packs.AREA_COLUMNS, params.codes.area_level, packs.LOWER_URGENCY_TRIAGE
    )


def _band_trend(t: Mapping[str, DataFrame], params: Params) -> DataFrame:
    rates = indicators.rates_by_band(t[ED], params.codes, packs.LOWER_URGENCY_TRIAGE, packs.BAND_SEPARATOR)
    return indicators.indicator_trend(rates, "hour_band", "IM-02", params.codes)


def _category_trend(t: Mapping[str, DataFrame], params: Params) -> DataFrame:
    rates = indicators.rates_by_category(t[PPH], params.codes, packs.PPH_TOTALS)
    return indicators.indicator_trend(rates, "pph_category", "IM-01", params.codes)


def _all_hours(t: Mapping[str, DataFrame]) -> DataFrame:
    return t["im02_lower_urgency"].filter(F.col("hour_band") == packs.ALL_HOURS)


def _total(t: Mapping[str, DataFrame]) -> DataFrame:
    return t["im01_pph"].filter(F.col("pph_category") == "PPH")


def _area_trend(t: Mapping[str, DataFrame], params: Params) -> DataFrame:
    rates = indicators.area_rates(t[PPH], t["area_map"], params.codes)
    return indicators.area_trend(rates, indicators.yearly_references(_total(t), params.codes))


def _hotspots(t: Mapping[str, DataFrame], params: Params) -> DataFrame:
    references = indicators.yearly_references(_all_hours(t), params.codes)
    return indicators.area_hotspots(
        t["lower_urgency_ed_sa3"], references, t["service_locations"], packs.SERVICE_TYPES, params
    )


MARTS = (
    Mart("dim_provider", ("providers", "subregions"), lambda t, p: dimensions.dim_provider(t["providers"], t["subregions"])),
    Mart("dim_subregion", ("subregions", "area_map"), lambda t, p: dimensions.dim_subregion(t["subregions"], t["area_map"])),
    Mart(
        "fct_episode",
        ("episodes", "episode_outcomes", "episode_contacts"),
        lambda t, p: fact.build_episode_fact(t["episodes"], t["episode_outcomes"], t["episode_contacts"], p),
    ),
    Mart(
        "kpi_provider_quarterly",
        ("fct_episode", "dim_provider"),
        lambda t, p: kpis.kpi_quarterly(t["fct_episode"], t["dim_provider"]),
    ),
    Mart(
        "kpi_provider_scorecard",
        ("fct_episode", "dim_provider"),
        lambda t, p: kpis.kpi_scorecard(t["fct_episode"], t["dim_provider"], p),
    ),
    Mart(
        "subregion_service_reach", ("fct_episode", "dim_provider", "dim_subregion", ED, "area_map"), _service_reach
    ),
    Mart("lower_urgency_ed_benchmark", (ED,), _benchmark),
    Mart("lower_urgency_ed_sa3", (ED, "area_map"), _area_table),
    Mart("im02_lower_urgency", (ED,), _band_trend),
    Mart("im01_pph", (PPH,), _category_trend),
    Mart("im01_sa3", (PPH, "area_map", "im01_pph"), _area_trend),
    Mart("im01_conditions", (PPH,), lambda t, p: indicators.condition_gaps(t[PPH], p.codes)),
    Mart("im01_age", (PPH,), lambda t, p: indicators.age_trend(t[PPH], p.codes)),
    Mart("im02_sa3_hotspots", ("lower_urgency_ed_sa3", "im02_lower_urgency", "service_locations"), _hotspots),
    Mart(
        "peer_comparison",
        ("im02_lower_urgency", "im01_pph"),
        lambda t, p: indicators.peer_comparison([_all_hours(t), _total(t)], p.codes),
    ),
    Mart(
        "criteria_check",
        ("im02_lower_urgency", "im01_pph"),
        lambda t, p: indicators.criteria_check(_all_hours(t), _total(t), p),
    ),
)


def mart_waves(marts: Sequence[Mart] = MARTS) -> list[list[Mart]]:
    """Marts by how many other marts lie below them: a wave reads earlier waves only."""
    depth: dict[str, int] = {}
    for mart in marts:  # each stands behind those it reads
        depth[mart.name] = 1 + max((depth[i] for i in mart.inputs if i in depth), default=-1)
    return [[m for m in marts if depth[m.name] == d] for d in range(max(depth.values(), default=-1) + 1)]


def mart_checks(
    params: Params, *, units: int = 31, peers: int = 16, band_rows: int = 48, category_rows: int = 56
) -> list[Check]:
    """Checks of the marts; the counts are what complete releases of the two packs hold."""
    codes = params.codes
    both = (codes.unit, codes.national)
    peer_groups = (codes.national_level, "Metropolitan", "Regional")
    return [
        unique("dim_provider", "provider_code"),
        *not_null("dim_provider", "provider_code"),
        unique("dim_subregion", "subregion"),
        *not_null("dim_subregion", "subregion", "area_count"),
        unique("fct_episode", "episode_id"),
        *not_null("fct_episode", "episode_id"),
        related("fct_episode", "provider_code", "dim_provider"),
        unique_combination("kpi_provider_quarterly", "provider_code", "quarter"),
        unique("kpi_provider_scorecard", "provider_code"),
        *not_null("kpi_provider_scorecard", "provider_code"),
        accepted("kpi_provider_scorecard", "wait_status", ("On target", "Below target")),
        unique("subregion_service_reach", "subregion"),
        *not_null("subregion_service_reach", "subregion", "presentations"),
        unique("lower_urgency_ed_benchmark", "fy_end_year"),
        *not_null("lower_urgency_ed_benchmark", "fy_end_year"),
        accepted("lower_urgency_ed_benchmark", "unit_count", (units,)),
        unique_combination("lower_urgency_ed_sa3", "fy_end_year", "area_code"),
        unique_combination("im02_lower_urgency", "geography_code", "fy_end_year", "hour_band"),
        accepted("im02_lower_urgency", "hour_band", ("All-hours", "In-hours", "After-hours")),
        accepted("im02_lower_urgency", "peer_group", peer_groups),
        *not_null("im02_lower_urgency", "rate"),
        unique("im02_sa3_hotspots", "area_code"),
        *not_null("im02_sa3_hotspots", "area_code", "rank_highest_first"),
        unique_combination("criteria_check", "indicator_code", "criterion_level", "fy_end_year"),
        accepted("criteria_check", "pack_status", ("Met", "Watch", "Not met")),
        unique_combination("peer_comparison", "indicator_code", "geography_code"),
        accepted("peer_comparison", "peer_count", (peers,)),
        unique_combination("im01_pph", "geography_code", "fy_end_year", "pph_category"),
        accepted("im01_pph", "pph_category", ("PPH", "acute", "chronic", "vaccine-preventable")),
        accepted("im01_pph", "peer_group", peer_groups),
        unique_combination("im01_conditions", "pph_group", "pph_condition"),
        unique_combination("im01_sa3", "area_code", "fy_end_year"),
        *not_null("im01_sa3", "rate"),
        unique_combination("im01_age", "geography_code", "age_group", "fy_end_year"),
        *not_null("im01_age", "crude_rate"),
        Check(
            "kpi_rates_between_0_and_1",
            "kpi_provider_quarterly",
            condition=quality.rate_out_of_bounds("followup_7day_rate", "outcome_collection_rate"),
        ),
        Check(
            "ed_areas_each_year",
            "lower_urgency_ed_sa3",
            failing=lambda t: quality.incomplete_years(t["lower_urgency_ed_sa3"], t["area_map"]),
            needs=("area_map",),
        ),
        Check(
            "pph_areas_each_year",
            "im01_sa3",
            failing=lambda t: quality.incomplete_years(t["im01_sa3"], t["area_map"]),
            needs=("area_map",),
        ),
        Check(
            "pph_rows_complete",
            "im01_pph",
            failing=lambda t: quality.wrong_row_count(t["im01_pph"], both, category_rows),
        ),
        Check(
            "ed_rows_complete",
            "im02_lower_urgency",
            failing=lambda t: quality.wrong_row_count(t["im02_lower_urgency"], both, band_rows),
        ),
        Check(
            "reconciles_to_published",
            "published_reference_values",
            failing=lambda t: quality.unreconciled(
                t["published_reference_values"],
                {"hour_band": t["im02_lower_urgency"], "pph_category": t["im01_pph"]},
                params.tolerance,
            ),
            needs=("im02_lower_urgency", "im01_pph"),
        ),
    ]


def read_raw(spark: SparkSession, service: str, seeds: str, ed_extract: str, pph_extract: str) -> dict[str, DataFrame]:
    """The raw tables: two folders of CSV files and the two scoped extracts."""
    raw = read_folder(spark, service, schemas.SERVICE_TABLES) | read_folder(spark, seeds, schemas.SEEDS)
    raw[ED], raw[PPH] = read_text(spark, ed_extract), read_text(spark, pph_extract)
    return raw


def read_releases(
    spark: SparkSession,
    ed_release: str,
    pph_release: str,
    ed_scope: ScopeSpec = packs.ED_SCOPE,
    pph_scope: ScopeSpec = packs.PPH_SCOPE,
) -> dict[str, DataFrame]:
    """Both extracts straight from the full releases, or an error naming what a release lacks.

    They may replace the extracts in ``build``'s raw tables, or be written with ``write_extract``.
    A release is parsed once: the check and the build read what is in scope.
    """
    return {
        name: require_complete(materialise(scope_release(read_release(spark, path), scope)), scope)
        for name, path, scope in ((ED, ed_release, ed_scope), (PPH, pph_release, pph_scope))
    }


EPISODE_TABLES = ("episodes", "contacts", "measures")
# The intermediate layer: each view, the staging table it rolls up, and its SQL.
VIEWS = {
    "episode_contacts": ("contacts", rollups.CONTACT_ROLLUP),
    "episode_outcomes": ("measures", rollups.OUTCOME_PIVOT),
}


class Build:
    """One run: tables are written beside the current ones, checked, and take their place if they pass.

    A check runs as soon as the tables it reads are there. If it fails, the tables of the same wave that it reads are
    held back: their last version stays, and so does that of every table that reads them. All others go on.
    """

    def __init__(self, spark: SparkSession, checks: Sequence[Check]):
        self.spark, self.run, self.waiting = spark, new_run(), list(checks)
        self.tables: dict[str, DataFrame] = {}
        self.failed: dict[str, int] = {}
        self.held: list[str] = []
        self.skipped: list[str] = []

    def wave(self, layer: str, frames: Mapping[str, DataFrame], layouts: Mapping[str, dict] = {}, stored: bool = True):
        """Write tables of a layer (or only check them, if not ``stored``) and publish those that pass."""
        new = dict(frames)
        if stored:
            new = {n: write_version(df, layer, n, self.run, **layouts.get(n, {})) for n, df in frames.items()}
        known = self.tables | new
        due = [c for c in self.waiting if {c.table, *c.needs} <= known.keys()]
        self.waiting = [c for c in self.waiting if c not in due]
        counts = {r["check"]: r["failures"] for r in quality.run_checks(known, due).collect()} if due else {}
        self.failed |= {name: n for name, n in counts.items() if n}
        blamed = {t for c in due if counts[c.name] for t in (c.table, *c.needs)}
        for name, df in new.items():
            if name in blamed:
                self.held.append(name)
            else:
                self.tables[name] = swap_version(self.spark, layer, name, self.run) if stored else df

    def ready(self, name: str, inputs: Sequence[str]) -> bool:
        """Whether all inputs are there; a table whose inputs were held back or skipped is skipped."""
        if all(i in self.tables for i in inputs):
            return True
        self.skipped.append(name)
        return False

    def close(self) -> None:
        if self.failed:
            message = quality.gate_message(self.failed)
            raise QualityGateError(message, held=sorted(self.held), skipped=sorted(self.skipped))


def build(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    params: Params,
    export_to: str | None = None,
    *,
    staging_tables: bool = True,
    episode_buckets: int | None = None,
    checks_on_marts: list[Check] | None = None,
) -> dict[str, DataFrame]:
    """Stage, check and publish layer by layer, then export the marts that were replaced.

    A failing check holds back its table and whatever reads it; these keep their last version, all others are
    replaced. The error that names the failed checks comes at the end. Staging is written once by default: otherwise
    every check and mart parses the raw files again, and neither staging nor the intermediate views are published.
    ``episode_buckets`` buckets the three episode tables by episode, so that their rollups, joins and key checks do
    not shuffle; the indicators are partitioned by year.
    """
    create_layers(spark)
    on_marts = mart_checks(params) if checks_on_marts is None else checks_on_marts
    job = Build(spark, [*staging_checks(params), *on_marts])
    seeds = {name: raw[name] for name in schemas.SEEDS if name != "service_locations"}
    job.wave("reference", seeds)
    services = write_version(raw["service_locations"], "reference", "service_locations", job.run)
    swap_version(spark, "reference", "service_locations", job.run)

    staged = stage(raw) | {"service_locations": cleaning.clean_services(services)}
    layouts = {name: {"partition_by": ["fy_end_year"]} for name in (ED, PPH)}
    if episode_buckets:
        layouts |= {name: {"bucket_by": "episode_id", "buckets": episode_buckets} for name in EPISODE_TABLES}
    job.wave("staging", staged, layouts, stored=staging_tables)

    for name, (source, query) in VIEWS.items():
        if job.ready(name, [source]):
            if staging_tables:
                job.tables[name] = publish_view(spark, "intermediate", name, query.format(source=f"staging.{source}"))
            else:
                job.tables[name] = spark.sql(query, source=job.tables[source])
    for wave in mart_waves():
        job.wave("marts", {m.name: m.make(job.tables, params) for m in wave if job.ready(m.name, m.inputs)})
    if export_to:
        export_marts(spark, export_to, {n: e for n, e in packs.EXPORTS.items() if e.table in job.tables})
    job.close()
    return {m.name: job.tables[m.name] for m in MARTS}


def export_drift(
    spark: SparkSession, folder: str, exports: Mapping[str, Export] = packs.EXPORTS
) -> dict[str, DataFrame]:
    """For each export, the rows by which the files in ``folder`` differ from the current marts."""
    found = {}
    for name, export in exports.items():
        current = spark.table(f"{export.layer}.{export.table}").withColumnsRenamed(dict(export.rename))
        found[name] = quality.drift(read_csv(spark, f"{folder.rstrip('/')}/{name}", current.schema), current)
    return found
