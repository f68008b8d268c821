"""Cut a published long-format release down to the rows a pack reports on."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.functions.columns import plain_dashes, with_dash_forms


class IncompleteRelease(ValueError):
    """A value the pack cannot do without is absent from the release."""


@dataclass(frozen=True)
class ScopeSpec:
    """Which rows of a release are in scope.

    Geography: every row of ``wide_levels``, plus the named ``areas`` of ``area_level`` in ``state``
    (equal to it, or containing it when ``state_contains``). Rows: the listed measures and
    ``member_of`` values, for everyone or, for conditions that are totals, an age band.
    """

    measures: tuple[str, ...]
    areas: tuple[str, ...]
    wide_levels: tuple[str, ...]
    area_level: str
    state: str
    state_contains: bool = False
    everyone: str = "All persons"
    age_bands: tuple[str, ...] = ()
    total_prefix: str = "Total"
    member_of: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    drop: tuple[str, ...] = ("Code", "DataSource", "Name")
    required_codes: tuple[str, ...] = ()
    require_measures: bool = True
    level: str = "GeographicUnit"
    code: str = "GeographicCode"
    area: str = "GeographicAreaName"
    state_column: str = "StateTerritory"
    demographic: str = "DemographicGroup"
    condition: str = "PPHCondition"
    measure: str = "MeasureName"


def in_scope(spec: ScopeSpec) -> Column:
    """The scope as one predicate on the raw columns, so a columnar scan can push it down.

    A blank state makes its comparison null, which a filter drops like false.
    """
    state = F.col(spec.state_column)
    in_state = state.contains(spec.state) if spec.state_contains else state == spec.state
    geography = F.col(spec.level).isin(*spec.wide_levels) | (
        (F.col(spec.level) == spec.area_level) & in_state & F.col(spec.area).isin(with_dash_forms(spec.areas))
    )
    people = F.col(spec.demographic) == spec.everyone
    if spec.age_bands:
        people = people | (
            F.col(spec.demographic).isin(with_dash_forms(spec.age_bands))
            & F.col(spec.condition).startswith(spec.total_prefix)
        )
    keep = geography & people & F.col(spec.measure).isin(with_dash_forms(spec.measures))
    for name, values in spec.member_of.items():
        keep = keep & F.col(name).isin(with_dash_forms(values))
    return keep


def scope_release(raw: DataFrame, spec: ScopeSpec) -> DataFrame:
    """Rows in scope, without the release-identity columns, dashes in every text column plain."""
    kept = raw.filter(in_scope(spec)).drop(*spec.drop)
    return kept.select(
        *[plain_dashes(f.name).alias(f.name) if f.dataType.typeName() == "string" else F.col(f.name) for f in kept.schema]
    )


def missing_required(scoped: DataFrame, spec: ScopeSpec) -> DataFrame:
    """Required measures, areas and unit codes without a row in the scoped release."""
    required = [("measure", v) for v in spec.measures] if spec.require_measures else []
    required += [("area", v) for v in spec.areas]
    required += [("code", v) for v in spec.required_codes]
    wanted = scoped.sparkSession.createDataFrame(required, "kind string, value string")
    # One pass: each row states what it observes; equal observations collapse before the shuffle.
    observed = scoped.select(
        F.explode(
            F.array(
                F.struct(F.lit("measure").alias("kind"), F.col(spec.measure).alias("value")),
                F.struct(
                    F.lit("area").alias("kind"),
                    F.when(F.col(spec.level) == spec.area_level, F.col(spec.area)).alias("value"),
                ),
                F.struct(F.lit("code").alias("kind"), F.col(spec.code).alias("value")),
            )
        ).alias("seen")
    ).select("seen.kind", "seen.value")
    return wanted.join(observed.filter(F.col("value").isNotNull()).distinct(), ["kind", "value"], "left_anti")


def require_complete(scoped: DataFrame, spec: ScopeSpec) -> DataFrame:
    """The scoped release unchanged, or an error naming what is absent (a list the spec bounds)."""
    absent = missing_required(scoped, spec).orderBy("kind", "value").collect()
    if absent:
        raise IncompleteRelease("missing from release: " + ", ".join(f"{r.kind} {r.value!r}" for r in absent))
    return scoped
