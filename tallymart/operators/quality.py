"""Data-quality checks. Each yields the failing rows: none means the check passes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Score ranges of the two instruments.
SCALES = {"K10+": (10, 50), "SDQ": (0, 40)}


def any_of(conditions: Sequence[Column]) -> Column:
    combined = conditions[0]
    for condition in conditions[1:]:
        combined = combined | condition
    return combined


# Row conditions: true on a failing row. They can be counted together in one pass over a table.


def is_missing(column: str) -> Column:
    return F.col(column).isNull()


def not_accepted(column: str, values: Sequence) -> Column:
    return ~F.col(column).isin(*values)


def dates_out_of_order() -> Column:
    referral, first, end = F.col("referral_date"), F.col("first_contact_date"), F.col("episode_end_date")
    return (first < referral) | (end < referral) | (end < first)


def outside_scale(scales: Mapping[str, tuple[int, int]] = SCALES) -> Column:
    """Score beyond the range of its own instrument; other instruments are not judged here."""
    score = F.col("score")
    return any_of([(F.col("measure") == name) & ~score.between(low, high) for name, (low, high) in scales.items()])


def rate_out_of_bounds(*columns: str) -> Column:
    return any_of([~F.col(column).between(0, 1) for column in columns])


# Checks that need a key to meet.


def duplicate_keys(df: DataFrame, columns: Sequence[str], *, count_nulls: bool = True, count: str = "n") -> DataFrame:
    """Keys with more than one row. Null is a value of its own unless ``count_nulls`` is off."""
    rows = df if count_nulls else df.dropna(subset=list(columns))
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias(count)).filter(F.col(count) > 1)


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_column: str | None = None) -> DataFrame:
    """Rows whose non-null key has no parent row."""
    parents = parent.select(F.col(parent_column or column).alias("_parent"))
    return df.filter(F.col(column).isNotNull()).join(parents, F.col(column) == F.col("_parent"), "left_anti")


def unmapped(df: DataFrame, column: str, parent: DataFrame) -> DataFrame:
    """Rows without a parent row, a null key included."""
    return df.join(parent.select(column), column, "left_anti")


def contacts_outside_episode(contacts: DataFrame, episodes: DataFrame, extract_date: dt.date) -> DataFrame:
    """Contacts before the first contact or after the end (the extract date while open)."""
    joined = contacts.select("contact_id", "episode_id", "contact_date").join(
        episodes.select("episode_id", "first_contact_date", "episode_end_date"), "episode_id"
    )
    last_day = F.coalesce("episode_end_date", F.lit(extract_date))
    return joined.filter(
        (F.col("contact_date") < F.col("first_contact_date")) | (F.col("contact_date") > last_day)
    ).select("contact_id", "contact_date", "first_contact_date", "episode_end_date")


def repeated_contact_days(contacts: DataFrame) -> DataFrame:
    return duplicate_keys(contacts, ["episode_id", "contact_date"], count="contacts")


def first_contact_without_record(episodes: DataFrame, contacts: DataFrame) -> DataFrame:
    """Contacted episodes without a contact on the stated first day."""
    recorded = contacts.select("episode_id", F.col("contact_date").alias("first_contact_date"))
    return (
        episodes.filter(F.col("first_contact_date").isNotNull())
        .select("episode_id", "first_contact_date")
        .join(recorded, ["episode_id", "first_contact_date"], "left_anti")
        .select("episode_id")
    )


def incomplete_years(areas: DataFrame, area_map: DataFrame, area: str = "area_code") -> DataFrame:
    """Years whose number of areas differs from the area map's."""
    expected = area_map.agg(F.count(F.lit(1))).scalar()
    return (
        areas.groupBy("fy_end_year").agg(F.count_distinct(area).alias("areas")).filter(F.col("areas") != expected)
    )


def wrong_row_count(trend: DataFrame, geographies: Sequence[str], expected: int) -> DataFrame:
    """One row with the count of published rates for these geographies, when it is not ``expected``."""
    counted = trend.filter(F.col("geography_code").isin(*geographies) & F.col("rate").isNotNull()).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    return counted.filter(F.col("row_count") != expected)


RECONCILE_KEY = ("indicator_code", "geography_code", "fy_end_year", "category")


def published_series(rates: DataFrame, published: DataFrame, category: str) -> DataFrame:
    """The rates of those geographies and categories for which a value is published, all years of each.

    A series must be whole for its prior and baseline values, so the year is no part of the choice.
    """
    named = published.select("geography_code", F.col("category").alias(category)).distinct()
    return rates.join(named, ["geography_code", category], "left_semi")


def unreconciled(published: DataFrame, trends: Mapping[str, DataFrame], tolerance: float) -> DataFrame:
    """Published values the marts miss by more than ``tolerance`` or do not have.

    ``trends`` maps each trend's category column to the trend.
    """
    modelled = None
    for category, trend in trends.items():
        part = trend.select(
            "indicator_code",
            "geography_code",
            "fy_end_year",
            F.col(category).alias("category"),
            F.col("rate").alias("modelled_value"),
        )
        modelled = part if modelled is None else modelled.unionByName(part)
    gap = F.abs(F.col("modelled_value") - F.col("published_value"))
    return published.join(modelled, list(RECONCILE_KEY), "left").filter(
        F.col("modelled_value").isNull() | (gap > F.lit(tolerance))
    )


def drift(committed: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """Rows of only one side, copies counted, marked with the side they are on.

    Rows are counted by a 128-bit digest first, which is all that the first shuffle carries; whole rows travel where a
    digest is out of balance.
    """
    columns = committed.columns
    sides = committed.withColumn("_side", F.lit(1)).unionByName(rebuilt.select(*columns).withColumn("_side", F.lit(-1)))
    sides = sides.withColumn("_digest", _row_digest(sides, columns))
    uneven = sides.groupBy("_digest").agg(F.sum("_side").alias("_surplus")).filter("_surplus <> 0").select("_digest")
    sides = sides.join(uneven, "_digest", "left_semi")
    balance = sides.groupBy(*columns).agg(F.sum("_side").cast("long").alias("_surplus")).filter("_surplus <> 0")
    return balance.select(
        F.when(F.col("_surplus") > 0, F.lit("committed only")).otherwise(F.lit("rebuilt only")).alias("side"),
        F.abs("_surplus").alias("copies"),
        *columns,
    )


def _row_digest(df: DataFrame, columns: Sequence[str]) -> Column:
    """MD5 of a row's values; zero and minus zero are one value, as in a group."""
    kinds = dict(df.dtypes)
    values = [F.col(c) + F.lit(0).cast(kinds[c]) if kinds[c] in ("double", "float") else F.col(c) for c in columns]
    texts = [v.cast("string") if "<" not in kinds[c] else F.to_json(v) for c, v in zip(columns, values, strict=True)]
    return F.unhex(F.md5(F.to_json(F.array(*texts))))


# The suite.


@dataclass(frozen=True)
class Check:
    """One named check of a table: a row condition, or a function to its failing rows, which may need more tables.

    ``key`` says that the check asks for a key that no two rows share (null keys too, with ``nulls``), or that a row of
    ``parent`` (table and column) has; such checks are counted with others in one pass.
    """

    name: str
    table: str
    condition: Column | None = None
    failing: Callable[[Mapping[str, DataFrame]], DataFrame] | None = None
    needs: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    nulls: bool = True
    parent: tuple[str, str] | None = None

    def __post_init__(self):
        if (self.condition is None) == (self.failing is None):
            raise ValueError(f"check {self.name}: give a row condition or a failing-rows function")

    def rows(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        return tables[self.table].filter(self.condition) if self.failing is None else self.failing(tables)


def not_null(table: str, *columns: str) -> list[Check]:
    return [Check(f"not_null_{table}_{c}", table, condition=is_missing(c)) for c in columns]


def accepted(table: str, column: str, values: Sequence) -> Check:
    return Check(f"accepted_values_{table}_{column}", table, condition=not_accepted(column, values))


def unique(table: str, column: str) -> Check:
    return Check(
        f"unique_{table}_{column}",
        table,
        failing=lambda t: duplicate_keys(t[table], [column], count_nulls=False),
        key=(column,),
        nulls=False,
    )


def unique_combination(table: str, *columns: str) -> Check:
    return Check(
        f"unique_combination_{table}", table, failing=lambda t: duplicate_keys(t[table], columns), key=columns
    )


def related(table: str, column: str, parent: str, parent_column: str | None = None) -> Check:
    return Check(
        f"relationships_{table}_{column}",
        table,
        failing=lambda t: orphans(t[table], column, t[parent], parent_column),
        needs=(parent,),
        key=(column,),
        nulls=False,
        parent=(parent, parent_column or column),
    )


def _audited(table: DataFrame, name: str, checks: Sequence[tuple[int, Check]]) -> DataFrame | None:
    """What the numbered checks ask of a table, in one pass: (number, key, rows, parents), one row for each key that a row
    holds or is parent to, and for each row condition that it fails."""

    def asked(number: int, columns: Sequence[str], nulls: bool, rows: int, parents: int) -> Column:
        key = F.to_json(F.array(*[F.col(c).cast("string") for c in columns]))
        held = F.lit(True) if nulls else F.col(columns[0]).isNotNull()
        return F.when(held, F.struct(F.lit(number), key, F.lit(rows), F.lit(parents)))

    found = []
    for number, check in checks:
        if check.condition is not None and check.table == name:
            found.append(F.when(check.condition, F.struct(F.lit(number), F.lit(""), F.lit(1), F.lit(0))))
        if check.key and check.table == name:
            found.append(asked(number, check.key, check.nulls, 1, 0))
        if check.parent and check.parent[0] == name:
            found.append(asked(number, check.parent[1:], False, 0, 1))
    if not found:
        return None
    kind = "array<struct<number:int,key:string,rows:int,parents:int>>"
    every = F.filter(F.array(*found).cast(kind), lambda x: x.isNotNull())
    return table.select(F.explode(every).alias("asked")).select("asked.*")


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """Report with the number of failing rows per check.

    Each table is read once for all its row conditions and keys, whether they must be unique in it, have a parent, or be
    one. A key that fills a third of a table is counted within its tasks before the shuffle; nothing is joined. Every
    other check is one count. Only counts reach the report, never rows. No checks give an empty report.
    """
    spark, schema = SparkSession.active(), "check string, table string, failures long"
    parts = [spark.createDataFrame([(c.name, c.table, 0) for c in checks], schema)]
    numbered = [(k, c) for k, c in enumerate(checks) if c.condition is not None or c.key]
    names = dict.fromkeys(n for _, c in numbered for n in (c.table, *(c.parent[:1] if c.parent else ())))
    asked = [found for n in names if (found := _audited(tables[n], n, numbered)) is not None]
    if asked:
        every = asked[0]
        for more in asked[1:]:
            every = every.unionByName(more)
        keys = every.groupBy("number", "key").agg(F.sum("rows").alias("rows"), F.max("parents").alias("parents"))
        numbers = {
            kind: [k for k, c in numbered if wanted(c)]
            for kind, wanted in (
                ("condition", lambda c: c.condition is not None),
                ("parent", lambda c: c.parent is not None),
            )
        }
        failing = (
            F.when(F.col("number").isin(*numbers["condition"]), F.col("rows"))
            .when(F.col("number").isin(*numbers["parent"]), F.when(F.col("parents") == 0, F.col("rows")).otherwise(0))
            .otherwise((F.col("rows") > 1).cast("long"))
        )
        label = F.array(*[F.struct(F.lit(c.name).alias("check"), F.lit(c.table).alias("table")) for c in checks])
        counts = keys.groupBy("number").agg(F.sum(failing).alias("failures"))
        counts = counts.withColumn("label", F.get(label, F.col("number")))
        parts.append(counts.select("label.check", "label.table", "failures"))
    for check in checks:
        if check.condition is None and not check.key:
            counts = check.failing(tables).agg(F.count(F.lit(1)).alias("failures"))
            parts.append(counts.select(F.lit(check.name).alias("check"), F.lit(check.table).alias("table"), "failures"))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report.groupBy("check", "table").agg(F.sum("failures").cast("long").alias("failures"))


class QualityGateError(RuntimeError):
    """A check failed. ``held`` tables keep their last version, ``skipped`` ones read these and were not built."""

    def __init__(self, message: str, held: Sequence[str] = (), skipped: Sequence[str] = ()):
        super().__init__(message)
        self.held, self.skipped = tuple(held), tuple(skipped)


def gate_message(failed: Mapping[str, int]) -> str:
    return "; ".join(f"{name}: {n} failing rows" for name, n in sorted(failed.items()))


def gate(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> list[tuple[str, str, int]]:
    """Run the checks and stop on a failure. One row per check reaches the driver."""
    results = [(r["check"], r["table"], r["failures"]) for r in run_checks(tables, checks).collect()]
    failed = {name: n for name, _, n in results if n}
    if failed:
        raise QualityGateError(gate_message(failed))
    return results
