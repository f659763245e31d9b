"""The whole star: as one set of lazy tables, or built and kept up to date on storage."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.audit import Audit
from starloom.operators.calendar import whole_years
from starloom.operators.checks import Check, Watched, gate, refuse
from starloom.operators.checks import report as check_report
from starloom.operators.increment import arrived, load_mark, since, watermark
from starloom.operators.lookup import heavy_keys
from starloom.plans import dimensions, entities, facts, staging
from starloom.sources.bronze import EVENTS, MONTHS, REQUIRED, Bronze
from starloom.sources.lake import DIMENSIONS, ENTITIES, FACTS, STAGING, Lake, MergeReport

LAYERS = {
    STAGING: (
        "stg_telecom_customer_churn",
        "stg_telecom_zipcode_population",
        "stg_customer_monthly_snapshot",
        "stg_customer_support_events",
    ),
    ENTITIES: (
        "int_customer_profile",
        "int_customer_service_profile",
        "int_customer_financial",
        "int_customer_churn_status",
        "int_zipcode_geography",
        "int_customer_monthly_360",
        "int_support_event_enriched",
    ),
    DIMENSIONS: ("dim_customer", "dim_geography", "dim_service_profile", "dim_churn_reason", "dim_date"),
    FACTS: (facts.MONTH_FACT, facts.EVENT_FACT),
}


# Staged tables that follow their raw rows: how a staged version is made, its key and the month it is filed by.
MERGED_STAGING = {
    "stg_customer_monthly_snapshot": (staging.stg_months, MONTHS, "monthly_snapshot_id", "snapshot_month"),
    "stg_customer_support_events": (staging.stg_events, EVENTS, "support_event_id", staging.STAGED_MONTH),
}


@dataclass(frozen=True)
class HeavyKeys:
    """Customers with a large share of the months, customer-months with a large share of the events, and the
    dimension keys with a large share of the rows of each fact."""

    customers: list[str] = field(default_factory=list)
    customer_months: list[str] = field(default_factory=list)
    of_months: dict[str, list[str]] = field(default_factory=dict)
    of_events: dict[str, list[str]] = field(default_factory=dict)

    @classmethod
    def of(cls, months: DataFrame, events: DataFrame, customers: DataFrame | None = None) -> HeavyKeys:
        dated = events.withColumns(entities.event_dates())
        found = heavy_keys(months, ["customer_id"]), heavy_keys(dated, ["customer_id", "event_month"])
        if customers is None:
            return cls(*found)
        return cls(*found, *(facts.heavy_dimension_keys(rows, customers) for rows in (months, events)))


class Star(Mapping):
    """The tables of the star over a set of raw tables.

    Every table is built at most once and only when asked for. ``given`` holds tables that are
    already on storage; whatever depends on them reads them instead of recomputing them.
    """

    def __init__(
        self,
        bronze: Bronze,
        audit: Audit | None = None,
        *,
        calendar: DataFrame | None = None,
        given: Mapping[str, DataFrame] | None = None,
        heavy: HeavyKeys | None = None,
    ):
        self.bronze = bronze
        self.audit = audit or Audit.of_run()
        self._calendar = calendar
        self._tables = dict(given or {})
        self.heavy = heavy or HeavyKeys()
        self._recipes = {
            "stg_telecom_customer_churn": lambda: staging.stg_customers(bronze.customers, self.audit),
            "stg_telecom_zipcode_population": lambda: staging.stg_zips(bronze.zips, self.audit),
            "stg_customer_monthly_snapshot": lambda: staging.stg_months(bronze.months, self.audit),
            "stg_customer_support_events": lambda: staging.stg_events(bronze.events, self.audit),
            "int_customer_profile": lambda: entities.customer_profile(self.customers, self.months, self.audit),
            "int_customer_service_profile": lambda: entities.service_profile(self.customers, self.audit),
            "int_customer_financial": lambda: entities.customer_financial(self.customers, self.audit),
            "int_customer_churn_status": lambda: entities.churn_status(self.customers, self.audit),
            "int_zipcode_geography": lambda: entities.zip_geography(
                self["stg_telecom_zipcode_population"], self.customers, self.audit
            ),
            "int_customer_monthly_360": lambda: self.monthly_360(self.months),
            "int_support_event_enriched": lambda: self.enriched(self["stg_customer_support_events"]),
            "dim_customer": lambda: dimensions.dim_customer(self["int_customer_profile"], self.audit),
            "dim_geography": lambda: dimensions.dim_geography(self["int_zipcode_geography"], self.audit),
            "dim_service_profile": lambda: dimensions.dim_service_profile(
                self["int_customer_service_profile"], self.audit
            ),
            "dim_churn_reason": lambda: dimensions.dim_churn_reason(self["int_customer_churn_status"], self.audit),
            "dim_date": lambda: dimensions.dim_date(self.calendar, self.audit),
            facts.MONTH_FACT: lambda: self.month_facts(self["int_customer_monthly_360"]),
            facts.EVENT_FACT: lambda: self.event_facts(self["int_support_event_enriched"]),
        }

    def __getitem__(self, table: str) -> DataFrame:
        """A raw or derived table by name."""
        if table in self.bronze.open:
            return self.bronze[table]
        if table not in self._tables:
            self._tables[table] = self._recipes[table]()
        return self._tables[table]

    def __iter__(self) -> Iterator[str]:
        return iter([*self.bronze.open, *self._recipes])

    def __len__(self) -> int:
        return len(self.bronze.open) + len(self._recipes)

    @property
    def customers(self) -> DataFrame:
        return self["stg_telecom_customer_churn"]

    @property
    def months(self) -> DataFrame:
        return self["stg_customer_monthly_snapshot"]

    @cached_property
    def calendar(self) -> DataFrame:
        """Bounds of the calendar: as given, or the years of the months and events."""
        if self._calendar is not None:
            return self._calendar
        events = self["stg_customer_support_events"]
        return whole_years((self.months, "snapshot_month"), (events, "event_timestamp"))

    @cached_property
    def context(self) -> DataFrame:
        return entities.customer_context(self.customers, self.months, self["int_zipcode_geography"])

    def monthly_360(self, months: DataFrame) -> DataFrame:
        return entities.monthly_360(months, self.context, self.audit, self.heavy.customers)

    def enriched(self, events: DataFrame, since_day: date | None = None) -> DataFrame:
        """Events with the context of their months. When only some events are read, the months
        are first narrowed to those of the events, as literals that prune the scan."""
        months = self["int_customer_monthly_360"]
        if since_day is not None:
            # One value per calendar month: one late correction costs one old month.
            month = F.trunc(F.col("event_timestamp").cast("date"), "MM")
            met = [r[0] for r in events.filter("event_timestamp is not null").select(month).distinct().collect()]
            months = self.monthly_360(self.months.filter(F.col("snapshot_month").isin(met) if met else F.lit(False)))
        return entities.support_enriched(events, months, self.audit, self.heavy.customer_months)

    def _dimensions(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return self["dim_customer"], self["dim_geography"], self["dim_service_profile"]

    def month_facts(self, months: DataFrame) -> DataFrame:
        return facts.fact_months(months, *self._dimensions(), self.audit, self.heavy.of_months)

    def event_facts(self, events: DataFrame) -> DataFrame:
        return facts.fact_events(events, *self._dimensions(), self.audit, self.heavy.of_events)


@dataclass
class BuildReport:
    staged: dict[str, MergeReport] = field(default_factory=dict)
    bounds: dict[str, date | None] = field(default_factory=dict)
    merges: dict[str, MergeReport] = field(default_factory=dict)


# How each fact is merged: its key, its month column, and whether the key fixes the month.
MERGES = {
    facts.MONTH_FACT: dict(key=facts.MONTH_KEY, month="snapshot_month", key_fixes_month=True),
    facts.EVENT_FACT: dict(key=facts.EVENT_KEY, month="event_month", key_fixes_month=False),
}


def shown(staged: DataFrame) -> DataFrame:
    """A staged table without what is kept in it for merging."""
    return staged.drop(*staging.BOOKKEEPING)


def restage(lake: Lake, table: str, bronze: Bronze, audit: Audit, *, from_scratch: bool = False) -> MergeReport:
    """Bring a staged table up to date with the raw rows that were loaded since the last time.

    Only those rows are read and deduplicated. They replace the staged rows of their keys unless those are
    newer; the months that hold them are found by key, so what is read and written follows the batch. A raw row that was
    deleted stays staged until a run from scratch; ``quality.arrivals_staged`` reports it.
    """
    stage, source, key, month = MERGED_STAGING[table]
    lake.recover(STAGING, table)
    mark = None if from_scratch or not lake.exists(STAGING, table) else lake.mark(STAGING, table)
    news = arrived(bronze[source], mark)
    # Taken before the rows are read: what is loaded meanwhile is read again the next time.
    newest = load_mark(news, mark)
    rows, filing = stage(news, audit, merged=True), {"key": key, "month": month, "key_fixes_month": False}
    if mark is None:
        report = lake.replace(STAGING, table, rows, **filing)
    else:
        report = lake.merge(STAGING, table, rows, newer_by=tuple(staging.SOURCE_ORDER), **filing)
    lake.set_mark(STAGING, table, newest)
    return report


def refresh(
    spark: SparkSession,
    bronze: Bronze,
    lake: Lake,
    *,
    audit: Audit | None = None,
    calendar: DataFrame | None = None,
    full_refresh: bool = False,
    checks: Sequence[Check] = (),
    through: str = FACTS,
    only_facts: Sequence[str] = LAYERS[FACTS],
) -> BuildReport:
    """One run: new raw rows staged, dimensions rebuilt, facts merged from what is new.

    Staged months and events follow the raw rows loaded since the last run (:func:`restage`); the
    two master tables are staged anew, since the dimensions are rebuilt from all of them. Facts take the months
    and events stamped at or after their watermark; a full refresh rebuilds everything from all rows.

    With ``checks`` a layer is checked before the next one is built: a failed check of level
    error raises, and the later layers stay as they were. A fact is checked before it is published, with its
    merged months in place: if that fails, it stays as it was too. Row-wise checks of tables that are written in full are counted by
    the job that writes them. The entities are then written too,
    once, instead of being computed again for every check; a lake that holds them keeps them
    current. Otherwise they stay lazy views of staging.

    A part of the star can be refreshed alone: the layers ``through`` a given one, or the facts named in ``only_facts`` and
    what they read. A fact that was left out catches up later, since its watermark is its own.
    """
    if through not in LAYERS:
        raise ValueError(f"no layer {through}, there are {', '.join(LAYERS)}")
    if unknown := set(only_facts) - set(LAYERS[FACTS]):
        raise ValueError(f"no facts {', '.join(sorted(unknown))}, there are {', '.join(LAYERS[FACTS])}")
    audit = audit or Audit.of_run()
    report = BuildReport()
    # Watermarks are read from the facts, so an earlier run's publication has to be whole first.
    for layer, tables in LAYERS.items():
        for table in tables:
            lake.recover(layer, table)

    broken: list[tuple[str, int]] = []
    watched: set[str] = set()

    def pass_checks(star: Star, tables: Sequence[str]) -> None:
        """The checks of some tables, but those that were watched while a table was written."""
        refuse(broken)
        mine = [c for c in checks if c.table in tables and not (c.table in watched and c.batch == "rows")]
        if mine:
            gate(check_report(star, mine))

    def overwrite(layer: str, table: str, df: DataFrame) -> DataFrame:
        watch = Watched(table, checks)
        written = lake.overwrite(layer, table, watch.watch(df))
        broken.extend(watch.broken(written))
        watched.add(table)
        return written

    staged = Star(bronze, audit)
    pass_checks(staged, tuple(REQUIRED))
    kept = {}
    for table in LAYERS[STAGING]:
        if table in MERGED_STAGING:
            report.staged[table] = restage(lake, table, bronze, audit, from_scratch=full_refresh)
            kept[table] = shown(lake.read(STAGING, table))
        else:
            kept[table] = overwrite(STAGING, table, staged[table])
    if through == STAGING:
        pass_checks(Star(bronze, audit, calendar=calendar, given=kept), LAYERS[STAGING])
        return report
    months, events = kept["stg_customer_monthly_snapshot"], kept["stg_customer_support_events"]
    bounds = report.bounds
    for table in LAYERS[FACTS]:
        begins = full_refresh or not lake.exists(FACTS, table)
        bounds[table] = None if begins else watermark(lake.read(FACTS, table), "source_updated_at")
    keeps_entities = bool(checks) or through == ENTITIES or any(lake.exists(ENTITIES, t) for t in LAYERS[ENTITIES])
    new_months = since(months, "source_updated_at", bounds[facts.MONTH_FACT])
    new_events = since(events, "source_updated_at", bounds[facts.EVENT_FACT])
    dealt = (months, events) if keeps_entities else (new_months, new_events)
    heavy = HeavyKeys.of(*dealt, kept["stg_telecom_customer_churn"])

    def star_of_kept(**given: DataFrame) -> Star:
        return Star(bronze, audit, calendar=calendar, given={**kept, **given}, heavy=heavy)

    pass_checks(star_of_kept(), LAYERS[STAGING])
    if keeps_entities:
        for table in LAYERS[ENTITIES]:
            kept[table] = overwrite(ENTITIES, table, star_of_kept()[table])
        pass_checks(star_of_kept(), LAYERS[ENTITIES])
    if through == ENTITIES:
        return report
    for table in LAYERS[DIMENSIONS]:
        kept[table] = overwrite(DIMENSIONS, table, star_of_kept()[table])
    star = star_of_kept()
    pass_checks(star, LAYERS[DIMENSIONS])
    if through == DIMENSIONS:
        return report

    def fresh_months(bound: date | None) -> DataFrame:
        if keeps_entities:
            return since(star["int_customer_monthly_360"], "source_updated_at", bound)
        return star.monthly_360(new_months)

    def fresh_events(bound: date | None) -> DataFrame:
        if keeps_entities:
            return since(star["int_support_event_enriched"], "source_updated_at", bound)
        return star.enriched(new_events, bound)

    def inspection(table: str) -> Callable[[DataFrame], None] | None:
        if any(c.table == table for c in checks):
            return lambda pending: pass_checks(star_of_kept(**{table: pending}), (table,))
        return None

    fresh_facts = {
        facts.MONTH_FACT: lambda bound: star.month_facts(fresh_months(bound)),
        facts.EVENT_FACT: lambda bound: star.event_facts(fresh_events(bound)),
    }
    for table in (t for t in fresh_facts if t in only_facts):
        fresh = fresh_facts[table]
        # A fact without rows has no newest stamp, but it is there.
        begins = full_refresh or not lake.exists(FACTS, table)
        write = lake.replace if begins else lake.merge
        report.merges[table] = write(FACTS, table, fresh(bounds[table]), inspect=inspection(table), **MERGES[table])
        kept[table] = lake.read(FACTS, table)
    return report


def stored(lake: Lake, bronze: Bronze, calendar: DataFrame | None = None) -> Star:
    """The raw tables and every table of the star, read from storage where it is kept there."""
    kept = {}
    for layer, tables in LAYERS.items():
        kept |= {t: shown(lake.read(layer, t)) for t in tables if lake.exists(layer, t)}
    return Star(bronze, calendar=calendar, given=kept)


def recent_months(bronze_months: DataFrame, bound: date | None, audit: Audit) -> DataFrame:
    """Staged months at or after the bound, with the bound applied to the raw rows.

    Filtering may happen below the deduplication because the stamp is its first order: if the
    newest row of an id misses the bound, all its rows do. The source's own column is compared,
    so the literal reaches the file scan and old rows are neither shuffled nor sorted.
    """
    return staging.stg_months(since(bronze_months, "updated_at", bound), audit)
