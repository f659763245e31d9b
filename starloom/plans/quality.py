"""The checks of the star: 151 column checks and 15 business rules."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.flags import as_count
from starloom.functions.numbers import CENT, MONEY, amount_if
from starloom.functions.text import is_zip_cut, key_text
from starloom.operators.checks import (
    ERROR,
    WARN,
    Check,
    conflicting_tuples,
    repeated,
    several_per_key,
    unequal_counts,
)
from starloom.plans.entities import AGE_CUTS, AGE_TOP, QUALITY, TENURE_CUTS, TENURE_TOP
from starloom.plans.staging import CHURNED, ESCALATED, JOINED, RESOLVED, SERVICES, STAYED, raw, snake
from starloom.sources import bronze
from starloom.sources.bronze import REQUIRED

CUSTOMERS, ZIPS = "stg_telecom_customer_churn", "stg_telecom_zipcode_population"
MONTHS, EVENTS = "stg_customer_monthly_snapshot", "stg_customer_support_events"
MONTH_360, ENRICHED = "int_customer_monthly_360", "int_support_event_enriched"
MONTH_FACT, EVENT_FACT = "fct_customer_monthly_snapshot", "fct_support_event"

# The accepted labels.
STATUSES = (STAYED, CHURNED, JOINED)
CONTRACTS = ("Month-to-Month", "One Year", "Two Year")
PAYMENTS = ("Bank Withdrawal", "Credit Card", "Mailed Check")
INTERNET_TYPES = ("Fiber Optic", "DSL", "Cable")
GENDERS = ("Male", "Female")
CHANNELS = ("Chat", "Phone", "Email", "Self-Service")
PRIORITIES = ("Critical", "High", "Medium", "Low")
UNRESOLVED, PENDING = "Closed - Unresolved", "Pending"
TERMINAL = (RESOLVED, ESCALATED, UNRESOLVED)
RESOLUTIONS = (*TERMINAL, PENDING)
MEMBER_TYPES = ("Real", "Not Applicable", "Unknown")
ISSUES = (
    "Billing & Payment",
    "Account & Contract",
    "Internet Connectivity",
    "Slow Internet",
    "Device Setup",
    "Phone Service",
    "Cancellation Request",
    "Service Outage",
    "Other",
    "Competitor Offer",
    "Service Complaint",
    "Pricing Complaint",
)
AGE_BANDS = ("Unknown", *[label for _, label in AGE_CUTS], AGE_TOP)
TENURE_BANDS = ("Unknown", *[label for _, label in TENURE_CUTS], TENURE_TOP)
BOTH = (True, False)


# --- column checks ------------------------------------------------------------------------


def not_null(table: str, *columns: str, severity: str = ERROR) -> list[Check]:
    return [Check(table, "not_null", c, severity) for c in columns]


def unique(table: str, *columns: str) -> list[Check]:
    return [Check(table, "unique", c) for c in columns]


def key(table: str, *columns: str) -> list[Check]:
    return not_null(table, *columns) + unique(table, *columns)


def accepted(table: str, column: str, allowed: Iterable, severity: str = ERROR) -> list[Check]:
    return [Check(table, "accepted_values", column, severity, allowed=tuple(allowed))]


def points_to(table: str, column: str, parent: str, field: str = "") -> list[Check]:
    return [Check(table, "relationship", column, parent=(parent, field or column))]


def in_range(table: str, column: str, low: int, high: int | None = None) -> list[Check]:
    return [Check(table, "range", column, low=low, high=high, where=f"{column} is not null")]


def _staging() -> list[Check]:
    booleans = ["is_married", *[f"has_{snake(s)}" for s in SERVICES], "is_paperless_billing", "is_total_revenue_reconciled"]
    return [
        *key(CUSTOMERS, "customer_id"),
        *accepted(CUSTOMERS, "gender", GENDERS, WARN),
        *[c for b in booleans for c in accepted(CUSTOMERS, b, BOTH)],
        *not_null(CUSTOMERS, "zip_code", "contract", "payment_method", "customer_status", "etl_source_system", "etl_updated_at"),
        *points_to(CUSTOMERS, "zip_code", ZIPS),
        *accepted(CUSTOMERS, "internet_type", INTERNET_TYPES, WARN),
        *accepted(CUSTOMERS, "contract", CONTRACTS),
        *accepted(CUSTOMERS, "payment_method", PAYMENTS),
        *accepted(CUSTOMERS, "customer_status", STATUSES),
        *key(ZIPS, "zip_code"),
        *not_null(ZIPS, "population", severity=WARN),
        *key(MONTHS, "monthly_snapshot_id"),
        *not_null(MONTHS, "customer_id", "snapshot_month", "customer_status"),
        *not_null(MONTHS, "source_updated_at", "etl_source_system", "etl_updated_at"),
        *points_to(MONTHS, "customer_id", CUSTOMERS),
        *accepted(MONTHS, "contract_type", CONTRACTS, WARN),
        *accepted(MONTHS, "customer_status", STATUSES),
        *key(EVENTS, "support_event_id"),
        *not_null(EVENTS, "customer_id", "event_timestamp", "issue_category", "channel", "priority"),
        *not_null(EVENTS, "resolution_status", "source_updated_at", "etl_source_system", "etl_updated_at"),
        *points_to(EVENTS, "customer_id", CUSTOMERS),
        *accepted(EVENTS, "issue_category", ISSUES, WARN),
        *accepted(EVENTS, "channel", CHANNELS),
        *accepted(EVENTS, "priority", PRIORITIES),
        *accepted(EVENTS, "resolution_status", RESOLUTIONS),
        *in_range(EVENTS, "satisfaction_score", 1, 5),
    ]


def _entities() -> list[Check]:
    profile, services = "int_customer_profile", "int_customer_service_profile"
    status, geography = "int_customer_churn_status", "int_zipcode_geography"
    return [
        *key(profile, "customer_id"),
        *accepted(profile, "age_band", AGE_BANDS),
        *accepted(profile, "current_tenure_band", TENURE_BANDS),
        *not_null(profile, "zip_code"),
        *points_to(profile, "zip_code", geography),
        *key(services, "customer_id"),
        *not_null(services, "service_profile_key"),
        *key("int_customer_financial", "customer_id"),
        *key(status, "customer_id"),
        *not_null(status, "customer_status"),
        *accepted(status, "customer_status", STATUSES),
        *key(geography, "zip_code"),
        *not_null(geography, "population", severity=WARN),
        *key(MONTH_360, "monthly_snapshot_id"),
        *not_null(MONTH_360, "customer_id", "snapshot_month", "customer_status"),
        *points_to(MONTH_360, "customer_id", profile),
        *accepted(MONTH_360, "customer_status", STATUSES),
        *accepted(MONTH_360, "customer_count", (1,)),
        *accepted(MONTH_360, "eligible_customer_count", (0, 1)),
        *accepted(MONTH_360, "churned_customer_count", (0, 1)),
        *accepted(MONTH_360, "data_quality_status", QUALITY),
        *key(ENRICHED, "support_event_id"),
        *not_null(ENRICHED, "customer_id", "event_timestamp"),
        *points_to(ENRICHED, "customer_id", profile),
        *in_range(ENRICHED, "satisfaction_score", 1, 5),
    ]


def _dimensions() -> list[Check]:
    return [
        *key("dim_customer", "customer_key", "customer_id"),
        *not_null("dim_customer", "is_unknown_member"),
        *key("dim_geography", "geography_key", "zip_code"),
        *key("dim_service_profile", "service_profile_key"),
        *key("dim_churn_reason", "churn_reason_key"),
        *accepted("dim_churn_reason", "member_type", MEMBER_TYPES),
        *key("dim_date", "date_key", "calendar_date"),
    ]


def _facts() -> list[Check]:
    parents = {
        "customer_key": "dim_customer",
        "geography_key": "dim_geography",
        "service_profile_key": "dim_service_profile",
        "churn_reason_key": "dim_churn_reason",
        "date_key": "dim_date",
    }
    of_event = ("customer_key", "geography_key", "date_key")
    return [
        *key(MONTH_FACT, "customer_monthly_snapshot_key"),
        *not_null(MONTH_FACT, *parents),
        *[c for k, parent in parents.items() for c in points_to(MONTH_FACT, k, parent)],
        *not_null(MONTH_FACT, "customer_id", "snapshot_month"),
        *accepted(MONTH_FACT, "customer_count", (1,)),
        *accepted(MONTH_FACT, "eligible_customer_count", (0, 1)),
        *accepted(MONTH_FACT, "churned_customer_count", (0, 1)),
        *in_range(MONTH_FACT, "monthly_revenue_lost", 0),
        *key(EVENT_FACT, "support_event_key", "support_event_id"),
        *not_null(EVENT_FACT, *of_event),
        *[c for k in of_event for c in points_to(EVENT_FACT, k, parents[k])],
        *accepted(EVENT_FACT, "event_count", (1,)),
        *in_range(EVENT_FACT, "satisfaction_score", 1, 5),
        *in_range(EVENT_FACT, "resolution_hours", 0),
    ]


def column_checks() -> list[Check]:
    required = [c for table, columns in REQUIRED.items() for c in not_null(table, *columns)]
    return required + _staging() + _entities() + _dimensions() + _facts()


# --- business rules -----------------------------------------------------------------------


def unresolved_mismatch(events: DataFrame) -> DataFrame:
    """Pending cases carry neither hours nor score, closed ones both; other statuses pass."""
    status, results = F.col("resolution_status"), [F.col("resolution_hours"), F.col("satisfaction_score")]
    any_given = results[0].isNotNull() | results[1].isNotNull()
    any_absent = results[0].isNull() | results[1].isNull()
    wrong = F.when(status == PENDING, any_given).when(status.isin(*TERMINAL), any_absent)
    return events.filter(wrong).select("support_event_id", "resolution_status", *results)


# The counts that must repeat a flag, in both tables and in the fact only.
COUNTED = {"churned_customer_count": "is_churned", "eligible_customer_count": "is_churn_eligible"}
COUNTED_IN_FACT = {**COUNTED, "stayed_customer_count": "is_stayed", "new_customer_count": "is_new_customer"}


def inconsistent_months(months: DataFrame, counted: Mapping[str, str]) -> DataFrame:
    """Months whose counts, flags and lost revenue contradict each other. A NULL contradicts nothing."""
    states = as_count(F.col("is_churned")) + as_count(F.col("is_stayed")) + as_count(F.col("is_new_customer"))
    lost = amount_if(F.col("is_churned"), F.col("monthly_charge"))
    wrong = (F.col("customer_count") != 1) | (states > 1) | (F.col("monthly_revenue_lost") != lost)
    for count, flag in counted.items():
        wrong = wrong | (F.col(count) != as_count(F.col(flag)))
    return months.filter(wrong)


def null_key_flags(facts: DataFrame, model: str, row_key: str, keys: list[str]) -> DataFrame:
    absent = [F.col(k).isNull() for k in keys]
    flags = F.concat_ws("|", *[a.cast("string") for a in absent])
    any_absent = reduce(lambda a, b: a | b, absent)
    named = [F.lit(model).alias("model"), F.col(row_key).alias("row_key"), flags.alias("null_fk_flags")]
    return facts.filter(any_absent).select(*named)


FACT_KEYS = ["customer_key", "geography_key", "service_profile_key", "churn_reason_key", "date_key"]


def facts_without_keys(months: DataFrame, events: DataFrame) -> DataFrame:
    of_event = [k for k in FACT_KEYS if k != "churn_reason_key"]
    return null_key_flags(months, MONTH_FACT, "customer_monthly_snapshot_key", FACT_KEYS).unionByName(
        null_key_flags(events, EVENT_FACT, "support_event_key", of_event)
    )


def revenue_gaps(customers: DataFrame) -> DataFrame:
    gap = F.abs(F.col("total_revenue") - F.col("calculated_total_revenue"))
    gaps = customers.select("customer_id", "total_revenue", "calculated_total_revenue", gap.alias("revenue_gap"))
    return gaps.filter(F.col("revenue_gap") > F.lit(CENT).cast(MONEY))


def negative_charges(customers: DataFrame, months: DataFrame) -> DataFrame:
    def flagged(df: DataFrame, model: str, entity: str) -> DataFrame:
        shown = df.filter(~F.col("is_monthly_charge_valid"))
        return shown.select(F.lit(model).alias("model"), F.col(entity).alias("entity_id"), "monthly_charge")

    return flagged(customers, CUSTOMERS, "customer_id").unionByName(flagged(months, MONTHS, "monthly_snapshot_id"))


PLACE = ["city", "latitude", "longitude"]
PLACE_COUNTS = {"city": "distinct_cities", "latitude": "distinct_latitudes", "longitude": "distinct_longitudes"}


def business_rules() -> list[Check]:
    rule = lambda name, table, query, severity=ERROR: Check(table, name, severity=severity, query=query)
    grain = ("customer_id", "snapshot_month")
    return [
        rule("duplicate_month_staged", MONTHS, lambda t: repeated(t[MONTHS], *grain)),
        rule("duplicate_month_360", MONTH_360, lambda t: repeated(t[MONTH_360], *grain)),
        rule("duplicate_month_fact", MONTH_FACT, lambda t: repeated(t[MONTH_FACT], *grain)),
        rule("duplicate_event_enriched", ENRICHED, lambda t: repeated(t[ENRICHED], "support_event_id")),
        rule("duplicate_event_fact", EVENT_FACT, lambda t: repeated(t[EVENT_FACT], "support_event_id")),
        rule(
            "month_row_parity",
            MONTH_FACT,
            lambda t: unequal_counts(t[MONTH_360], "intermediate_row_count", t[MONTH_FACT], "fact_row_count"),
        ),
        rule(
            "enriched_row_parity",
            ENRICHED,
            lambda t: unequal_counts(t[EVENTS], "staging_row_count", t[ENRICHED], "enriched_row_count"),
        ),
        rule(
            "event_row_parity",
            EVENT_FACT,
            lambda t: unequal_counts(t[EVENTS], "staging_row_count", t[EVENT_FACT], "fact_row_count"),
        ),
        rule("status_flags_360", MONTH_360, lambda t: inconsistent_months(t[MONTH_360], COUNTED)),
        rule("status_flags_fact", MONTH_FACT, lambda t: inconsistent_months(t[MONTH_FACT], COUNTED_IN_FACT)),
        rule("resolution_consistency", EVENTS, lambda t: unresolved_mismatch(t[EVENTS])),
        rule("revenue_reconciles", CUSTOMERS, lambda t: revenue_gaps(t[CUSTOMERS])),
        rule("fact_keys_present", MONTH_FACT, lambda t: facts_without_keys(t[MONTH_FACT], t[EVENT_FACT])),
        rule(
            "single_place_per_zip",
            "int_zipcode_geography",
            lambda t: several_per_key(t["int_zipcode_geography"], "zip_code", PLACE_COUNTS),
        ),
        rule("negative_charges", CUSTOMERS, lambda t: negative_charges(t[CUSTOMERS], t[MONTHS]), WARN),
    ]


def all_checks() -> list[Check]:
    return column_checks() + business_rules()


def production_checks() -> list[Check]:
    """What a run should pass: all checks, and the rules that can fail where those cannot."""
    return all_checks() + extra_rules()


def arrivals_staged(raw_rows: DataFrame, source_key: str, staged: DataFrame) -> DataFrame:
    """Both counts, if the raw table has more or fewer keys than are staged: raw rows were deleted, or not staged.

    Reads one column of the raw table.
    """
    keys = raw_rows.select(key_text(F.col(source_key)).alias("key")).distinct()
    return unequal_counts(keys, "raw_key_count", staged, "staging_row_count")


def extra_rules() -> list[Check]:
    """Rules that can fail where the standard ones cannot.

    The place of a ZIP is compared on the customers, before it is aggregated away, and the
    service key of an event must exist like its other keys. A raw ZIP of more than five digits
    is cut by staging, where two such ZIPs may become one.
    """
    return [
        *[
            Check(table, "zip_cut", "Zip Code", WARN, query=lambda t, table=table: t[table].filter(is_zip_cut(raw("Zip Code"))))
            for table in (bronze.CUSTOMERS, bronze.ZIPS)
        ],
        Check(
            CUSTOMERS,
            "single_place_per_zip_staged",
            severity=WARN,
            query=lambda t: conflicting_tuples(t[CUSTOMERS].filter("zip_code is not null"), "zip_code", PLACE),
        ),
        *points_to(EVENT_FACT, "service_profile_key", "dim_service_profile"),
        *[
            Check(
                staged,
                "arrivals_staged",
                query=lambda t, source=source, key=key, staged=staged: arrivals_staged(t[source], key, t[staged]),
            )
            for source, key, staged in ((bronze.MONTHS, "monthly_snapshot_id", MONTHS), (bronze.EVENTS, "support_event_id", EVENTS))
        ],
    ]
