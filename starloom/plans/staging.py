"""Raw tables -> typed, cleaned, one row per business key.

A staging table is one projection, one keep-the-newest and one projection of flags. Rows are
never dropped for bad values; the flags say what is wrong with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions import flags
from starloom.functions.audit import Audit
from starloom.functions.dates import month_floor
from starloom.functions.numbers import MONEY, agrees, big_whole, moment, money, signed_total, whole
from starloom.functions.text import clean_text, key_text, yes_no, zip5
from starloom.operators.dedup import latest_rows

# Status labels of customers and of support cases.
CHURNED, STAYED, JOINED = "Churned", "Stayed", "Joined"
RESOLVED, ESCALATED = "Resolved", "Escalated"

# The services a customer can hold, by raw column name.
SERVICES = (
    "Phone Service",
    "Multiple Lines",
    "Internet Service",
    "Online Security",
    "Online Backup",
    "Device Protection Plan",
    "Premium Tech Support",
    "Streaming TV",
    "Streaming Movies",
    "Streaming Music",
    "Unlimited Data",
)

_LOADED, _LINE, _FILE = "__loaded", "__line", "__file"
# What tells copies apart; file and line identify a raw row, so there are no ties.
LOAD_ORDER = [_LOADED, _LINE, _FILE]
SOURCE_ORDER = ["source_updated_at", *LOAD_ORDER]
# Kept with a staged table that is merged, beside its own columns: what orders the versions of a row, and its month.
STAGED_MONTH = "staged_month"
BOOKKEEPING = [*LOAD_ORDER, STAGED_MONTH]


def snake(name: str) -> str:
    return name.lower().replace(" ", "_")


def named(**columns: Column) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def raw(name: str) -> Column:
    return F.col(f"`{name}`")


def load_columns() -> list[Column]:
    """What picks the newest copy of a row; only the source system leaves staging."""
    order = {_LOADED: "etl_ingested_at", _LINE: "etl_file_row_number", _FILE: "etl_source_file"}
    return [F.col(c).alias(n) for n, c in order.items()] + [F.col("etl_source_system")]


def delivery_columns() -> list[Column]:
    return named(
        source_updated_at=moment(F.col("updated_at")),
        source_batch_id=clean_text(F.col("batch_id")),
        source_system=clean_text(F.col("source_system")),
    )


def finished(
    df: DataFrame, flagged: dict[str, Column], after: dict[str, str], audit: Audit, month: str | None = None
) -> DataFrame:
    """Project the flags next to the columns they judge, drop the load order, add the audit block. With ``month``, a date
    column, the load order stays, and the row's month with it."""
    columns = []
    for name in df.columns:
        if name not in LOAD_ORDER:
            columns.append(F.col(name))
        columns += [flagged[f].alias(f) for f, anchor in after.items() if anchor == name]
    kept = [*LOAD_ORDER, month_floor(F.col(month)).alias(STAGED_MONTH)] if month else []
    return df.select(*columns, *audit.columns(), *kept)


def stated_revenue_parts() -> Column:
    """Charges less refunds plus extra data and long distance, a missing part counting as nothing."""
    return signed_total(
        plus=[F.col("total_charges"), F.col("total_extra_data_charges"), F.col("total_long_distance_charges")],
        minus=[F.col("total_refunds")],
    )


def churn_flags(status: str = "customer_status") -> dict[str, Column]:
    label = F.col(status)
    return {
        "is_churned": flags.is_label(label, CHURNED),
        "is_stayed": flags.is_label(label, STAYED),
        "is_new_customer": flags.is_label(label, JOINED),
        "is_churn_eligible": flags.is_label(label, STAYED, CHURNED),
    }


def typed_customers(bronze: DataFrame) -> DataFrame:
    text = lambda name: clean_text(raw(name)).alias(snake(name))
    as_is = lambda name: raw(name).alias(snake(name))
    amount = lambda name: money(raw(name)).alias(snake(name))
    service = {name: yes_no(raw(name)).alias(f"has_{snake(name)}") for name in SERVICES}
    return bronze.select(
        key_text(raw("Customer ID")).alias("customer_id"),
        text("Gender"),
        as_is("Age"),
        yes_no(raw("Married")).alias("is_married"),
        as_is("Number of Dependents"),
        text("City"),
        zip5(raw("Zip Code")).alias("zip_code"),
        as_is("Latitude"),
        as_is("Longitude"),
        as_is("Number of Referrals"),
        raw("Tenure in Months").alias("tenure_months"),
        text("Offer"),
        *service.values(),
        amount("Avg Monthly Long Distance Charges"),
        text("Internet Type"),
        as_is("Avg Monthly GB Download"),
        text("Contract"),
        yes_no(raw("Paperless Billing")).alias("is_paperless_billing"),
        text("Payment Method"),
        amount("Monthly Charge"),
        amount("Total Charges"),
        amount("Total Refunds"),
        amount("Total Extra Data Charges"),
        amount("Total Long Distance Charges"),
        amount("Total Revenue"),
        text("Customer Status"),
        text("Churn Category"),
        text("Churn Reason"),
        *load_columns(),
    )


def stg_customers(bronze: DataFrame, audit: Audit) -> DataFrame:
    newest = latest_rows(typed_customers(bronze), "customer_id", LOAD_ORDER)
    recomputed = stated_revenue_parts()
    flagged = {
        "calculated_total_revenue": recomputed.cast(MONEY),
        "is_total_revenue_reconciled": agrees(F.col("total_revenue"), recomputed),
        "is_monthly_charge_valid": flags.within(F.col("monthly_charge"), low=0),
    }
    return finished(newest, flagged, dict.fromkeys(flagged, "total_revenue"), audit)


def stg_zips(bronze: DataFrame, audit: Audit) -> DataFrame:
    typed = bronze.select(
        *named(zip_code=zip5(raw("Zip Code")), population=big_whole(raw("Population"))), *load_columns()
    )
    flagged = {"is_population_valid": flags.within(F.col("population"), above=0)}
    return finished(latest_rows(typed, "zip_code", LOAD_ORDER), flagged, {"is_population_valid": "population"}, audit)


def typed_months(bronze: DataFrame) -> DataFrame:
    cleaned = lambda name: clean_text(F.col(name)).alias(name)
    amount = lambda name: money(F.col(name)).alias(name)
    return bronze.select(
        *named(
            monthly_snapshot_id=key_text(F.col("monthly_snapshot_id")),
            customer_id=key_text(F.col("customer_id")),
            snapshot_month=month_floor(F.col("snapshot_month")),
            tenure_months=whole(F.col("tenure_months")),
        ),
        cleaned("contract_type"),
        cleaned("internet_type"),
        amount("monthly_charge"),
        amount("monthly_revenue"),
        amount("total_revenue"),
        cleaned("customer_status"),
        *delivery_columns(),
        *load_columns(),
    )


def stg_months(bronze: DataFrame, audit: Audit, *, merged: bool = False) -> DataFrame:
    newest = latest_rows(typed_months(bronze), "monthly_snapshot_id", SOURCE_ORDER)
    flagged = {"is_monthly_charge_valid": flags.within(F.col("monthly_charge"), low=0), **churn_flags()}
    after = {"is_monthly_charge_valid": "total_revenue", **dict.fromkeys(churn_flags(), "customer_status")}
    return finished(newest, flagged, after, audit, "snapshot_month" if merged else None)


def typed_events(bronze: DataFrame) -> DataFrame:
    cleaned = lambda name: clean_text(F.col(name)).alias(name)
    return bronze.select(
        *named(
            support_event_id=key_text(F.col("support_event_id")),
            customer_id=key_text(F.col("customer_id")),
            event_timestamp=moment(F.col("event_timestamp")),
        ),
        *map(cleaned, ("issue_category", "channel", "priority", "resolution_status")),
        *named(
            resolution_hours=money(F.col("resolution_hours")),
            satisfaction_score=whole(F.col("satisfaction_score")),
        ),
        *delivery_columns(),
        *load_columns(),
    )


def event_flags() -> dict[str, Column]:
    status = F.col("resolution_status")
    return {
        "is_resolution_hours_valid": flags.within(F.col("resolution_hours"), low=0, missing=True),
        "is_satisfaction_score_valid": flags.within(F.col("satisfaction_score"), 1, 5, missing=True),
        "is_resolved": flags.is_label(status, RESOLVED),
        "is_escalated": flags.is_label(status, ESCALATED),
    }


def stg_events(bronze: DataFrame, audit: Audit, *, merged: bool = False) -> DataFrame:
    newest = latest_rows(typed_events(bronze), "support_event_id", SOURCE_ORDER)
    after = dict.fromkeys(event_flags(), "satisfaction_score")
    return finished(newest, event_flags(), after, audit, "event_timestamp" if merged else None)
